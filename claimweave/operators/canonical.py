"""Beliefs to canonical beliefs: normal form, groups, summaries, members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.ordered import pages
from claimweave.functions.settle import settled
from claimweave.functions.text import norm_text
from claimweave.params import DEFAULT, Params


def normalized(beliefs: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Add the normal form of the text and its hash."""
    formed = settled(beliefs, {"norm_text": norm_text(F.col("belief_text"), params)})
    return settled(formed, {"norm_hash": F.md5("norm_text")})


def exact_groups(normal: DataFrame) -> DataFrame:
    """Beliefs per normal form, with the smallest spelling."""
    return normal.groupBy("norm_hash", "norm_text").agg(
        F.count(F.lit(1)).alias("mentions"), F.min("belief_text").alias("spelling")
    )


def mentions(normal: DataFrame, utterances: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """One row per belief with canonical id, episode and speaker.

    Without ``groups`` the canonical id is the hash of the normal form.  With
    ``groups`` (norm_hash -> group_id) it is the hash of the representative.
    """
    rows = normal.withColumn("canonical_id", F.col("norm_hash"))
    if groups is not None:
        to = representatives(exact_groups(normal), groups).select("norm_hash", F.col("canonical_id"))
        rows = normal.join(to, "norm_hash")
    where = utterances.select("utterance_id", "episode_id", "episode_seq", "speaker")
    return rows.join(where, "utterance_id")


def representatives(forms: DataFrame, groups: DataFrame) -> DataFrame:
    """Canonical id and text of each normal form: the most frequent form of its group, then the smallest."""
    joined = forms.join(groups.select(F.col("id").alias("norm_hash"), "group_id"), "norm_hash", "left").withColumn(
        "group_id", F.coalesce("group_id", "norm_hash")
    )
    best = joined.groupBy("group_id").agg(
        F.min(F.struct((-F.col("mentions")).alias("_rank"), "norm_text", "norm_hash", "spelling")).alias("_best")
    )
    return joined.select("norm_hash", "group_id").join(best, "group_id").select(
        "norm_hash",
        F.col("_best.norm_hash").alias("canonical_id"),
        F.col("_best.norm_text").alias("norm_text"),
        F.col("_best.spelling").alias("canonical_text"),
    )


def summaries(mentioned: DataFrame) -> DataFrame:
    """One bounded row per canonical: text, counts, first and last episode.

    The text is the smallest spelling of the most frequent normal form, then of
    the smallest form.  Two small aggregates instead of one list of all beliefs.
    """
    seen = F.struct("episode_seq", "episode_id")
    forms = mentioned.groupBy("canonical_id", "norm_text").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("belief_text").alias("spelling"),
        F.min(seen).alias("lo"),
        F.max(seen).alias("hi"),
    )
    out = forms.groupBy("canonical_id").agg(
        F.min(F.struct((-F.col("n")).alias("r"), "norm_text", "spelling")).alias("best"),
        F.sum("n").alias("mentions"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )
    return out.select(
        "canonical_id",
        F.col("best.spelling").alias("canonical_text"),
        F.col("best.norm_text").alias("norm_text"),
        "mentions",
        F.col("lo.episode_seq").alias("first_seq"),
        F.col("lo.episode_id").alias("first_seen_episode"),
        F.col("hi.episode_seq").alias("last_seq"),
        F.col("hi.episode_id").alias("last_seen_episode"),
    )


def members(mentioned: DataFrame) -> DataFrame:
    """Long form of the id lists: one row per belief."""
    return mentioned.select("canonical_id", "belief_id", "utterance_id", "original_quote")


def member_lists(mentioned: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """belief_ids, source_utterance_ids and example_quotes as arrays, in pages."""
    return pages(
        members(mentioned),
        ["canonical_id"],
        "belief_id",
        params.page_size,
        {
            "belief_ids": F.col("belief_id"),
            "source_utterance_ids": F.col("utterance_id"),
            "example_quotes": F.col("original_quote"),
        },
    )


def rephrased(forms: DataFrame, answers: DataFrame) -> DataFrame:
    """Text from a model where it gave one, the normal form where it failed or was not asked."""
    given = answers.select("norm_hash", F.col("response").alias("_given"))
    return forms.join(given, "norm_hash", "left").withColumn("canonical_text", F.coalesce("_given", "norm_text")).drop("_given")


def ambiguous_forms(pairs: DataFrame, below: Column) -> DataFrame:
    """Forms that take part in a pair which the fuzzy step leaves open."""
    close = pairs.filter(below)
    return close.select(F.col("a").alias("norm_hash")).unionByName(close.select(F.col("b").alias("norm_hash"))).distinct()
