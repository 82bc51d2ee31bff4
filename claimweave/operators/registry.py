"""The global registry: aliases, canonical entries, episode history, embeddings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.ids import content_id
from claimweave.functions.ordered import pages


def one_per_belief(beliefs: DataFrame) -> DataFrame:
    """Literal mode: every belief becomes a canonical entry of its own.

    ``beliefs`` carries ``episode_id``; its id is reused, so a rerun adds nothing.
    """
    return beliefs.select(
        content_id(F.lit("canonical"), F.col("belief_id")).alias("canonical_id"),
        F.col("belief_text").alias("canonical_text"),
        F.array("belief_id").alias("belief_ids"),
        F.array("utterance_id").alias("source_utterance_ids"),
        F.array("original_quote").alias("example_quotes"),
        F.col("episode_id").alias("first_seen_episode"),
        F.col("episode_id").alias("last_seen_episode"),
    )


def latest(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Per key the row with the highest ``seq``; an aggregate, so combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(seq, *[c for c in rest if c != seq])).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def upsert(current: DataFrame, new: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Union of both with the last writer winning per key."""
    return latest(current.unionByName(new), keys, seq)


def alias_rows(canonicals: DataFrame, text: str, seq: Column) -> DataFrame:
    return canonicals.select(F.lower(text).alias("alias_text"), "canonical_id", seq.alias("seq"))


def upsert_aliases(current: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(current, new, ["alias_text"], "seq")


def find_by_text(beliefs: DataFrame, aliases: DataFrame) -> DataFrame:
    """Exact lookup on lower-cased text; NULL where the registry has no such alias."""
    hits = aliases.select("alias_text", F.col("canonical_id").alias("alias_canonical_id"))
    return beliefs.join(hits, F.lower("belief_text") == F.col("alias_text"), "left").drop("alias_text")


def append_history(current: DataFrame, new: DataFrame) -> DataFrame:
    """(canonical_id, episode_id, seq): an episode is added once, at its first position."""
    return current.unionByName(new).groupBy("canonical_id", "episode_id").agg(F.min("seq").alias("seq"))


def history_lists(history: DataFrame, page_size: int = 1000) -> DataFrame:
    """Episodes of each canonical in order of insertion, in pages."""
    keyed = history.withColumn("_at", F.concat_ws("|", F.lpad(F.col("seq").cast("string"), 19, "0"), "episode_id"))
    chunk = F.floor(F.col("seq") / 4096)
    return pages(keyed, ["canonical_id"], "_at", page_size, {"episode_ids": F.col("episode_id")}, chunk)


def missing_embeddings(ids: DataFrame, cache: DataFrame) -> DataFrame:
    return ids.join(cache.select("canonical_id"), "canonical_id", "left_anti")


def cached_embeddings(ids: DataFrame, cache: DataFrame, made: DataFrame) -> DataFrame:
    """Embedding of each id: from the cache, else newly made, else NULL."""
    fresh = made.select("canonical_id", F.col("embedding").alias("_new"))
    return (
        ids.join(cache.select("canonical_id", "embedding"), "canonical_id", "left")
        .join(fresh, "canonical_id", "left")
        .select(
            *ids.columns,
            F.coalesce("embedding", "_new").alias("embedding"),
            F.when(F.col("embedding").isNotNull(), "cache").when(F.col("_new").isNotNull(), "new").alias("origin"),
        )
    )


def merge_canonicals(*parts: DataFrame) -> DataFrame:
    """Fold summaries of canonicals, the stored ones first, into one row for each.

    All carry canonical_id, canonical_text, mentions, first_seq, first_seen_episode,
    last_seq, last_seen_episode.  A union and one aggregate do what full outer
    joins would, and combine before the shuffle.  The text stored first is kept.
    """
    rows = [part.withColumn("_gen", F.lit(i)) for i, part in enumerate(parts)]
    return reduce(DataFrame.unionByName, rows).groupBy("canonical_id").agg(
        F.min_by("canonical_text", F.struct("_gen", "canonical_text")).alias("canonical_text"),
        F.sum("mentions").alias("mentions"),
        F.min("first_seq").alias("first_seq"),
        F.min_by("first_seen_episode", F.struct("first_seq", "first_seen_episode")).alias("first_seen_episode"),
        F.max("last_seq").alias("last_seq"),
        F.max_by("last_seen_episode", F.struct("last_seq", "last_seen_episode")).alias("last_seen_episode"),
    )


def merge_tables(parts: list[dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """One registry out of parts, the oldest first: a base and what later batches add to it."""
    if len(parts) == 1:
        return parts[0]

    def all_of(name: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [part[name] for part in parts])

    return {
        "canonical": merge_canonicals(*[part["canonical"] for part in parts]),
        "member": all_of("member"),
        "alias": latest(all_of("alias"), ["alias_text"], "seq"),
        "history": append_history(parts[0]["history"].limit(0), all_of("history")),
        "embedding": all_of("embedding"),
    }


def merge_members(current: DataFrame, new: DataFrame) -> DataFrame:
    """Members are keyed by belief id, so merging twice changes nothing."""
    return current.unionByName(new).dropDuplicates(["canonical_id", "belief_id"])


def mismatches(beliefs_with_alias: DataFrame, nearest: DataFrame) -> DataFrame:
    """Beliefs whose alias and whose nearest embedding name different canonicals."""
    near = nearest.select("belief_id", F.col("canonical_id").alias("nearest_canonical_id"))
    return beliefs_with_alias.filter(F.col("alias_canonical_id").isNotNull()).join(near, "belief_id").filter(
        F.col("alias_canonical_id") != F.col("nearest_canonical_id")
    )
