"""Opposing beliefs, within one speaker or between two."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.ids import content_id
from claimweave.functions.ordered import pages
from claimweave.operators.similar import opposed_pairs
from claimweave.params import DEFAULT, Params
from claimweave.session import durable


def candidates(canonicals: DataFrame, params: Params = DEFAULT, at_least: float | None = None) -> DataFrame:
    """Unordered pairs of unlike negation from the ambiguous band upwards, with their score.

    ``at_least`` is for a caller who keeps no lower score: the search then need not find them.
    """
    return opposed_pairs(canonicals, max(params.ambiguous_from, at_least or 0.0), params)


def certain(pairs: DataFrame, params: Params = DEFAULT) -> DataFrame:
    return pairs.filter(F.col("score") >= params.opposition)


def ambiguous(pairs: DataFrame, params: Params = DEFAULT) -> DataFrame:
    return pairs.filter((F.col("score") >= params.ambiguous_from) & (F.col("score") < params.opposition))


def confirmed(pairs: DataFrame, verdicts: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Certain pairs, plus the ambiguous ones that a model's verdict (a, b, opposed) confirms."""
    held = ambiguous(pairs, params).join(verdicts.filter("opposed").select("a", "b"), ["a", "b"], "left_semi")
    return certain(pairs, params).unionByName(held)


def stances(mentions: DataFrame) -> DataFrame:
    """First and last episode in which a speaker holds a canonical."""
    return mentions.groupBy("canonical_id", "speaker").agg(
        F.min("episode_seq").alias("first_seq"), F.max("episode_seq").alias("last_seq")
    )


def contradictions(pairs: DataFrame, mentions: DataFrame) -> DataFrame:
    """One row per pair and pair of speakers who hold the two sides.

    The mentions are first reduced to one row per canonical and speaker, so a
    canonical with very many mentions adds no more than its speakers.
    """
    held = stances(mentions)
    a = held.select(*[F.col(c).alias(f"a_{c}") for c in held.columns])
    b = held.select(*[F.col(c).alias(f"b_{c}") for c in held.columns])
    rows = pairs.join(a, F.col("a") == F.col("a_canonical_id")).join(b, F.col("b") == F.col("b_canonical_id"))
    same = F.col("a_speaker") == F.col("b_speaker")
    one_episode = (
        (F.col("a_first_seq") == F.col("a_last_seq"))
        & (F.col("b_first_seq") == F.col("b_last_seq"))
        & (F.col("a_first_seq") == F.col("b_first_seq"))
    )
    later = F.when(
        F.col("a_first_seq") != F.col("b_first_seq"), F.greatest("a_first_seq", "b_first_seq")
    ).otherwise(F.greatest("a_last_seq", "b_last_seq"))
    return rows.select(
        content_id("a", "b", "a_speaker", "b_speaker").alias("contradiction_id"),
        F.col("a").alias("belief_a_id"),
        F.col("b").alias("belief_b_id"),
        F.col("score").alias("opposition_score"),
        F.when(same, "within_speaker").otherwise("cross_speaker").alias("type"),
        (same & ~one_episode).alias("is_reversal"),
        F.col("a_speaker").alias("speaker_a"),
        F.col("b_speaker").alias("speaker_b"),
        later.alias("later_seq"),
    )


def where_held(found: DataFrame, mentions: DataFrame) -> DataFrame:
    """(contradiction_id, episode_id): every episode in which either side is held, once."""
    held = mentions.select("canonical_id", "speaker", "episode_id").distinct()
    sides = found.select(
        "contradiction_id",
        F.explode(
            F.array(
                F.struct(F.col("belief_a_id").alias("canonical_id"), F.col("speaker_a").alias("speaker")),
                F.struct(F.col("belief_b_id").alias("canonical_id"), F.col("speaker_b").alias("speaker")),
            )
        ).alias("s"),
    ).select("contradiction_id", "s.canonical_id", "s.speaker")
    return sides.join(held, ["canonical_id", "speaker"]).select("contradiction_id", "episode_id").distinct()


def episode_lists(places: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """episode_ids of each contradiction in pages; chunked by the head of the hash of the episode."""
    keyed = places.withColumn("_at", F.concat(F.substring(F.md5("episode_id"), 1, 4), F.col("episode_id")))
    return pages(keyed, ["contradiction_id"], "_at", params.page_size, {"episode_ids": F.col("episode_id")})


def pair_counts(pairs: DataFrame, mentions: DataFrame) -> DataFrame:
    """One row per pair of claims: its speakers on either side, and its contradictions counted by type.

    Counts ``contradictions`` without listing them.  Two claims with m and n holders
    contradict m * n times; within a speaker as often as one holds both, and for that
    the holders of the side that has fewer are looked up among those of the other.
    """
    held = stances(mentions)
    sizes = held.groupBy("canonical_id").agg(F.count(F.lit(1)).alias("n"))
    sized = pairs.join(sizes.toDF("a", "speakers_a"), "a").join(sizes.toDF("b", "speakers_b"), "b")
    least = F.when(F.col("speakers_a") <= F.col("speakers_b"), F.struct(F.col("a").alias("few"), F.col("b").alias("many")))
    asked = sized.select("a", "b", F.inline(F.array(least.otherwise(F.struct(F.col("b").alias("few"), F.col("a").alias("many"))))))
    few = asked.join(held.toDF("few", "speaker", "few_first", "few_last"), "few")
    both = few.join(held.toDF("many", "speaker", "many_first", "many_last"), ["many", "speaker"])
    differ = F.least("few_first", "many_first") != F.greatest("few_last", "many_last")
    within = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_within"), F.count_if(differ).alias("_reversals"))
    n = F.coalesce("_within", F.lit(0))
    return sized.join(within, ["a", "b"], "left").select(
        F.col("a").alias("belief_a_id"),
        F.col("b").alias("belief_b_id"),
        F.col("score").alias("opposition_score"),
        "speakers_a",
        "speakers_b",
        n.alias("within_speaker"),
        (F.col("speakers_a") * F.col("speakers_b") - n).alias("cross_speaker"),
        F.coalesce("_reversals", F.lit(0)).alias("reversals"),
    )


def counts_by_type(counted: DataFrame) -> DataFrame:
    """From ``pair_counts``; a type that does not occur has no row."""
    kinds = F.array(
        F.struct(F.lit("within_speaker").alias("type"), F.col("within_speaker").alias("n"), F.col("reversals").alias("r")),
        F.struct(F.lit("cross_speaker").alias("type"), F.col("cross_speaker").alias("n"), F.lit(0).cast("bigint").alias("r")),
    )
    return counted.select(F.inline(kinds)).filter("n > 0").groupBy("type").agg(
        F.sum("n").alias("contradictions"), F.sum("r").alias("reversals")
    )


def counts_by_speakers(found: DataFrame) -> DataFrame:
    return found.groupBy(
        F.least("speaker_a", "speaker_b").alias("speaker_1"), F.greatest("speaker_a", "speaker_b").alias("speaker_2")
    ).agg(F.count(F.lit(1)).alias("contradictions"))


def counts_by_episode(counted: DataFrame, mentions: DataFrame) -> DataFrame:
    """Contradictions of which either side is held in the episode, from ``pair_counts`` and without listing them.

    With x of the m speakers of one side and y of the n of the other heard in an
    episode, these are x * n + m * y - x * y.
    """
    heard = mentions.groupBy("canonical_id", "episode_id").agg(F.count_distinct("speaker").alias("heard"))
    ends = F.array(
        F.struct(F.col("belief_a_id").alias("canonical_id"), F.lit(1).alias("_a"), F.lit(0).alias("_b")),
        F.struct(F.col("belief_b_id").alias("canonical_id"), F.lit(0).alias("_a"), F.lit(1).alias("_b")),
    )
    pair = ["belief_a_id", "belief_b_id", "speakers_a", "speakers_b"]
    there = counted.select(*pair, F.inline(ends)).join(heard, "canonical_id").groupBy(*pair, "episode_id").agg(
        F.sum(F.col("heard") * F.col("_a")).alias("x"), F.sum(F.col("heard") * F.col("_b")).alias("y")
    )
    n = F.col("x") * F.col("speakers_b") + F.col("speakers_a") * F.col("y") - F.col("x") * F.col("y")
    return there.groupBy("episode_id").agg(F.sum(n).alias("contradictions"))


def compare_speakers(mentions: DataFrame, requests: DataFrame) -> DataFrame:
    """For each requested (speaker_1, speaker_2): canonicals both hold, and only one holds.

    Works from distinct (speaker, canonical); the pairs are the ones asked for.
    """
    held = mentions.select("speaker", "canonical_id").distinct()
    long = requests.select("speaker_1", "speaker_2", F.explode(F.array("speaker_1", "speaker_2")).alias("speaker"))
    per_claim = long.join(held, "speaker").groupBy("speaker_1", "speaker_2", "canonical_id").agg(
        F.bool_or(F.col("speaker") == F.col("speaker_1")).alias("one"),
        F.bool_or(F.col("speaker") == F.col("speaker_2")).alias("two"),
    )
    return per_claim.groupBy("speaker_1", "speaker_2").agg(
        F.count_if(F.col("one") & F.col("two")).alias("shared"),
        F.count_if(F.col("one") & ~F.col("two")).alias("only_1"),
        F.count_if(F.col("two") & ~F.col("one")).alias("only_2"),
    )


# a claim with more holders is counted by blocks of speakers; speakers and claims of a block
HEAVY, BLOCK_SPEAKERS, BLOCK_CLAIMS = 64, 512, 1024


def claims_of(mentions: DataFrame) -> DataFrame:
    """(speaker, claims): how many canonicals each speaker holds."""
    return mentions.groupBy("speaker").agg(F.count_distinct("canonical_id").alias("claims"))


def overlaps(mentions: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """All pairs of speakers who share a canonical, whether they ever meet or not, with ``compare_speakers``' counts.

    The product of the table of speakers and claims with itself.  A claim with few holders
    gives its pairs by a join.  One with many would give the square of them, so these
    claims are cut into blocks, as are their holders, and a task takes the matrix product
    of two blocks.  What two speakers do not share follows from ``claims_of``; pairs that
    share nothing have no row.
    """
    held = durable(mentions.select("speaker", "canonical_id").distinct())
    sizes = held.groupBy("canonical_id").agg(F.count(F.lit(1)).alias("holders"))
    light = held.join(sizes.filter(F.col("holders") <= heavy), "canonical_id").select("canonical_id", "speaker")
    few = light.toDF("canonical_id", "speaker_1").join(light.toDF("canonical_id", "speaker_2"), "canonical_id").filter("speaker_1 < speaker_2")
    few = few.groupBy("speaker_1", "speaker_2").agg(F.count(F.lit(1)).alias("n"))
    many = durable(held.join(sizes.filter(F.col("holders") > heavy), "canonical_id").select("speaker", "canonical_id"))
    total = many.agg(F.count_distinct("speaker").alias("s"), F.count_distinct("canonical_id").alias("c")).first()
    cuts = max(1, -(-total["s"] // BLOCK_SPEAKERS))
    zero = F.lit(0).cast("long")
    own = F.pmod(F.xxhash64("speaker"), F.lit(cuts)).cast("long")
    meets = F.transform(F.sequence(zero, F.lit(cuts - 1).cast("long")), lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j"), (own > k).alias("right")))
    tiles = many.select("speaker", "canonical_id", F.pmod(F.xxhash64("canonical_id"), F.lit(max(1, -(-total["c"] // BLOCK_CLAIMS)))).alias("slice"), F.inline(meets))

    def product(tile: pa.Table) -> pa.Table:
        speakers, row = np.unique(tile["speaker"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        claims, column = np.unique(tile["canonical_id"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        table = np.zeros((len(speakers), len(claims)), np.float32)
        table[row, column] = 1
        shared = table @ table.T
        if tile["i"][0] != tile["j"][0]:
            right = np.zeros(len(speakers), bool)
            right[row] = tile["right"].to_numpy(zero_copy_only=False)
            shared *= right[:, None] != right[None, :]
        a, b = np.nonzero(np.triu(shared, 1))
        n = shared[a, b].astype(np.int64)
        return pa.table({"speaker_1": pa.array(speakers[a].tolist(), pa.string()), "speaker_2": pa.array(speakers[b].tolist(), pa.string()), "n": pa.array(n)})

    blocks = tiles.groupBy("slice", "i", "j").applyInArrow(product, "speaker_1 string, speaker_2 string, n long")
    shared = few.unionByName(blocks).groupBy("speaker_1", "speaker_2").agg(F.sum("n").alias("shared"))
    counts = claims_of(held)
    both = shared.join(counts.toDF("speaker_1", "_1"), "speaker_1").join(counts.toDF("speaker_2", "_2"), "speaker_2")
    return both.select("speaker_1", "speaker_2", "shared", (F.col("_1") - F.col("shared")).alias("only_1"), (F.col("_2") - F.col("shared")).alias("only_2"))


def shared_claims(mentions: DataFrame, one: str, two: str) -> DataFrame:
    """Canonicals that both of two speakers hold."""
    held = mentions.select("speaker", "canonical_id")
    return held.filter(F.col("speaker") == one).select("canonical_id").intersect(
        held.filter(F.col("speaker") == two).select("canonical_id")
    )


def own_claims(mentions: DataFrame, one: str, two: str) -> DataFrame:
    """Canonicals that the first speaker holds and the second does not."""
    held = mentions.select("speaker", "canonical_id")
    return held.filter(F.col("speaker") == one).select("canonical_id").distinct().join(
        held.filter(F.col("speaker") == two).select("canonical_id"), "canonical_id", "left_anti"
    )
