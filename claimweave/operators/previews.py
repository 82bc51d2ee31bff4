"""Short tables for a look at the results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def belief_preview(beliefs: DataFrame, utterances: DataFrame, n: int = 100) -> DataFrame:
    """The first n beliefs by id, missing values shown as empty or zero.

    The n ids are picked before the join, so the join handles n rows.
    """
    first = beliefs.select("belief_id", "belief_text", "confidence", "utterance_id").orderBy("belief_id").limit(n)
    said = utterances.select("utterance_id", "speaker", "episode_id")
    return first.join(said, "utterance_id", "left").select(
        F.col("belief_id").alias("id"),
        F.coalesce("belief_text", F.lit("")).alias("belief_text"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce("speaker", F.lit("")).alias("speaker"),
        F.coalesce("episode_id", F.lit("")).alias("episode_id"),
    )


def contradiction_preview(found: DataFrame, canonicals: DataFrame, n: int = 50) -> DataFrame:
    """The first n contradictions by id, with both texts."""
    first = found.orderBy("contradiction_id").limit(n)
    text = canonicals.select("canonical_id", "canonical_text")
    a = text.select(F.col("canonical_id").alias("belief_a_id"), F.col("canonical_text").alias("_a"))
    b = text.select(F.col("canonical_id").alias("belief_b_id"), F.col("canonical_text").alias("_b"))
    return first.join(a, "belief_a_id", "left").join(b, "belief_b_id", "left").select(
        "contradiction_id",
        F.coalesce("_a", F.lit("")).alias("belief_a"),
        F.coalesce("_b", F.lit("")).alias("belief_b"),
        F.coalesce("opposition_score", F.lit(0.0)).alias("opposition_score"),
        F.coalesce("type", F.lit("")).alias("type"),
        F.coalesce("is_reversal", F.lit(False)).alias("is_reversal"),
    )
