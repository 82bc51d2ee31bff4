"""Utterances to sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.ids import content_id
from claimweave.functions.settle import settled
from claimweave.functions.text import sentences, strip


def split_sentences(utterances: DataFrame) -> DataFrame:
    """One row per sentence; an utterance of one sentence stays as it is.

    A row-local explode: no shuffle, speaker, times and link are kept.
    """
    pieces = F.col("_pieces")
    cut = settled(utterances, {"_pieces": sentences(F.col("text"))})
    several = F.size(pieces) > 1
    rows = cut.withColumn("parent_id", F.col("utterance_id")).select(
        *[c for c in cut.columns if c not in ("_pieces", "text", "sentence_no")],
        "parent_id",
        several.alias("_several"),
        F.posexplode(F.when(several, pieces).otherwise(F.array("text"))).alias("_pos", "_text"),
    )
    number = F.when(F.col("_several"), F.col("_pos") + 1).otherwise(F.lit(0)).cast("int")
    return settled(
        rows.drop("utterance_id"),
        {
            "sentence_no": number,
            "text": F.when(F.col("_several"), strip(F.col("_text"))).otherwise(F.col("_text")),
            "utterance_id": F.when(F.col("_several"), content_id(F.col("parent_id"), number)).otherwise(F.col("parent_id")),
        },
    ).drop("_several", "_pos", "_text")


def split_counts(atomic: DataFrame) -> DataFrame:
    return atomic.groupBy("episode_id").agg(
        F.countDistinct("parent_id").alias("utterances_in"), F.count(F.lit(1)).alias("atomic_out")
    )
