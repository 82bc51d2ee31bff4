"""Registry upkeep as a stream of beliefs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimweave.functions.text import norm_tokens
from claimweave.operators import canonical, registry, similar
from claimweave.params import DEFAULT, Params
from claimweave.session import durable
from claimweave.sources import snapshots, stores


def added(tables: dict[str, DataFrame], mentions: DataFrame) -> dict[str, DataFrame]:
    """What mentions (see ``canonical.mentions``) add to a registry, as tables of their own.

    Beliefs already stored are left out first, so a replayed batch adds nothing.
    The sequence of aliases and history is the episode number.
    """
    stored = tables["member"].select("canonical_id", "belief_id")
    fresh = durable(mentions.join(stored, ["canonical_id", "belief_id"], "left_anti"))
    summary = canonical.summaries(fresh).drop("norm_text")
    names = registry.alias_rows(
        fresh.select(F.col("belief_text"), "canonical_id", "episode_seq"), "belief_text", F.col("episode_seq")
    )
    seen = fresh.select("canonical_id", "episode_id", F.col("episode_seq").alias("seq"))
    return {
        "canonical": summary.select(tables["canonical"].columns),
        "member": canonical.members(fresh),
        "alias": registry.latest(names, ["alias_text"], "seq"),
        "history": registry.append_history(seen.limit(0), seen),
        "embedding": embeddings(summary, tables["embedding"]),
    }


def merge_batch(tables: dict[str, DataFrame], mentions: DataFrame) -> dict[str, DataFrame]:
    """Registry after adding mentions."""
    return registry.merge_tables([tables, added(tables, mentions)])


def rebuild(spark: SparkSession, folder: str, phases: str) -> int | None:
    """A new registry version made from the stored beliefs of all episodes alone; None if none are stored.

    Takes the newest snapshots of the canonical phase, whatever state the registry is in.
    """
    mentions = snapshots.load(spark, phases, "canonical_beliefs")
    if mentions is None:
        return None
    before = stores.registry_version(spark, folder)
    version = 0 if before is None else before + 1
    stores.save_registry(merge_batch(stores.empty_registry(spark), mentions), folder, version)
    return version


def embeddings(summary: DataFrame, stored: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Text embeddings of the canonicals that have none yet."""
    new = registry.missing_embeddings(summary.select("canonical_id", "canonical_text"), stored)
    return similar.embed_text(new, norm_tokens(F.col("canonical_text"), params)).select("canonical_id", "embedding")


def write_batch(batch: DataFrame, batch_id: int, folder: str, stream: str) -> None:
    spark = batch.sparkSession
    if not stores.has_batch(spark, folder, stream, batch_id):
        stores.add_to_registry(spark, added(stores.load_registry(spark, folder), batch), folder, stream, batch_id)


def registry_stream(mentions: DataFrame, folder: str, checkpoint: str, params: Params = DEFAULT) -> StreamingQuery:
    """Add each micro-batch to the newest registry version: what is written follows the batch, not the registry.

    Whatever is stored stays: a registry saved by a batch job, or by another stream
    with a checkpoint of its own, is built on.  The pointer of a version names the
    stream (its checkpoint) and the batch, so a batch that is played again after its
    version was finished is left out, and one that broke off starts anew.  One stream
    at a time may write to a folder.
    """
    return (
        mentions.writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, folder, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
