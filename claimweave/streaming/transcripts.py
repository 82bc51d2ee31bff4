"""New transcript files as a stream: accepted utterances and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimweave.operators import ingest
from claimweave.sources.transcripts import number_lines


def ingest_stream(lines: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Number and parse the lines of ``stream_lines`` into ``folder/utterances`` and ``folder/rejects``.

    The lines carry no ``episode_seq``; it is given by the episode table later.
    Each micro-batch writes a folder of its own and overwrites it when replayed,
    so no line is lost or doubled.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        lines = number_lines(batch).withColumn("episode_seq", F.lit(None).cast("bigint"))
        parsed = ingest.parse_lines(lines).persist()
        try:
            ingest.accepted(parsed).write.mode("overwrite").parquet(f"{folder}/utterances/batch={batch_id}")
            ingest.rejected(parsed).write.mode("overwrite").parquet(f"{folder}/rejects/batch={batch_id}")
        finally:
            parsed.unpersist()

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
