"""What the operators of this folder share: tables, written intermediate results, Arrow text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.session import shared_dir

# what separates words in every operator of this folder that counts or compares words
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# rows and bytes that one Arrow batch carries to a Python worker, so that long texts do not add up
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4096", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def limited(spark: SparkSession) -> SparkSession:
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster shares."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut, columns can be pruned."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(c: Column | str = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string column, and where each row starts (one more entry at the end); NULL is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose texts have about ``limit`` bytes; a longer text makes a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.diff(utf8(column)[1])
        before = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        cuts = np.flatnonzero(np.diff(before // limit)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
