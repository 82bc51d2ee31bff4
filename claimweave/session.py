"""Session settings and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a session may change at run time.  Skewed joins are split even when
# that costs one more shuffle, since any key may hold a third of the rows.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, as the cluster names it.

    Only a local master, where every executor is this machine, may fall back to
    a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    known = spark.sparkContext.getCheckpointDir()
    return known or tempfile.mkdtemp(prefix="run-")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df``; the copy survives the loss of executors."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As ``durable``, in compressed columns: for wide rows of which each reader takes some columns."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
