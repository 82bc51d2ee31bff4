"""Transcript files to numbered lines, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions.ordered import numbered
from claimweave.operators.contracts import bad_episode_id


def _stem() -> Column:
    return F.regexp_extract("transcript_path", r"([^/]+?)(\.[^./]*)?$", 1)


def check_names(spark: SparkSession, path: str) -> None:
    """Refuse file names that make no episode id, and two files that make the same.

    Only the names are listed; the contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("transcript_path"))
    named = files.select(_stem().alias("episode_id"), "transcript_path")
    bad = named.filter(bad_episode_id(F.col("episode_id"))).first()
    if bad:
        raise ValueError(f"no episode id: {bad['transcript_path']}")
    twice = named.groupBy("episode_id").agg(F.min("transcript_path").alias("a"), F.max("transcript_path").alias("b")).filter("a <> b").first()
    if twice:
        raise ValueError(f"one episode id for two files: {twice['a']} and {twice['b']}")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """All transcript files under ``path``; the file stem is the episode id, and must be one of its own.

    Files are read in splits, so one huge file is spread over many tasks.  The
    offset of a split is a chunk of the file's line order; lines are numbered per
    split and the counts of the earlier splits are added.
    """
    check_names(spark, path)
    return number_lines(_lines(spark.read.option("recursiveFileLookup", True).text(path)))


def _lines(read: DataFrame) -> DataFrame:
    """Lines of files with the offset of the split that each was read in."""
    path = F.col("_metadata.file_path").alias("transcript_path")
    named = read.select(path, F.col("_metadata.file_block_start").alias("_at"), F.col("value").alias("line"))
    return named.select(_stem().alias("episode_id"), "*")


def number_lines(lines: DataFrame) -> DataFrame:
    """Number the lines of ``_lines`` by file; not for the plan of a stream, but for its batches."""
    placed = lines.withColumn("_in_task", F.monotonically_increasing_id())
    return numbered(placed, ["transcript_path"], ["_in_task"], F.col("_at"), "line_no").select(
        "episode_id", "transcript_path", "line_no", "line"
    )


def explode_files(files: DataFrame) -> DataFrame:
    """Rows holding a whole file each (``value``) to one row per line; blank lines count."""
    body = F.regexp_replace("value", "(\r\n|\n|\r)$", "")
    return files.filter(F.length("value") > 0).select(
        _stem().alias("episode_id"), "transcript_path", F.posexplode(F.split(body, "\r\n|\n|\r")).alias("_pos", "line")
    ).select("episode_id", "transcript_path", (F.col("_pos") + 1).cast("bigint").alias("line_no"), "line")


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """The same for files known to be small: no numbering pass, one file per row."""
    check_names(spark, path)
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return explode_files(files.withColumn("transcript_path", F.col("_metadata.file_path")))


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Lines of newly arriving files, for ``ingest_stream``.

    A file comes whole in one trigger, but in splits, so that a huge one is read by many
    tasks; its lines are numbered within the trigger.
    """
    return _lines(spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path))
