"""Phase snapshots and their manifest.

A snapshot of a phase is a parquet folder of its own run, with the rows spread
over a fixed number of episode buckets (a folder per episode would drown the file
system in small files).  The manifest row per (episode, phase) is written after the
data, so a run that dies half-way is never seen.

A run's folder holds numbered versions.  The one in force is the highest that is
complete, as its ``_SUCCESS`` file says, which is written last and at once: so a
repeated run or a purge writes the next version, whereby it takes over, and removes
older ones after that.  Whatever stops it in between, one whole version is in force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave import fixed

BUCKETS = 64
MANIFEST = "episode_id string, phase string, run_id string, ts timestamp, row_count bigint, stats map<string,double>"


def bucket(c="episode_id"):
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")


def save(data: DataFrame, folder: str, phase: str, run_id: str, ts: str, stats: DataFrame | None = None) -> None:
    """Write all episodes in ``data`` as the new snapshot of ``phase``."""
    if phase not in fixed.PHASES:
        raise ValueError(f"unknown phase {phase}")
    spark = data.sparkSession
    where = f"{folder}/data/phase={phase}/run_id={run_id}"
    _replace(data, where)
    counted = spark.read.parquet(_in_force(spark, where)).groupBy("episode_id").agg(F.count(F.lit(1)).alias("row_count"))
    if stats is not None:
        counted = counted.join(stats.select("episode_id", "stats"), "episode_id", "left")
    else:
        counted = counted.withColumn("stats", F.create_map().cast("map<string,double>"))
    rows = counted.select(
        "episode_id", F.lit(phase).alias("phase"), F.lit(run_id).alias("run_id"),
        F.lit(ts).cast("timestamp").alias("ts"), "row_count", "stats",
    )
    rows.write.mode("overwrite").parquet(f"{folder}/manifest/written={phase}-{run_id}")


def _write_run(data: DataFrame, where: str) -> None:
    rows = data.withColumn("episode_bucket", bucket())
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("episode_bucket").parquet(where)


def _versions(spark: SparkSession, where: str) -> list[tuple[int, bool]]:
    """(number, complete) of the versions of a run, ascending."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(where).getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path(where)):
        return []
    names = [str(x.getPath().getName()) for x in system.listStatus(path(where))]
    numbers = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
    return [(n, system.exists(path(f"{where}/version={n}/_SUCCESS"))) for n in numbers]


def _in_force(spark: SparkSession, where: str) -> str | None:
    """Folder of the highest complete version of a run; None when there is none."""
    whole = [n for n, complete in _versions(spark, where) if complete]
    return f"{where}/version={whole[-1]}" if whole else None


def _replace(data: DataFrame, where: str) -> None:
    """Write ``data`` as the next version of a run, then remove the others; ``data`` may be read from the one in force."""
    spark = data.sparkSession
    _write_run(data, f"{where}/version={max([n for n, _ in _versions(spark, where)], default=0) + 1}")
    _tidy(spark, where)


def _tidy(spark: SparkSession, where: str) -> None:
    """Remove all versions but the one in force."""
    force = _in_force(spark, where)
    for n, _ in _versions(spark, where):
        if force and f"{where}/version={n}" != force:
            _remove(spark, f"{where}/version={n}")


def _remove(spark: SparkSession, where: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """All manifest rows, without the deleted ones; empty when nothing was saved."""
    if not _exists(spark, f"{folder}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").drop("written")
    if not _exists(spark, f"{folder}/deleted"):
        return rows
    gone = spark.read.schema("episode_id string, phase string, run_id string").parquet(f"{folder}/deleted")
    return rows.join(gone, ["episode_id", "phase", "run_id"], "left_anti")


def load(spark: SparkSession, folder: str, phase: str) -> DataFrame | None:
    """Latest snapshot of each episode; None when there is none.

    Only folders of runs that hold a latest snapshot are read (their names come
    from the manifest); unreadable files raise.
    """
    last = latest(manifest(spark, folder).filter(F.col("phase") == phase)).select("episode_id", "run_id")
    runs = sorted(r["run_id"] for r in last.select("run_id").distinct().collect())
    if not runs:
        return None
    where = f"{folder}/data/phase={phase}"
    paths = {r: _in_force(spark, f"{where}/run_id={r}") for r in runs}
    if lost := [r for r, path in paths.items() if path is None]:
        raise FileNotFoundError(f"phase {phase} has no complete version of runs {lost}")
    schema = spark.read.parquet(paths[runs[0]]).schema.add("run_id", "string").add("version", "integer")
    rows = spark.read.schema(schema).option("basePath", where).parquet(*paths.values())
    return rows.join(last, ["episode_id", "run_id"], "left_semi").drop("run_id", "version", "episode_bucket")


def latest(rows: DataFrame) -> DataFrame:
    """Newest manifest row per episode and phase."""
    rest = ["run_id", "ts", "row_count"]
    return rows.groupBy("episode_id", "phase").agg(F.max(F.struct("ts", "run_id", "row_count")).alias("m")).select(
        "episode_id", "phase", *[F.col(f"m.{c}").alias(c) for c in rest]
    )


def resume_points(rows: DataFrame, episodes: DataFrame) -> DataFrame:
    """Last finished and next phase of every episode; an episode without snapshots starts at the first."""
    order = F.create_map(*[F.lit(x) for i, p in enumerate(fixed.PHASES, 1) for x in (p, i)])
    last = (
        rows.withColumn("ord", F.try_element_at(order, F.col("phase")))
        .filter(F.col("ord").isNotNull())
        .groupBy("episode_id")
        .agg(F.max("ord").alias("ord"))
    )
    names = F.array(*[F.lit(p) for p in fixed.PHASES])
    done = F.coalesce("ord", F.lit(0))
    return episodes.select("episode_id").join(last, "episode_id", "left").select(
        "episode_id",
        F.get(names, done - 1).alias("last_phase"),
        F.get(names, done).alias("next_phase"),
    )


def pending(rows: DataFrame, episodes: DataFrame, phase: str) -> DataFrame:
    """Episodes that still need ``phase``."""
    done = rows.filter(F.col("phase") == phase).select("episode_id")
    return episodes.join(done, "episode_id", "left_anti")


def expired(rows: DataFrame, as_of: str, days: int) -> DataFrame:
    """Manifest rows of episodes whose newest snapshot is older than ``days``; none when days <= 0."""
    if days <= 0:
        return rows.limit(0)
    cutoff = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    old = rows.groupBy("episode_id").agg(F.max("ts").alias("newest")).filter(F.col("newest") < cutoff)
    return rows.join(old.select("episode_id"), "episode_id", "left_semi")


def delete(spark: SparkSession, folder: str, rows: DataFrame, mark: str) -> None:
    """Hide the snapshots named by manifest rows (one phase, a whole episode, or ``expired``)."""
    rows.select("episode_id", "phase", "run_id").write.mode("overwrite").parquet(f"{folder}/deleted/mark={mark}")


def purge(spark: SparkSession, folder: str) -> int:
    """Remove the rows of hidden snapshots from the files; returns the number of runs with hidden snapshots.

    A run without any snapshot left is unlinked.  Any other that still holds hidden rows
    gets a new version without them.  A purge that was stopped has lost nothing: until the
    new version is complete the old one is in force, and the next purge finishes the work.
    """
    if not _exists(spark, f"{folder}/deleted"):
        return 0
    gone = spark.read.schema("episode_id string, phase string, run_id string").parquet(f"{folder}/deleted")
    alive = manifest(spark, folder).select("phase", "run_id", F.lit(True).alias("alive")).distinct()
    touched = gone.select("phase", "run_id").distinct().join(alive, ["phase", "run_id"], "left").collect()  # a row for each run
    for r in touched:
        where = f"{folder}/data/phase={r['phase']}/run_id={r['run_id']}"
        force = _in_force(spark, where)
        if not r["alive"]:
            _remove(spark, where)
        elif force:
            hidden = gone.filter((F.col("phase") == r["phase"]) & (F.col("run_id") == r["run_id"])).select("episode_id").distinct()
            rows = spark.read.parquet(force).drop("episode_bucket")
            if rows.join(hidden, "episode_id", "left_semi").isEmpty():
                _tidy(spark, where)
            else:
                _replace(rows.join(hidden, "episode_id", "left_anti"), where)
    return len(touched)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
