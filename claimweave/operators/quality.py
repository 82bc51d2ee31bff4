"""Quality of an episode: events to counters, score, grade, report, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave import fixed
from claimweave.functions.ordered import blocks, numbered, pages
from claimweave.params import DEFAULT, Params

KINDS = ["parsing_error", "api_error", "retry", "malformed", "mismatch", "warning"]
_COUNTERS = {
    "errors_count": ["parsing_error", "api_error"],
    "retries_count": ["retry"],
    "malformed_beliefs_count": ["malformed"],
    "registry_mismatches_count": ["mismatch"],
}


def event(rows: DataFrame, kind: str, at: Column | int = 0, message: Column | None = None) -> DataFrame:
    """Rows with an ``episode_id`` as quality events; ``at`` orders the messages of a kind."""
    return rows.select(
        "episode_id",
        F.lit(kind).alias("kind"),
        (F.lit(at) if isinstance(at, int) else at).cast("bigint").alias("at"),
        (F.lit(None) if message is None else message).cast("string").alias("message"),
    )


def counters(events: DataFrame, episodes: DataFrame) -> DataFrame:
    """One row per episode, also for those without any event."""
    counted = events.groupBy("episode_id").agg(
        *[F.count_if(F.col("kind").isin(*kinds)).alias(name) for name, kinds in _COUNTERS.items()]
    )
    zero = [F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in _COUNTERS]
    return episodes.select("episode_id").join(counted, "episode_id", "left").select("episode_id", *zero)


def messages(events: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Message lists per episode and kind, in order, in pages."""
    told = events.filter(F.col("message").isNotNull()).withColumn(
        "_at", F.concat_ws("|", F.lpad(F.col("at").cast("string"), 19, "0"), "message")
    )
    return pages(told, ["episode_id", "kind"], "_at", params.page_size, {"messages": F.col("message")}, blocks("at"))


def score() -> Column:
    """100 minus the points for each kind of event, not below 0."""
    points = fixed.PENALTIES
    lost = (
        F.col("errors_count") * points["errors"]
        + F.col("retries_count") * points["retries"]
        + F.col("malformed_beliefs_count") * points["malformed"]
        + F.col("registry_mismatches_count") * points["mismatches"]
    )
    return F.greatest(F.lit(0.0), 100.0 - lost)


def grade(value: Column) -> Column:
    out: Column | None = None
    for name, least in fixed.GRADES.items():
        out = F.when(value >= least, name) if out is None else out.when(value >= least, name)
    return out.otherwise("F")


def reports(counted: DataFrame, timings: DataFrame | None = None, created: str | None = None) -> DataFrame:
    """Score and grade per episode, with running time and time of the report.

    The message lists of an episode come from ``messages``: they have no bound,
    so they stay in pages of their own.
    """
    rows = counted.withColumn("quality_score", score())
    rows = rows.withColumn("quality_grade", grade(F.col("quality_score")))
    if timings is not None:
        rows = rows.join(timings.select("episode_id", "execution_time_seconds"), "episode_id", "left")
    else:
        rows = rows.withColumn("execution_time_seconds", F.lit(None).cast("double"))
    stamp = F.lit(created).cast("timestamp") if created else F.current_timestamp()
    return rows.withColumn("execution_time_seconds", F.coalesce("execution_time_seconds", F.lit(0.0))).withColumn(
        "timestamp", stamp
    )


def full_reports(report: DataFrame, told: DataFrame) -> DataFrame:
    """All twelve fields; an episode with more than a page of messages has several rows."""
    kinds = {"parsing_errors": "parsing_error", "api_errors": "api_error", "warnings": "warning"}
    lists = told.groupBy("episode_id", "page_no").agg(
        # a kind has one list per page, so max only picks it
        *[F.max(F.when(F.col("kind") == k, F.col("messages"))).alias(n) for n, k in kinds.items()]
    )
    empty = F.array().cast("array<string>")
    return report.join(lists, "episode_id", "left").select(
        *report.columns,
        F.coalesce("page_no", F.lit(0)).alias("page_no"),
        *[F.coalesce(F.col(n), empty).alias(n) for n in kinds],
    )


def summary(report: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Count, mean score, grades, errors and retries over a set of episodes; none in, none out."""
    rows = report if ids is None else report.join(ids.select("episode_id"), "episode_id", "left_semi")
    grades = ["A", "B", "C", "D", "F"]
    folded = rows.agg(
        F.count(F.lit(1)).alias("total_episodes"),
        F.avg("quality_score").alias("average_score"),
        F.sum("errors_count").alias("total_errors"),
        F.sum("retries_count").alias("total_retries"),
        *[F.count_if(F.col("quality_grade") == g).alias(f"grade_{g.lower()}") for g in grades],
    )
    return folded.filter(F.col("total_episodes") > 0)


def phase_rates(manifest: DataFrame) -> DataFrame:
    """Seconds each phase took and rows per minute, from the latest snapshot of each phase.

    An episode has at most one row per phase here, so the window is small.
    """
    order = _phase_order()
    last = manifest.groupBy("episode_id", "phase").agg(
        F.max("ts").alias("ts"), F.max_by("row_count", F.struct("ts", "row_count")).alias("row_count")
    )
    w = W.partitionBy("episode_id").orderBy("phase_ord")
    seconds = F.unix_micros("ts") / 1e6 - F.unix_micros(F.lag("ts").over(w)) / 1e6
    rows = last.withColumn("phase_ord", F.try_element_at(order, F.col("phase"))).filter(F.col("phase_ord").isNotNull())
    return rows.withColumn("duration_s", seconds).select(
        "episode_id", "phase", "phase_ord", "row_count", "duration_s",
        F.when(F.col("duration_s") > 0, F.col("row_count") * 60 / F.col("duration_s")).alias("rows_per_minute"),
    )


def _phase_order() -> Column:
    return F.create_map(*[F.lit(x) for i, p in enumerate(fixed.PHASES, 1) for x in (p, i)])


def every_nth(rows: DataFrame, keys: list[str], order: list[str], chunk: Column, params: Params = DEFAULT) -> DataFrame:
    """Every n-th row of each key: the rows on which progress is reported."""
    ranked = numbered(rows, keys, order, chunk, "event_no")
    return ranked.filter(F.col("event_no") % params.report_every == 0)


def graded_episodes(episodes: DataFrame, report: DataFrame) -> DataFrame:
    return episodes.join(report.select("episode_id", "quality_score", "quality_grade"), "episode_id", "left")
