"""How canonical beliefs change from episode to episode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.ids import content_id
from claimweave.functions.ordered import blocks, pages, previous
from claimweave.params import DEFAULT, Params


def changes(cells: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Each cell against the latest earlier one of the same canonical.

    kind is new, strengthening, weakening or NULL (stable).  A change in mentions
    decides only when the change in conviction stays below its threshold.
    """
    kept = cells.select("canonical_id", "episode_id", "episode_seq", "conviction_avg", "frequency")
    rows = previous(
        kept, ["canonical_id"], "episode_seq", blocks("episode_seq"), ["episode_id", "conviction_avg", "frequency"]
    )
    d_conv = F.round(F.col("conviction_avg") - F.col("prev.conviction_avg"), 9)
    d_freq = F.col("frequency") - F.col("prev.frequency")
    by_conv = F.abs(d_conv) >= params.drift_conviction
    by_freq = F.abs(d_freq) >= params.drift_frequency
    kind = (
        F.when(F.col("prev").isNull(), "new")
        .when(by_conv, F.when(d_conv > 0, "strengthening").otherwise("weakening"))
        .when(by_freq, F.when(d_freq > 0, "strengthening").otherwise("weakening"))
    )
    size = (
        F.when(F.col("prev").isNull(), F.col("conviction_avg"))
        .when(by_conv, F.abs(d_conv))
        .otherwise(F.abs(d_freq) / F.greatest("frequency", "prev.frequency"))
    )
    return rows.withColumn("kind", kind).withColumn("size", F.least(F.lit(1.0), size))


def drops(cells: DataFrame, episodes: DataFrame) -> DataFrame:
    """Present in an episode and absent in the next one, which must exist.

    An anti-join on (canonical, next number): no window, and no key is hot.
    """
    here = cells.select("canonical_id", "episode_id", "episode_seq", "conviction_avg", "frequency")
    later = cells.select("canonical_id", (F.col("episode_seq") - 1).alias("episode_seq"))
    following = episodes.select((F.col("episode_seq") - 1).alias("episode_seq"), F.col("episode_id").alias("next_episode"))
    return here.join(later, ["canonical_id", "episode_seq"], "left_anti").join(following, "episode_seq")


def events(
    cells: DataFrame, episodes: DataFrame, contradictions: DataFrame | None = None, params: Params = DEFAULT
) -> DataFrame:
    """All drift events.  ``episode_seq`` must number the episodes without gaps.

    With contradictions, a strengthening or weakening becomes a reversal when the
    canonical takes part in a reversal that shows in this very episode.
    """
    moved = changes(cells, params).filter(F.col("kind").isNotNull())
    if contradictions is not None:
        sides = F.explode(F.array("belief_a_id", "belief_b_id")).alias("canonical_id")
        turned = (
            contradictions.filter("is_reversal")
            .select(sides, F.col("later_seq").alias("episode_seq"), "opposition_score")
            .groupBy("canonical_id", "episode_seq")
            .agg(F.max("opposition_score").alias("_score"))
        )
        moved = moved.join(turned, ["canonical_id", "episode_seq"], "left")
        turns = F.col("_score").isNotNull() & (F.col("kind") != "new")
        moved = moved.withColumns(
            {
                "size": F.when(turns, F.least(F.lit(1.0), F.col("_score"))).otherwise(F.col("size")),
                "kind": F.when(turns, "reversal").otherwise(F.col("kind")),
            }
        )
    changed = moved.select(
        "canonical_id",
        F.col("kind").alias("drift_type"),
        F.col("size").alias("magnitude"),
        F.coalesce("prev.episode_id", "episode_id").alias("start_episode"),
        F.col("episode_id").alias("end_episode"),
        F.col("episode_seq").alias("event_seq"),
        F.col("prev.conviction_avg").alias("conviction_before"),
        F.col("conviction_avg").alias("conviction_after"),
        F.col("prev.frequency").alias("frequency_before"),
        F.col("frequency").alias("frequency_after"),
    )
    gone = drops(cells, episodes).select(
        "canonical_id",
        F.lit("dropped").alias("drift_type"),
        F.least(F.lit(1.0), F.col("conviction_avg")).alias("magnitude"),
        F.col("episode_id").alias("start_episode"),
        F.col("next_episode").alias("end_episode"),
        (F.col("episode_seq") + 1).alias("event_seq"),
        F.col("conviction_avg").alias("conviction_before"),
        F.lit(None).cast("double").alias("conviction_after"),
        F.col("frequency").alias("frequency_before"),
        F.lit(None).cast("bigint").alias("frequency_after"),
    )
    both = changed.unionByName(gone)
    return both.select(
        content_id("canonical_id", "end_episode", "drift_type").alias("drift_id"),
        *both.columns,
        F.array("start_episode", "end_episode").alias("episode_range"),
    )


def counts(drifted: DataFrame) -> DataFrame:
    return drifted.groupBy("drift_type").agg(F.count(F.lit(1)).alias("events"))


def timeline(drifted: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Events of each canonical in order, in pages."""
    rows = drifted.withColumn(
        "_at", F.concat_ws("|", F.lpad(F.col("event_seq").cast("string"), 19, "0"), "drift_type")
    )
    item = F.struct("event_seq", "drift_type", "start_episode", "end_episode", "magnitude")
    return pages(rows, ["canonical_id"], "_at", params.page_size, {"events": item}, blocks("event_seq"))
