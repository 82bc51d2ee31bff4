"""Checks on ids, links, records and references, as tables of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave import fixed
from claimweave.functions import clock
from claimweave.functions.text import blank


def bad_episode_id(c: Column) -> Column:
    return ~F.coalesce(c.rlike(fixed.EPISODE_ID), F.lit(False))


def bad_audio_uri(c: Column) -> Column:
    """``file#t=s`` or ``file#t=s,e`` with one mark and a file name."""
    parts = F.split(c, fixed.AUDIO_MARK)
    good = (F.size(parts) == 2) & (F.length(F.get(parts, F.lit(0))) > 0) & F.get(parts, F.lit(1)).rlike(fixed.AUDIO_TIME)
    return ~F.coalesce(good, F.lit(False))


def bad_date(c: Column) -> Column:
    return F.try_to_date(c, "yyyy-MM-dd").isNull()


def bad_path(c: Column) -> Column:
    return F.coalesce(F.length(c), F.lit(0)) == 0


def out_of_range(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return ~F.coalesce(c.between(low, high) & ~F.isnan(c.cast("double")), F.lit(False))


def empty(c: Column) -> Column:
    return c.isNull() | blank(c)


def violations(rows: DataFrame, entity: str, key: str, rules: dict[str, Column]) -> DataFrame:
    """(entity, id, rule) for each broken rule: one pass, then an explode of the few that break."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))
    return rows.select(
        F.lit(entity).alias("entity"), F.col(key).cast("string").alias("id"), F.explode(broken).alias("rule")
    )


def episode_rules() -> dict[str, Column]:
    return {
        "episode_id": bad_episode_id(F.col("episode_id")),
        "date": bad_date(F.col("date").cast("string")),
        "transcript_path": bad_path(F.col("transcript_path")),
        "quality_score": F.col("quality_score").isNotNull() & out_of_range(F.col("quality_score"), 0, 100),
        "quality_grade": F.col("quality_grade").isNotNull() & ~F.col("quality_grade").isin("A", "B", "C", "D", "F"),
    }


def utterance_rules() -> dict[str, Column]:
    return {
        "speaker": empty(F.col("speaker")),
        "timestamp_start": clock.to_seconds(F.coalesce("timestamp_start", F.lit(""))).isNull(),
        "timestamp_end": clock.to_seconds(F.coalesce("timestamp_end", F.lit(""))).isNull(),
        "text": empty(F.col("text")),
    }


def belief_rules() -> dict[str, Column]:
    flags = F.map_values("extraction_flags")
    return {
        "belief_text": empty(F.col("belief_text")),
        "original_quote": empty(F.col("original_quote")),
        "confidence": out_of_range(F.col("confidence")),
        "extraction_flags": ~F.coalesce(F.exists(flags, lambda v: F.coalesce(v, F.lit(False))), F.lit(False)),
    }


def canonical_rules() -> dict[str, Column]:
    return {
        name: F.coalesce(F.size(name), F.lit(0)) <= 0
        for name in ("belief_ids", "source_utterance_ids", "example_quotes")
    }


def cluster_rules() -> dict[str, Column]:
    return {
        "ontology_level": ~F.coalesce(F.col("ontology_level").isin(*fixed.TIERS), F.lit(False)),
        "size": F.col("size") != F.col("members"),
        "members": F.col("members") < 1,
    }


def weight_rules() -> dict[str, Column]:
    return {
        "conviction_avg": out_of_range(F.col("conviction_avg")),
        "frequency": F.col("frequency") < 0,
        "stability_score": out_of_range(F.col("stability_score")),
    }


def contradiction_rules() -> dict[str, Column]:
    return {
        "opposition_score": out_of_range(F.col("opposition_score")),
        "type": ~F.coalesce(F.col("type").isin(*fixed.CONTRADICTION_KINDS), F.lit(False)),
        "is_reversal": F.col("is_reversal") & (F.col("type") != "within_speaker"),
    }


def drift_rules() -> dict[str, Column]:
    return {
        "drift_type": ~F.coalesce(F.col("drift_type").isin(*fixed.DRIFT_KINDS), F.lit(False)),
        "magnitude": out_of_range(F.col("magnitude")),
        "episode_range": F.size("episode_range") != 2,
    }


def report_rules() -> dict[str, Column]:
    counts = ("errors_count", "retries_count", "malformed_beliefs_count", "registry_mismatches_count")
    return {
        "quality_score": out_of_range(F.col("quality_score"), 0, 100),
        "quality_grade": ~F.coalesce(F.col("quality_grade").isin("A", "B", "C", "D", "F"), F.lit(False)),
        **{c: F.col(c) < 0 for c in counts},
        "execution_time_seconds": F.col("execution_time_seconds") < 0,
    }


def link_violations(values: DataFrame) -> DataFrame:
    """Id, link, date, path and score checks on (id, episode_id, audio_uri, date, path, score)."""
    return violations(
        values,
        "reference",
        "id",
        {
            "episode_id": bad_episode_id(F.col("episode_id")),
            "audio_uri": bad_audio_uri(F.col("audio_uri")),
            "date": bad_date(F.col("date")),
            "path": bad_path(F.col("path")),
            "score": out_of_range(F.col("score")),
        },
    )


def orphans(edge: str, child: DataFrame, key: str, reference: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose non-NULL ``reference`` names no row of ``parent``."""
    refs = child.filter(F.col(reference).isNotNull()).select(
        F.lit(edge).alias("edge"), F.col(key).cast("string").alias("id"), F.col(reference).alias("missing")
    )
    return refs.join(parent.select(F.col(parent_key).alias("missing")), "missing", "left_anti").select("edge", "id", "missing")


def repeated_ids(rows: DataFrame, entity: str, key: str) -> DataFrame:
    return rows.groupBy(F.col(key).cast("string").alias("id")).agg(F.count(F.lit(1)).alias("times")).filter(
        F.col("times") > 1
    ).select(F.lit(entity).alias("entity"), "id", "times")
