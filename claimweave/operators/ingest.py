"""Transcript lines to utterances: parsing, rejects, times, links, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions import clock
from claimweave.functions.ids import content_id
from claimweave.functions.ordered import blocks, numbered, running, ranged
from claimweave.functions.settle import settled
from claimweave.functions.text import strip


def parse_lines(lines: DataFrame) -> DataFrame:
    """Split every non-empty line into its parts and name the first broken rule.

    One pass, no shuffle.  ``error`` is NULL for accepted lines; the order of
    the rules is number of parts, speaker, start, end, start before end, text.
    """
    body = settled(lines, {"_body": strip(F.col("line"))}).filter(F.length("_body") > 0)
    cut = settled(body, {"_parts": F.split("_body", r"\|", -1)})

    def piece(i: int) -> Column:
        return strip(F.get("_parts", F.lit(i)))

    start, end = F.col("timestamp_start"), F.col("timestamp_end")
    cut = settled(
        cut,
        {
            "n_parts": F.size("_parts"),
            "speaker": piece(0),
            "timestamp_start": piece(1),
            "timestamp_end": piece(2),
            "text": piece(3),
        },
    )
    cut = settled(cut, {"_bad_start": clock.problem(start), "_bad_end": clock.problem(end)})
    cut = settled(
        cut,
        {
            "start_s": F.when(F.col("_bad_start").isNull(), clock.seconds(start)),
            "end_s": F.when(F.col("_bad_end").isNull(), clock.seconds(end)),
        },
    )
    order = F.when(
        F.col("start_s") >= F.col("end_s"),
        F.concat(F.lit("Start time "), start, F.lit(" must be before end time "), end),
    )
    # The wording of each rejection.
    reason = F.coalesce(
        F.when(
            F.col("n_parts") != 4,
            F.concat(F.lit("Invalid line format. Expected 4 parts, got "), F.col("n_parts").cast("string")),
        ),
        F.when(F.length("speaker") == 0, F.lit("Speaker cannot be empty")),
        F.col("_bad_start"),
        F.col("_bad_end"),
        order,
        F.when(F.length("text") == 0, F.lit("Utterance text cannot be empty")),
    )
    cut = settled(cut, {"_reason": reason})
    numbered_reason = F.concat(F.lit("Line "), F.col("line_no").cast("string"), F.lit(": "), F.col("_reason"))
    return cut.withColumn("error", numbered_reason).drop("_body", "_parts", "_bad_start", "_bad_end", "_reason")


def accepted(parsed: DataFrame) -> DataFrame:
    """Utterance rows of the lines that break no rule."""
    return parsed.filter(F.col("error").isNull()).select(
        content_id("episode_id", "line_no").alias("utterance_id"),
        "episode_id",
        "episode_seq",
        "speaker",
        "start_s",
        "end_s",
        "timestamp_start",
        "timestamp_end",
        "line_no",
        F.lit(0).alias("sentence_no"),
        "text",
        F.lit(None).cast("string").alias("audio_snippet_uri"),
    )


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).select("episode_id", "episode_seq", "line_no", "line", "error")


def episodes(utterances_or_lines: DataFrame, run_date: str, folder: str = "") -> DataFrame:
    """One row per episode id seen, with the default title and path."""
    return utterances_or_lines.groupBy("episode_id").agg(F.min("episode_seq").alias("episode_seq")).select(
        "episode_id",
        "episode_seq",
        F.col("episode_id").alias("title"),
        F.to_date(F.lit(run_date)).alias("date"),
        F.concat(F.lit(folder), F.col("episode_id"), F.lit(".txt")).alias("transcript_path"),
        F.lit(None).cast("string").alias("audio_uri"),
    )


def number_episodes(lines: DataFrame) -> DataFrame:
    """Add ``episode_seq``, 0, 1, 2, ... in the order of the episode ids, without gaps.

    Only the distinct ids are numbered.  Callers with dates bring their own numbers.
    """
    ids = ranged(lines.select("episode_id").distinct(), "episode_id")
    ranked = numbered(ids, [], ["episode_id"], F.col("_range"), "_n")
    return lines.join(ranked.select("episode_id", (F.col("_n") - 1).alias("episode_seq")), "episode_id")


def line_counts(lines: DataFrame) -> DataFrame:
    """Per episode: lines read (with blank ones), accepted, rejected."""
    parsed = parse_lines(lines).groupBy("episode_id").agg(
        F.count_if(F.col("error").isNull()).alias("lines_accepted"),
        F.count_if(F.col("error").isNotNull()).alias("lines_rejected"),
    )
    read = lines.groupBy("episode_id").agg(F.max("line_no").cast("bigint").alias("lines_read"))
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("lines_accepted", "lines_rejected")]
    return read.join(parsed, "episode_id", "left").select("episode_id", "lines_read", *zero)


def durations(utterances: DataFrame) -> DataFrame:
    return utterances.select(
        "utterance_id", "episode_id", "speaker", "start_s", "end_s", (F.col("end_s") - F.col("start_s")).alias("duration_s")
    )


def talk_time(utterances: DataFrame) -> DataFrame:
    """Seconds spoken per episode and speaker, also as HH:MM:SS."""
    total = utterances.groupBy("episode_id", "speaker").agg(
        F.count(F.lit(1)).alias("utterances"), F.sum(F.col("end_s") - F.col("start_s")).cast("bigint").alias("talk_s")
    )
    return total.withColumn("talk_time", clock.render(F.col("talk_s")))


def repair_starts(rows: DataFrame) -> DataFrame:
    """Fill missing starts with the previous start of the episode plus one second.

    A run of missing starts counts up from the last known one.  Rows before the
    first known start stay NULL.
    """
    order, chunk = ["line_no"], blocks("line_no")
    ranked = numbered(rows, ["episode_id"], order, chunk, "_rn")
    seen = running(
        ranked,
        ["episode_id"],
        order,
        chunk,
        {"_known": ("max", F.when(F.col("start_s").isNotNull(), F.struct("_rn", "start_s")))},
    )
    filled = F.col("_known.start_s") + (F.col("_rn") - F.col("_known._rn"))
    return seen.withColumn("start_filled_s", filled.cast("bigint")).withColumn(
        "repaired", F.col("start_s").isNull() & F.col("start_filled_s").isNotNull()
    ).drop("_rn", "_known")


def audio_links(utterances: DataFrame, episodes: DataFrame, base_url: str = "", ranged: bool = False) -> DataFrame:
    """``file#t=start`` or ``file#t=start,end``; NULL where the episode has no audio."""
    when = F.col("start_s").cast("string")
    if ranged:
        when = F.concat_ws(",", when, F.col("end_s").cast("string"))
    link = F.when(F.col("audio_uri").isNotNull(), F.concat(F.lit(base_url), F.col("audio_uri"), F.lit("#t="), when))
    return utterances.drop("audio_snippet_uri").join(
        episodes.select("episode_id", "audio_uri"), "episode_id", "left"
    ).withColumn("audio_snippet_uri", link).drop("audio_uri")
