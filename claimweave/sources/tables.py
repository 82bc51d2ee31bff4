"""The given parquet tables, and the inputs that Spark derives from them.

The given tables hold conversations, events and vectors, but no diarized
transcripts, model responses or call logs.  The functions below derive those
from whole tables, with a few per cent of defective rows in each, so that every
rejection rule meets data.  Remainders of hashes choose *which defect* a row
carries; they never choose which rows are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave import fixed
from claimweave.functions import clock
from claimweave.functions.ids import hash16
from claimweave.functions.ordered import running
from claimweave.functions.settle import settled
from claimweave.functions.text import one_space


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def episode_name(n: Column) -> Column:
    return F.concat(F.lit("ep_"), F.lpad(n.cast("string"), 6, "0"))


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """Conversation turns as lines ``SPEAKER | start | end | text``."""
    start, end, kind, who, said = (F.col(c) for c in ("_start", "_end", "_kind", "_who", "_said"))
    turns = settled(
        conversations,
        {
            "_start": clock.render(F.col("turn") * 60),
            "_end": clock.render(F.col("turn") * 60 + 30),
            "_kind": (F.col("conv_id") * 7 + F.col("turn")) % 23,
            "_who": F.upper("role"),
            "_said": F.regexp_replace("text", r"\s+", " "),
        },
    )

    def line(*parts: Column) -> Column:
        return F.concat_ws(" | ", *parts)

    return turns.select(
        episode_name(F.col("conv_id")).alias("episode_id"),
        F.col("conv_id").alias("episode_seq"),
        (F.col("turn") + 1).alias("line_no"),
        F.when(kind == 0, line(who, start, start, said))
        .when(kind == 1, line(who, start, said))
        .when(kind == 2, line(who, start, end, F.concat(F.lit("a | b "), said)))
        .when(kind == 3, line(F.lit(""), start, end, said))
        .when(kind == 4, line(who, F.lit("25:00:00"), end, said))
        .when(kind == 5, line(who, start, F.substring(end, 2, 7), said))
        .when(kind == 6, line(who, start, end, F.lit("")))
        .otherwise(line(who, start, end, said))
        .alias("line"),
    )


def _flag(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(f) for f in fixed.FLAGS]), (n + 1).cast("int"))


def _claim_json(pair: Column, h: Column) -> Column:
    text = F.concat(F.when(h % 13 == 0, "not ").otherwise(""), pair)
    number = F.format_string("%.2f", F.when(h % 10 == 9, 1.5).otherwise((h % 101) / 100.0))
    one, two = _flag(h % 11), _flag(F.floor(h / 11) % 11)
    value = (
        F.when(h % 31 == 7, '"maybe"').when(h % 41 == 13, '"true"').otherwise("true")
    )
    flags = F.concat(
        F.lit('"'), one, F.lit('": '), value, F.when(one != two, F.concat(F.lit(', "'), two, F.lit('": false'))).otherwise("")
    )
    return F.when(h % 43 == 17, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(
        F.concat(
            F.lit('{"belief_text": "'), text, F.lit('", "confidence": '),
            F.when(h % 17 == 3, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number),
            F.when(h % 29 == 5, ', "original_quote": null')
            .when(h % 3 == 0, F.concat(F.lit(', "original_quote": "'), text, F.lit('"')))
            .otherwise(""),
            F.when(h % 37 == 11, "").otherwise(F.concat(F.lit(', "extraction_flags": {'), flags, F.lit("}"))),
            F.lit("}"),
        )
    )


def responses(utterances: DataFrame) -> DataFrame:
    """What a stand-in model answers: one claim per pair of words, over the whole text."""
    words = F.split(one_space(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}\s]", " ")), " ")
    rows = settled(utterances.select("utterance_id", "text"), {"_w": words, "_h": hash16(F.col("utterance_id"))})
    pairs = F.transform(
        F.sequence(F.lit(1), F.ceil(F.size("_w") / 2).cast("int")),
        lambda o: F.struct(
            F.array_join(F.slice("_w", 2 * o - 1, 2), " ").alias("pair"),
            hash16(F.concat_ws("|", "utterance_id", o.cast("string"))).alias("h"),
        ),
    )
    claims = F.transform(pairs, lambda p: _claim_json(p["pair"], p["h"]))
    whole = F.col("_h")
    answer = (
        F.when(whole % 97 == 0, "{not json")
        .when(whole % 10 == 8, '{"beliefs": []}')
        .when(whole % 89 == 1, '{"note": "nothing found"}')
        .when(whole % 83 == 2, "[1]")
        .otherwise(F.concat(F.lit('{"beliefs": ['), F.array_join(claims, ", "), F.lit("]}")))
    )
    return settled(rows, {"response": answer}).select("utterance_id", "response")


def calls(events: DataFrame) -> DataFrame:
    """Events as a log of model calls.

    The attempts of a caller follow each other in time; an item ends with a
    success, with a failure that is not tried again, or with its fourth failure.
    """
    failed = F.col("event_type") == "error"
    log = events.select(
        F.col("event_id").alias("call_id"),
        F.col("user_id").alias("caller"),
        episode_name(F.col("user_id")).alias("episode_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.floor(F.col("value") * 10).cast("bigint").alias("tokens"),
        (F.col("value") / 100).alias("latency"),
        (~failed).alias("success"),
        F.when(
            failed,
            F.element_at(
                F.array(F.lit("429 rate_limit"), F.lit("Request timed out"), F.lit("HTTP 503"), F.lit("bad request")),
                (F.col("event_id") % 4 + 1).cast("int"),
            ),
        ).alias("error"),
    )
    ends = F.col("success") | F.coalesce(F.col("error") == "bad request", F.lit(False))
    log = running(
        log, ["caller"], ["ts", "call_id"], F.col("ts").cast("date"),
        {"_n": ("sum", F.lit(1).cast("bigint")), "_done": ("sum", ends.cast("bigint"))},
        inclusive=False,
    )
    # one run of failures, up to the call that ends it, is a group
    position = F.col("_n") - F.min("_n").over(W.partitionBy("caller", "_done"))
    return log.withColumn("_at", position).withColumn(
        "item_id",
        F.concat_ws("-", F.col("caller").cast("string"), F.col("_done").cast("string"), F.floor(F.col("_at") / 4).cast("string")),
    ).withColumn("attempt", (F.col("_at") % 4 + 1).cast("int")).drop("_n", "_done", "_at")


def vectors_with_copies(embeddings: DataFrame) -> DataFrame:
    """All vectors, plus near copies of some: groups of one, two and three."""

    def bumped(place: int, every: int, shift: int) -> DataFrame:
        return embeddings.filter(F.col("vec_id") % every == 0).select(
            (F.col("vec_id") + shift).alias("vec_id"), bump(F.col("embedding"), place).alias("embedding")
        )

    plain = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return plain.unionByName(bumped(1, 5, 1_000_000)).unionByName(bumped(2, 10, 2_000_000))


def bump(v: Column, place: int | Column) -> Column:
    """The vector with 0.05 added at one place (from 1; 0 changes nothing)."""
    place = F.lit(place) if isinstance(place, int) else place
    return F.transform(
        v.cast("array<double>"), lambda x, i: x + F.when(i + 1 == place, 0.05).otherwise(0.0)
    )


def canonical_vectors(canonicals: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Give every canonical claim one of the given vectors or a near copy.

    The choice is skewed on purpose: the product of three uniform numbers falls
    on the first vectors far more often than on the last.
    """
    def digits(i: int) -> Column:
        return F.conv(F.substring("canonical_id", i, 4), 16, 10).cast("int")

    total = embeddings.agg((F.max("vec_id") + 1).alias("n")).scalar()
    slot = F.floor(total * (digits(1) / 65536) * (digits(5) / 65536) * (digits(9) / 65536)).cast("bigint")
    return (
        canonicals.select("canonical_id", slot.alias("vec_id"), (digits(13) % 3).alias("_place"))
        .join(embeddings.select("vec_id", "embedding"), "vec_id")
        .select("canonical_id", bump(F.col("embedding"), F.col("_place")).alias("embedding"))
    )
