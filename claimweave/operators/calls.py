"""What a log of model calls tells: causes, retries, waits, budgets, rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.ordered import running
from claimweave.params import DEFAULT, Params


def cause(message: Column) -> Column:
    """Kind of a failure by its message; the first that fits wins.

    A status code counts wherever it stands in the text, also inside a longer number.
    """
    low = F.lower(message)

    def has(text: Column, *parts: str) -> Column:
        out = text.contains(parts[0])
        for p in parts[1:]:
            out = out | text.contains(p)
        return out

    # The marks of each kind of failure.
    return (
        F.when(has(message, "429") | has(low, "rate_limit"), "rate_limit")
        .when(has(low, "timeout", "timed out"), "timeout")
        .when(has(message, "500", "502", "503", "504"), "server_error")
        .otherwise("non_retryable")
    )


def attempts(log: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Cause and wait of each failed attempt; row-local.

    ``exhausted`` marks a retryable failure after the last allowed retry; ``given_up``
    those and every failure that is not tried again.
    """
    failed = ~F.col("success")
    kind = F.when(failed, cause(F.col("error")))
    retryable = F.col("cause").isin("rate_limit", "timeout", "server_error")
    factor = F.when(F.col("cause") == "rate_limit", 2).otherwise(1)
    wait = F.least(F.pow(F.lit(float(params.backoff_base)), F.col("attempt")) * factor, F.lit(float(params.backoff_cap_s)))
    rows = log.withColumn("cause", kind)
    return rows.withColumns(
        {
            "wait_s": F.when(retryable & (F.col("attempt") <= params.max_retries), wait).otherwise(F.lit(0.0)),
            "exhausted": F.coalesce(retryable & (F.col("attempt") > params.max_retries), F.lit(False)),
        }
    ).withColumn("given_up", F.col("exhausted") | (F.coalesce(F.col("cause") == "non_retryable", F.lit(False))))


def causes(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("cause").isNotNull()).groupBy("episode_id", "cause").agg(
        F.count(F.lit(1)).alias("failures")
    )


def retries(log: DataFrame) -> DataFrame:
    """Attempts after the first, per episode."""
    return log.groupBy("episode_id").agg(F.count_if(F.col("attempt") > 1).alias("retries"))


def waits(classified: DataFrame) -> DataFrame:
    """Seconds waited and items given up, per episode."""
    return classified.groupBy("episode_id").agg(
        F.sum("wait_s").alias("wait_s"), F.count_if("exhausted").alias("items_exhausted")
    )


def budget_audit(
    log: DataFrame, params: Params = DEFAULT, key: str = "caller", tokens: Column | None = None
) -> DataFrame:
    """For each call: earlier calls and tokens in the trailing window, limits passed, wait due.

    A call counts from its own instant until one window length later, so it comes
    at the first and goes just after the second, and the window's content is
    a running sum over both kinds of events.  The oldest call of a window is the one
    that goes next, so the same scan finds it from the other end.  Running values come in
    chunks of time, so that a caller with very many calls is spread over many tasks.
    ``tokens`` may be an estimate in place of the logged column.
    """
    span = params.budget_window_s * 1_000_000
    log = log if tokens is None else log.withColumn("tokens", tokens)
    us = F.unix_micros("ts")
    both = F.array(
        F.struct(us.alias("_at"), F.lit(False).alias("_last")), F.struct((us + span).alias("_at"), F.lit(True).alias("_last"))
    )
    events = log.select(key, "call_id", "ts", "tokens", F.inline(both))
    some = F.col("tokens") > 0
    sign = F.when(F.col("_last"), F.lit(-1)).otherwise(1)
    values = {
        "prior_requests": ("sum", sign.cast("bigint")),
        "prior_tokens": ("sum", sign * F.col("tokens")),
        "_next": ("later_min", F.when(F.col("_last"), F.col("_at"))),
        "_next_some": ("later_min", F.when(F.col("_last") & some, F.col("_at"))),
    }
    chunk = F.floor(F.col("_at") * 16 / span).cast("bigint")
    # calls of one instant count in the order of their ids; a call leaves after all calls of an instant
    rows = running(events, [key], ["_at", "_last", "call_id"], chunk, values, inclusive=False).filter(~F.col("_last"))
    over_requests = F.col("prior_requests") >= params.budget_requests
    over_tokens = some & (F.col("prior_tokens") + F.col("tokens") > params.budget_tokens)

    def due(over: Column, goes: Column) -> Column:
        # A tenth of a second is added to every wait.
        return F.when(F.coalesce(over, F.lit(False)), (goes - F.col("_at")) / 1e6 + 0.1).otherwise(F.lit(0.0))

    return rows.select(
        key, "call_id", "ts", "tokens", "prior_requests", "prior_tokens",
        over_requests.alias("over_requests"), over_tokens.alias("over_tokens"),
        F.greatest(due(over_requests, F.col("_next")), due(over_tokens, F.col("_next_some"))).alias("wait_s"),
    )


def per_minute(log: DataFrame, minutes: str = "1 minute") -> DataFrame:
    """Calls, tokens, cost, mean latency, errors and retries per minute."""
    return log.groupBy(F.window("ts", minutes).alias("w")).agg(*minute_metrics()).select(
        F.col("w.start").alias("minute"), "api_calls", "api_tokens", "api_latency_avg", "api_errors", "api_retries"
    )


def minute_metrics() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("api_calls"),
        F.sum("tokens").alias("api_tokens"),
        F.avg("latency").alias("api_latency_avg"),
        F.count_if(~F.col("success")).alias("api_errors"),
        F.count_if(F.col("attempt") > 1).alias("api_retries"),
    ]
