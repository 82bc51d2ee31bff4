"""The call log as a stream: metrics per minute, and a budget alarm with state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from claimweave.operators.calls import minute_metrics
from claimweave.params import DEFAULT, Params


def per_minute(log: DataFrame, late: str = "2 minutes", size: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Metrics per window; rows later than ``late`` behind the newest are left out by the watermark."""
    windowed = F.window("ts", size, slide) if slide else F.window("ts", size)
    return log.withWatermark("ts", late).groupBy(windowed.alias("w")).agg(*minute_metrics()).select(
        F.col("w.start").alias("minute"), "api_calls", "api_tokens", "api_latency_avg", "api_errors", "api_retries"
    )


ALARM = (
    "caller bigint, call_id bigint, ts timestamp, prior_requests bigint, prior_tokens bigint, "
    "over_requests boolean, over_tokens boolean"
)
SLICE_WINDOWS = 4  # window lengths in one slice of time
CALLERS = 256  # groups of callers, each with one state for a slice
NONE = -(1 << 63)  # stands for tokens that are NULL
_STATE = "callers array<bigint>, known array<boolean>, us array<bigint>, ids array<bigint>, tokens array<bigint>"


def budget_alarm(log: DataFrame, params: Params = DEFAULT, late: str = "2 minutes") -> DataFrame:
    """Calls that pass a budget, each judged by the calls of its caller in the trailing window.

    Time is cut into slices of a few window lengths.  A call is judged in its own slice and,
    in the last window length of it, told to the next, whose windows reach back to it.  So a
    slice needs no other one: the state is keyed by slice and group of callers, and the calls of a
    busy caller are dealt to as many keys as they cover slices.  Callers are grouped by hash, since
    a key costs about as much time as a thousand calls, and judged apart.  A late call meets the
    slice it belongs to (calls judged before it came stay as they were judged).  A slice is evicted
    once the watermark has passed its end; calls behind the watermark, or without a time, are left out.
    """
    span = params.budget_window_s * 1_000_000
    length = SLICE_WINDOWS * span
    at, next_at = F.unix_micros("ts"), F.unix_micros("ts") + span
    own, told = (F.floor(x / length).cast("bigint") for x in (at, next_at))
    here = F.struct(own.alias("slice"), F.lit(True).alias("own"))
    slices = F.when(own == told, F.array(here)).otherwise(F.array(here, F.struct(told.alias("slice"), F.lit(False).alias("own"))))

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        behind = pd.Timestamp(max(state.getCurrentWatermarkMs(), 0), unit="ms")
        come = [f[f["ts"] > behind] for f in frames]
        if not state.exists and not any(map(len, come)):
            return
        kinds = {"caller": np.int64, "known": bool, "us": np.int64, "call_id": np.int64, "tokens": np.int64}
        held = state.get if state.exists else ((),) * len(kinds)
        for f in come:
            f["us"] = f["ts"].to_numpy("datetime64[us]").astype(np.int64)
        callers, known, us, ids, tokens = (
            np.concatenate([np.array(old, kind), *[f[name].to_numpy(kind) for f in come]]) for old, (name, kind) in zip(held, kinds.items(), strict=True)
        )
        judged = np.concatenate([np.zeros(len(held[0]), bool), *[f["own"].to_numpy(bool) for f in come]])
        order = np.lexsort((ids, us, callers, known))
        callers, known, us, ids, tokens, judged = (x[order] for x in (callers, known, us, ids, tokens, judged))
        state.update((callers.tolist(), known.tolist(), us.tolist(), ids.tolist(), tokens.tolist()))
        ends = (int(key[1]) + 1) * length // 1000
        state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
        # callers follow each other at more than a window length
        turn = np.cumsum(np.concatenate(([False], (callers[1:] != callers[:-1]) | (known[1:] != known[:-1]))))
        along = turn * (np.ptp(us) + span + 1) + us - us.min()
        at = np.flatnonzero(judged)
        first = along.searchsorted(along[at] - span, side="left")
        spend = np.where(tokens == NONE, 0, tokens)
        before = np.cumsum(spend) - spend
        requests, spent = at - first, before[at] - before[first]
        over_requests = requests >= params.budget_requests
        over_tokens = (spend[at] > 0) & (spent + spend[at] > params.budget_tokens)
        out = over_requests | over_tokens
        if out.any():
            yield pd.DataFrame(
                {
                    "caller": pd.array(callers[at][out], "Int64"),
                    "call_id": ids[at][out],
                    "ts": us[at][out].astype("datetime64[us]"),
                    "prior_requests": requests[out],
                    "prior_tokens": spent[out],
                    "over_requests": over_requests[out],
                    "over_tokens": pd.array(over_tokens[out], "boolean"),
                }
            ).assign(
                caller=lambda d: d["caller"].mask(~known[at][out]), over_tokens=lambda d: d["over_tokens"].mask(tokens[at][out] == NONE)
            )

    return (
        log.withWatermark("ts", late)
        .filter(F.col("ts").isNotNull())
        .select(
            F.pmod(F.xxhash64("caller"), F.lit(CALLERS)).alias("callers"), F.coalesce("caller", F.lit(0)).cast("bigint").alias("caller"),
            F.col("caller").isNotNull().alias("known"), "call_id", "ts", F.coalesce("tokens", F.lit(NONE)).alias("tokens"), F.inline(slices),
        )
        .groupBy("callers", "slice")
        .applyInPandasWithState(judge, ALARM, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )
