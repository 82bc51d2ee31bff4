"""Utterances to claims: prompts, model calls, response parsing, call costs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave import fixed
from claimweave.functions.ids import content_id
from claimweave.functions.ordered import blocks, numbered
from claimweave.functions.settle import settled
from claimweave.functions.text import strip
from claimweave.params import DEFAULT, Params

# {speaker}, {text} and {flags} are filled in; callers may bring a template of their own.
TEMPLATE = (
    "List the beliefs that the speaker states in this utterance, one short declarative sentence each.\n"
    "Speaker: {speaker}\n"
    "Utterance: {text}\n"
    "Give for each belief: belief_text, confidence (0.0 to 1.0), original_quote (the exact words) and "
    "extraction_flags (true or false, at least one true).\n"
    "Flags:\n{flags}\n"
    'Answer in JSON as {"beliefs": [{"belief_text", "confidence", "original_quote", "extraction_flags"}]}. '
    "Skip questions and commands."
)


def flag_lines(flags: dict[str, str]) -> str:
    return "\n".join(f"- {name}: {meaning}" for name, meaning in flags.items())


def prompts(utterances: DataFrame, flags: dict[str, str] = fixed.FLAGS, template: str = TEMPLATE) -> DataFrame:
    """Add the column ``prompt``; values are spliced in as literals, never as patterns."""
    head, _, rest = template.replace("{flags}", flag_lines(flags)).partition("{speaker}")
    middle, _, tail = rest.partition("{text}")
    return utterances.withColumn(
        "prompt", F.concat(F.lit(head), F.col("speaker"), F.lit(middle), F.col("text"), F.lit(tail))
    )


def in_order(utterances: DataFrame, name: str = "item_no") -> DataFrame:
    """Number the atomic utterances of each episode from 1, in transcript order."""
    return numbered(utterances, ["episode_id"], ["line_no", "sentence_no"], blocks("line_no"), name)


def batches(utterances: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Consecutive groups of ``batch_size`` per episode, counted from 0."""
    size = params.batch_size
    return in_order(utterances).withColumn("batch_no", F.floor((F.col("item_no") - 1) / size).cast("bigint"))


def first_items(utterances: DataFrame, n: int = 10) -> DataFrame:
    """The first n items of each episode; each input partition keeps n before the shuffle."""
    w = W.partitionBy("episode_id").orderBy("line_no", "sentence_no")
    return utterances.withColumn("item_no", F.row_number().over(w)).filter(F.col("item_no") <= n)


def spread(utterances: DataFrame) -> DataFrame:
    """Even out the utterances before work that is dear per row.

    One transcript file may be one input task, but its utterances mean hours of
    model time.  The number of partitions is fixed, so that adaptive execution does
    not merge them for being small in bytes; the key is the one the answers are
    joined back on.
    """
    wanted = int(utterances.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return utterances.repartition(wanted, "utterance_id")


def echoes(asked: pd.DataFrame, got: pd.DataFrame, keys: list[str]) -> bool:
    """Whether the answers are to the rows asked about, one by one and in their order."""
    return len(got) == len(asked) and all((got[k].to_numpy() == asked[k].to_numpy()).all() for k in keys)


CALL_SCHEMA = "utterance_id string, response string, error string, tokens bigint, latency double"


def call_model(
    rows: DataFrame, model: Callable[[pd.DataFrame], pd.DataFrame], schema: str = CALL_SCHEMA, params: Params = DEFAULT
) -> DataFrame:
    """Run a user's callable over batches of at most ``batch_size`` rows.

    ``model`` gets a frame of rows and returns a frame with the columns of
    ``schema``.  A batch it fails on is halved until single rows are left, so one bad
    item becomes one error row and costs its neighbours few further calls.  Every row
    asked about has exactly one row in the result: one without an answer, or with
    several, becomes an error row, and answers nobody asked for are left out.  The
    result is lazy: keep it (see ``Conversations.answers``) before reading it twice.
    """
    names = [f.split()[0] for f in schema.split(", ")]
    # what tells rows apart: the columns asked with that come back, or the first
    keys = [n for n in names if n in rows.columns] or names[:1]

    def failed(asked: pd.DataFrame, error: str) -> pd.DataFrame:
        out = {n: asked[n].tolist() if n in keys else [None] * len(asked) for n in names}
        out["error"] = [error] * len(asked)
        if "tokens" in out:
            out["tokens"], out["latency"] = [0] * len(asked), [0.0] * len(asked)
        return pd.DataFrame(out)

    def answered(asked: pd.DataFrame) -> list[pd.DataFrame]:
        try:
            got = model(asked)[names]
        except Exception as error:  # a single row's failure is data
            if len(asked) == 1:
                return [failed(asked, str(error))]
            half = len(asked) // 2
            return answered(asked.iloc[:half]) + answered(asked.iloc[half:])
        if echoes(asked, got, keys):
            return [got]
        ids = pd.MultiIndex.from_frame(asked[keys])
        given = pd.MultiIndex.from_frame(got[keys])
        several = given.duplicated(keep=False) & given.isin(ids[~ids.duplicated(keep=False)])
        parts = [got[given.isin(ids) & ~several]]
        if several.any():
            parts.append(failed(asked[ids.isin(given[several])], "several answers"))
        if not ids.isin(given).all():
            parts.append(failed(asked[~ids.isin(given)], "no answer"))
        return parts

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            batches = (frame.iloc[i : i + params.batch_size] for i in range(0, len(frame), params.batch_size))
            parts = [part for batch in batches for part in answered(batch) if len(part)]
            if parts:
                yield pd.concat(parts, ignore_index=True)

    return rows.mapInPandas(run, schema)


def _is(c: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(c).startswith(kind), F.lit(False))


def read_responses(answers: DataFrame) -> DataFrame:
    """Parse each response once: ``root`` as VARIANT and whether it is usable."""
    parsed = settled(answers, {"_root": F.try_parse_json("response")})
    parsed = settled(parsed, {"_listed": F.try_variant_get("_root", "$.beliefs", "variant")})
    has_error = F.col("error").isNotNull() if "error" in answers.columns else F.lit(False)
    usable = _is(F.col("_root"), "OBJECT") & (F.col("_listed").isNull() | _is(F.col("_listed"), "ARRAY"))
    return settled(parsed, {"_usable": F.coalesce(usable & ~has_error, F.lit(False))})


# fields of a listed belief; those whose kind matters stay VARIANT, and one that is missing is NULL
BELIEF = "struct<belief_text: variant, confidence: double, original_quote: variant, extraction_flags: variant>"


def parse_beliefs(answers: DataFrame, utterances: DataFrame) -> DataFrame:
    """One row per listed belief, good or not; ``problem`` names the first broken rule.

    A bad value spoils its own belief and leaves the others of the response alone.  All
    beliefs of a response are read in one cast, since each look into a VARIANT writes
    what it finds anew.  An element that is no object becomes NULL.
    """
    given = answers.filter(F.col("error").isNull()) if "error" in answers.columns else answers
    listed = F.try_variant_get(F.try_parse_json("response"), "$.beliefs", f"array<{BELIEF}>")
    items = given.select("utterance_id", F.posexplode(listed).alias("_pos", "_e"))

    def text_of(name: str) -> Column:
        return F.when(_is(F.col(f"_e.{name}"), "STRING"), strip(F.try_variant_get(F.col(f"_e.{name}"), "$", "string")))

    flags = F.col("_e.extraction_flags")
    said = utterances.select("utterance_id", strip(F.col("text")).alias("_said"))
    rows = settled(
        items.join(said, "utterance_id"),
        {
            "ordinal": F.col("_pos") + 1,
            "belief_text": text_of("belief_text"),
            "confidence": F.col("_e.confidence"),
            "original_quote": F.when(F.col("_e.original_quote").isNull(), F.col("_said")).otherwise(text_of("original_quote")),
            "context": F.lit(None).cast("string"),
            "extraction_flags": F.when(flags.isNull(), F.create_map().cast("map<string,boolean>")).otherwise(
                F.try_variant_get(flags, "$", "map<string,boolean>")
            ),
        },
    )
    values = F.map_values("extraction_flags")
    problem = (
        F.when(F.col("_e").isNull(), "element")
        .when(F.col("belief_text").isNull() | (F.col("belief_text") == ""), "belief_text")
        .when(
            F.col("confidence").isNull() | F.isnan("confidence") | ~F.col("confidence").between(0.0, 1.0), "confidence"
        )
        .when(F.col("original_quote").isNull() | (F.col("original_quote") == ""), "original_quote")
        .when(
            F.col("extraction_flags").isNull()
            | F.exists(values, lambda v: v.isNull())
            | ~F.exists(values, lambda v: F.coalesce(v, F.lit(False))),
            "extraction_flags",
        )
    )
    judged = settled(rows, {"belief_id": content_id("utterance_id", "ordinal"), "problem": problem})
    return judged.select(
        "belief_id",
        "utterance_id",
        "ordinal",
        "belief_text",
        "confidence",
        "original_quote",
        "context",
        "extraction_flags",
        "problem",
    )


def beliefs(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull()).drop("problem")


def malformed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNotNull()).select("belief_id", "utterance_id", "ordinal", "problem")


def failures(answers: DataFrame) -> DataFrame:
    """Responses that give no list of beliefs, with the caller's error if there is one."""
    read = read_responses(answers)
    given = F.col("error") if "error" in answers.columns else F.lit(None).cast("string")
    return read.filter(~F.col("_usable")).select(
        "utterance_id", F.coalesce(given, F.lit("unusable response")).alias("message")
    )


def call_costs(calls: DataFrame, by: str = "episode_id", params: Params = DEFAULT) -> DataFrame:
    """Totals per episode: calls, tokens, cost, mean latency, failed calls."""
    cost = F.col("tokens") / 1000 * params.usd_per_1k_tokens
    return calls.groupBy(by).agg(
        F.count(F.lit(1)).alias("api_calls"),
        F.sum("tokens").alias("api_tokens"),
        F.sum(cost).alias("api_cost_usd"),
        F.avg("latency").alias("api_latency_avg"),
        F.count_if(~F.col("success")).alias("api_errors"),
    )
