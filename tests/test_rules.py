"""Each rule on small literal rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from claimweave.functions import clock
from claimweave.functions.text import norm_text, sentences, strip
from claimweave.operators import calls, contradict, contracts, drift, extract, ingest, quality, split
from claimweave.params import Params


def lines(spark, *texts):
    rows = [("e1", 0, i + 1, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "episode_id string, episode_seq bigint, line_no bigint, line string")


@pytest.mark.parametrize(
    "line, reason",
    [
        ("A | 00:00:01 | 00:00:02 | hi", None),
        ("\tA|00:00:01|00:00:02| hi ", None),
        ("A | 00:00:01 | 00:00:02 | a | b", "Invalid line format. Expected 4 parts, got 5"),
        ("A | 00:00:01 | hi", "Invalid line format. Expected 4 parts, got 3"),
        ("  | 0:00:01 | 00:00:02 | hi", "Speaker cannot be empty"),
        ("A | 0:00:01 | 00:00:02 | hi", "Invalid timestamp format: 0:00:01. Expected HH:MM:SS"),
        ("A | 24:00:01 | 00:00:02 | hi", "Invalid hours in timestamp: 24"),
        ("A | 23:60:01 | 00:00:02 | hi", "Invalid minutes in timestamp: 60"),
        ("A | 00:00:01 | 00:00:61 | hi", "Invalid seconds in timestamp: 61"),
        ("A | 00:00:02 | 00:00:02 | ", "Start time 00:00:02 must be before end time 00:00:02"),
        ("A | 00:00:01 | 00:00:02 | ", "Utterance text cannot be empty"),
    ],
)
def test_line_rules(spark, line, reason):
    row = ingest.parse_lines(lines(spark, line)).first()
    assert row["error"] == (None if reason is None else f"Line 1: {reason}")
    if reason is None:
        assert (row["speaker"], row["text"]) == ("A", "hi")


def test_blank_lines_count_but_are_not_rejected(spark):
    l = lines(spark, "A | 00:00:01 | 00:00:02 | hi", "  \t", "bad")
    assert [r["error"][:7] for r in ingest.rejected(ingest.parse_lines(l)).collect()] == ["Line 3:"]
    counts = ingest.line_counts(l).first()
    assert (counts["lines_read"], counts["lines_accepted"], counts["lines_rejected"]) == (3, 1, 1)


def test_clock(spark):
    row = spark.range(1).select(
        clock.to_seconds(F.lit("23:59:59")), clock.to_seconds(F.lit("24:00:00")), clock.render(F.lit(360000)), strip(F.lit(" x\x1c\n"))
    ).first()
    assert tuple(row) == (86399, None, "100:00:00", "x")


def test_sentences_and_pass_through(spark):
    cut = spark.range(1).select(sentences(F.lit("One. Two!\nThree? v1.2 is four"))).first()[0]
    assert cut == ["One.", "Two!", "Three?", "v1.2 is four"]
    u = ingest.accepted(ingest.parse_lines(lines(spark, "A | 00:00:01 | 00:00:02 | only one.", "A | 00:00:03 | 00:00:04 | a. b.")))
    rows = split.split_sentences(u).orderBy("line_no", "sentence_no").collect()
    assert [(r["sentence_no"], r["text"], r["utterance_id"] == r["parent_id"]) for r in rows] == [
        (0, "only one.", True), (1, "a.", False), (2, "b.", False),
    ]


def answer(spark, response, error=None):
    a = spark.createDataFrame([("u", response, error)], "utterance_id string, response string, error string")
    return a, spark.createDataFrame([("u", "the text")], "utterance_id string, text string")


GOOD = {"belief_text": " x ", "confidence": 0.5, "original_quote": "q", "extraction_flags": {"q24_factual_claim": True}}


@pytest.mark.parametrize(
    "change, problem",
    [
        ({}, None),
        ({"confidence": "0.9"}, None),
        ({"extraction_flags": {"a": "true", "b": False}}, None),
        ({"extraction_flags": {"a": 1}}, None),
        ({"confidence": 1.01}, "confidence"),
        ({"confidence": None}, "confidence"),
        ({"confidence": "high"}, "confidence"),
        ({"belief_text": "  "}, "belief_text"),
        ({"belief_text": 5}, "belief_text"),
        ({"original_quote": None}, "original_quote"),
        ({"extraction_flags": {"a": "maybe", "b": True}}, "extraction_flags"),
        ({"extraction_flags": {"a": False}}, "extraction_flags"),
        ({"extraction_flags": {}}, "extraction_flags"),
    ],
)
def test_belief_rules_leave_siblings_alone(spark, change, problem):
    a, u = answer(spark, json.dumps({"beliefs": [GOOD, {**GOOD, **change}, "text", GOOD]}))
    rows = extract.parse_beliefs(a, u).orderBy("ordinal").collect()
    assert [r["problem"] for r in rows] == [None, problem, "element", None]
    assert rows[0]["belief_text"] == "x"


def test_a_response_is_read_in_one_cast(spark):
    """Kinds of values and missing ones are told apart, and no type of a whole response is made out."""
    listed = [{}, None, 3, [GOOD], {**GOOD, "original_quote": {"a": 1}}, {**GOOD, "extraction_flags": None}, {**GOOD, "confidence": True}]
    a, u = answer(spark, json.dumps({"beliefs": listed}))
    parsed = extract.parse_beliefs(a, u)
    rows = parsed.orderBy("ordinal").collect()
    assert [r["problem"] for r in rows] == ["belief_text", "element", "element", "element", "original_quote", "extraction_flags", None]
    assert [r["original_quote"] for r in rows] == ["the text"] * 4 + [None, "q", "q"]
    assert [r["extraction_flags"] for r in rows][:6] == [{}] * 4 + [GOOD["extraction_flags"], None]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("schemaofvariant.") == 2 and plan.count("try_variant_get(") == 4


def test_default_quote_is_the_utterance(spark):
    a, u = answer(spark, json.dumps({"beliefs": [{k: v for k, v in GOOD.items() if k != "original_quote"}]}))
    assert extract.parse_beliefs(a, u).first()["original_quote"] == "the text"


@pytest.mark.parametrize("response, failed", [("{bad", 1), ("[1]", 1), ("{}", 0), ('{"beliefs": 3}', 1), (None, 1)])
def test_unusable_responses(spark, response, failed):
    a, u = answer(spark, response)
    assert extract.failures(a).count() == failed
    assert extract.parse_beliefs(a, u).count() == 0


def test_model_failure_costs_one_row(spark):
    import pandas as pd

    def model(frame):
        if (frame["text"] == "b").any():
            raise ValueError("boom")
        return pd.DataFrame({"utterance_id": frame["utterance_id"], "response": "{}", "error": None, "tokens": 1, "latency": 0.0})

    rows = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "utterance_id string, text string").coalesce(1)
    got = {r["utterance_id"]: r["error"] for r in extract.call_model(rows, model).collect()}
    assert got == {"1": None, "2": "boom", "3": None}


def test_every_row_asked_about_has_one_answer(spark):
    import pandas as pd

    def model(frame):
        out = pd.DataFrame({"utterance_id": frame["utterance_id"], "response": "{}", "error": None, "tokens": 1, "latency": 0.0})
        out = out[~out["utterance_id"].isin(["2", "5"])]
        return pd.concat([out, out[out["utterance_id"] == "3"], out.head(1).assign(utterance_id="stranger")])

    rows = spark.createDataFrame([(str(i), "t") for i in range(1, 8)], "utterance_id string, text string").coalesce(1)
    for size in (1, 3, 10):
        got = sorted((r["utterance_id"], r["error"]) for r in extract.call_model(rows, model, params=Params(batch_size=size)).collect())
        assert got == [(str(i), {2: "no answer", 5: "no answer", 3: "several answers"}.get(i)) for i in range(1, 8)]


def test_the_model_is_asked_once(spark):
    """Rows sent to the model, over reports, cells and contradictions, and over a second run with stored answers."""
    from claimweave.plans.conversation import Conversations, quality_reports

    asked = spark.sparkContext.accumulator(0)
    lines = spark.createDataFrame(
        [("e1", 1, n, f"A | 00:0{n}:00 | 00:0{n}:30 | tea is {n}. It is not tea.") for n in range(1, 6)], "episode_id string, episode_seq long, line_no long, line string"
    )

    def model(frame):
        asked.add(len(frame))
        said = '{"beliefs": [{"belief_text": "' + frame["text"] + '", "confidence": 0.5, "extraction_flags": {"q24_factual_claim": true}}]}'
        return frame[["utterance_id"]].assign(response=said, error=None, tokens=1, latency=0.0)

    def answer(u):
        return extract.call_model(u.select("utterance_id", "text"), model)

    c = Conversations(lines, answer)
    for df in (quality_reports(c), c.cells, c.contradictions, c.cells):
        df.collect()
    assert asked.value == c.atomic.count() == 10
    again = Conversations(lines, answer, stored=c.answers)
    assert again.beliefs.count() == c.beliefs.count() and asked.value == 10


def test_normal_form(spark):
    p = Params(synonyms={"big": "large"})
    row = spark.range(1).select(norm_text(F.lit("  It DOESN'T look\tbig!! é"), p)).first()
    assert row[0] == "it does not look large é"


@pytest.mark.parametrize("score, grade", [(100, "A"), (90, "A"), (89.5, "B"), (80, "B"), (70, "C"), (60, "D"), (59.99, "F"), (0, "F")])
def test_grades(spark, score, grade):
    assert spark.range(1).select(quality.grade(F.lit(float(score)))).first()[0] == grade


def test_score_floor_and_empty_summary(spark):
    counts = spark.createDataFrame(
        [("a", 1, 1, 1, 1), ("b", 60, 0, 0, 0)],
        "episode_id string, errors_count bigint, retries_count bigint, malformed_beliefs_count bigint, registry_mismatches_count bigint",
    )
    report = quality.reports(counts)
    assert {r["episode_id"]: r["quality_score"] for r in report.collect()} == {"a": 96.0, "b": 0.0}
    assert quality.summary(report, spark.createDataFrame([], "episode_id string")).count() == 0


@pytest.mark.parametrize(
    "before, after, kind, size",
    [
        ((0.5, 1), (0.65, 1), "strengthening", 0.15),
        ((0.65, 1), (0.5, 1), "weakening", 0.15),
        ((0.5, 1), (0.64, 1), None, None),
        ((0.5, 1), (0.5, 3), "strengthening", 2 / 3),
        ((0.5, 4), (0.5, 2), "weakening", 0.5),
        ((0.5, 4), (0.7, 1), "strengthening", 0.2),
    ],
)
def test_drift_thresholds(spark, before, after, kind, size):
    cells = spark.createDataFrame(
        [("c", "e0", 0, *before), ("c", "e1", 1, *after)],
        "canonical_id string, episode_id string, episode_seq bigint, conviction_avg double, frequency bigint",
    )
    row = drift.changes(cells).filter("episode_seq = 1").first()
    assert row["kind"] == kind
    if kind:
        assert row["size"] == pytest.approx(size)


def test_drop_fires_once_per_gap_and_needs_a_next_episode(spark):
    eps = spark.createDataFrame([(f"e{i}", i) for i in range(5)], "episode_id string, episode_seq bigint")
    cells = spark.createDataFrame(
        [("c", f"e{i}", i, 0.5, 1) for i in (0, 3, 4)],
        "canonical_id string, episode_id string, episode_seq bigint, conviction_avg double, frequency bigint",
    )
    got = drift.events(cells, eps).filter("drift_type = 'dropped'").collect()
    assert [(r["start_episode"], r["end_episode"]) for r in got] == [("e0", "e1")]


def test_reversal_is_one_speaker_in_two_episodes(spark):
    m = spark.createDataFrame(
        [("a", "e0", 0, "S"), ("b", "e1", 1, "S"), ("b", "e1", 1, "T"), ("c", "e2", 2, "U"), ("d", "e2", 2, "U")],
        "canonical_id string, episode_id string, episode_seq bigint, speaker string",
    )
    pairs = spark.createDataFrame([("a", "b", 1.0), ("c", "d", 0.8)], "a string, b string, score double")
    got = {(r["speaker_a"], r["speaker_b"]): (r["type"], r["is_reversal"], r["later_seq"]) for r in contradict.contradictions(pairs, m).collect()}
    assert got == {
        ("S", "S"): ("within_speaker", True, 1),
        ("S", "T"): ("cross_speaker", False, 1),
        ("U", "U"): ("within_speaker", False, 2),
    }


@pytest.mark.parametrize(
    "message, cause",
    [
        ("HTTP 429 and timeout", "rate_limit"), ("RATE_LIMIT hit", "rate_limit"), ("Timed out", "timeout"),
        ("code 503", "server_error"), ("char 5003", "server_error"), ("bad request", "non_retryable"),
    ],
)
def test_causes(spark, message, cause):
    assert spark.range(1).select(calls.cause(F.lit(message))).first()[0] == cause


def test_backoff(spark):
    log = spark.createDataFrame(
        [(i, False, e) for e in ("429", "timeout") for i in (1, 2, 3, 4)], "attempt int, success boolean, error string"
    )
    rows = calls.attempts(log).collect()
    assert [r["wait_s"] for r in rows] == [4, 8, 16, 0, 2, 4, 8, 0]
    assert [r["exhausted"] for r in rows] == [False, False, False, True] * 2
    capped = calls.attempts(log, Params(backoff_cap_s=5)).collect()
    assert [r["wait_s"] for r in capped] == [4, 5, 5, 0, 2, 4, 5, 0]


def test_budget_keeps_the_entry_on_the_edge(spark):
    t0 = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [(1, 1, t0, 10), (1, 2, t0 + dt.timedelta(seconds=60), 10), (1, 3, t0 + dt.timedelta(seconds=60, microseconds=1), 10), (2, 4, t0, 10)],
        "caller bigint, call_id bigint, ts timestamp, tokens bigint",
    )
    got = {r["call_id"]: (r["prior_requests"], r["prior_tokens"], round(r["wait_s"], 3)) for r in calls.budget_audit(log, Params(budget_requests=1)).collect()}
    assert got == {1: (0, 0, 0.0), 2: (1, 10, 0.1), 3: (1, 10, 60.1), 4: (0, 0, 0.0)}


def test_budget_of_a_caller_with_half_of_all_calls(spark):
    import random

    r = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1 if i % 2 else 2 + i % 40, i, t0 + dt.timedelta(seconds=r.randrange(900)), r.choice([0, 0, 5, 50])) for i in range(1200)]
    log = spark.createDataFrame(rows, "caller bigint, call_id bigint, ts timestamp, tokens bigint")
    p = Params(budget_requests=20, budget_tokens=400)
    want = {}
    for who, i, ts, n in rows:
        past = [x for x in rows if x[0] == who and (x[2], x[1]) < (ts, i) and (ts - x[2]).total_seconds() <= 60]
        tokens = sum(x[3] for x in past)
        wait = 0.0
        if len(past) >= 20:
            wait = 60 - (ts - min(x[2] for x in past)).total_seconds() + 0.1
        if n and tokens + n > 400:
            wait = max(wait, 60 - (ts - min([x[2] for x in past if x[3]], default=ts)).total_seconds() + 0.1)
        want[i] = (len(past), tokens, round(wait, 3))
    got = {x["call_id"]: (x["prior_requests"], x["prior_tokens"], round(x["wait_s"], 3)) for x in calls.budget_audit(log, p).collect()}
    assert got == want


def test_reference_rules(spark):
    rows = [("1", "ep_1-a", "f.mp3#t=5", "2024-02-29", "p", 1.0), ("2", "ep 1", "f.mp3#t=5,", "2023-02-29", "", 1.1), ("3", "", "#t=5", "x", None, None)]
    df = spark.createDataFrame(rows, "id string, episode_id string, audio_uri string, date string, path string, score double")
    got = sorted((r["id"], r["rule"]) for r in contracts.link_violations(df).collect())
    assert got == sorted((i, n) for i in ("2", "3") for n in ("episode_id", "audio_uri", "date", "path", "score"))
