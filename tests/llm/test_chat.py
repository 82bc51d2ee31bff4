import hashlib
import time

from claimweave.llm import chat
from pyspark.sql import functions as F

TURNS = "conv_id long, turn long, role string, text string, formatted string, loss_spans int"


def awkward(spark):
    hard = ["\\", "\\b", "\\\\t", "### ", "#### ### User: ", "</turn>", "</turn>\n", "<|turn|>", "<|tu", "\n", "", "a\\h</tur", "é漢😀", ": x"]
    rows = [(k, t, ["user", "assistant", "assistant", "sy: stem", '"q"', "Assistant", None, ""][(k + t) % 8], hard[(k * 3 + t) % len(hard)], "", 0) for k in range(14) for t in range(9)]
    rows += [(50, 0, "assistant", None, "", 0), (50, 0, "assistant", None, "", 0), (None, None, "user", "x", "", 0), (51, 0, "user", "w " * 60000, "", 0)]
    return rows, spark.createDataFrame(rows, TURNS)


def test_round_trip(spark):
    rows, df = awkward(spark)
    got = {r.conv_id: r for r in chat.chat_digests(df).collect()}
    by = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, []).append((turn if turn is not None else -1, role or "", text or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        r = got[conv]
        said = "".join(t for _, role, t in turns if role == "assistant")
        digest = hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in turns).encode()).hexdigest()
        assert (r.n_turns, r.turns_sha256) == (len(turns), digest)
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())


def test_adjacent_turns_share_a_block(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(df).first()
    assert row.formatted == "### User: a<|turn|>b</turn>\n### Assistant: c</turn>\n"
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss_spans] == ["c"]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chat_digests(empty).count() == 0
    assert [r.conv_id for r in chat.chat_digests(chat.with_probe(empty)).collect()] == [-7]


def test_a_long_conversation_grows_in_proportion(spark):
    """20,000 turns of one conversation; a fold that rebuilds its state takes minutes for them."""
    n = 20_000
    role = F.when(F.col("id") % 3 == 0, "user").otherwise("assistant")
    rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("tëxt "), F.col("id")).alias("text"))
    start = time.time()
    found = chat.chat_digests(rows).first()
    assert time.time() - start < 60
    loss = "".join(f"tëxt {k}" for k in range(n) if k % 3)
    turns = "".join(f"{'assistant' if k % 3 else 'user'}\ntëxt {k}\n" for k in range(n))
    assert (found.n_turns, found.loss_chars) == (n, len(loss))
    assert found.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert found.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
