"""Repair of conversations against a plain search over whole edit strings."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from claimweave.llm import repair

KIND = "conv_id long, turn long, role string, text string, cost string, k int"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if way == 0:
            continue
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        out += [(conv, turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    return out


def cheapest(turns, faults):
    """(cost, edits, repaired) by forward search that keeps whole edit strings."""
    best = {"": (0, "", ())}

    def put_in(best):
        for _ in range(2):
            for state, (cost, edits, done) in list(best.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    to = NEXT[state].get(initial)
                    new = (cost + 3, edits + "I", (*done, f"{role}:"))
                    if to and (to not in best or new < best[to]):
                        best[to] = new
        return best

    for (role, text), fault in zip(turns, faults, strict=True):
        best, new = put_in(best), {}

        def offer(state, way, new=new):
            if state is not None and (state not in new or way < new[state]):
                new[state] = way

        for state, (cost, edits, done) in best.items():
            offer(state, (cost + 4, edits + "D", done))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault else 0
            offer(NEXT[state].get(role[:1]), (cost + more, edits + "K", (*done, f"{role}:{text}")))
            for initial, named in (("u", "user"), ("a", "assistant")):
                offer(NEXT[state].get(initial), (cost + 3 + more, edits + "R", (*done, f"{named}:{text}")))
        best = new
    best = put_in(best)
    return min(best[s] for s in ("", "a") if s in best)


def expected(rows):
    by = defaultdict(list)
    ids = {r[0] for r in rows}
    for r in harmed(rows):
        by[r[0]].append(r)
    out = {}
    for conv in ids:
        digest = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
        turns = sorted(by[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r)))
        seen, faults = set(), []
        for _, _, role, text in turns:
            body = re.sub(r"[\x20\x09-\x0D]+", "", text)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        numbers = [r[1] for r in turns if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, edits, done = cheapest([r[2:] for r in turns], faults)
        sha = hashlib.sha256("\n".join(done).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits, sha)
    return out


def report(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND)
    found = repair.repair_report(df, **how).collect()
    assert len(found) == len({r[0] for r in found})
    return {r[0]: tuple(r)[1:] for r in found}


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "So what?", "and then", " \t", "", None, "well. ", "a b c.\n", "Ünï."]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(texts) if rng.random() < 0.4 else f"said {rng.randrange(10**6)}" + rng.choice([".", "", "?"])
            rows.append((conv, turn if rng.random() < 0.9 else None, role, text))
    return rows


@pytest.mark.parametrize("chunk_rows, parts", [(1 << 16, None), (3, 5)])
def test_against_search(spark, chunk_rows, parts):
    rows = random_rows(1, 60, 14)
    rows += [(None, None, None, None), (None, 2, "user", "x."), (-3, 1, "user", "Hello.")] + [(-5, 4, "user", "same.")] * 7
    assert report(spark, rows, chunk_rows=chunk_rows, parts=parts) == expected(rows)


def test_long_conversations_in_small_chunks(spark):
    """Vectors that depend on what follows for ever: only users; copies; pairs."""
    rows = [(1, t, "user", f"{t}.") for t in range(301)]
    rows += [(2, t, "assistant", "again.") for t in range(300)]
    rows += [(3, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(300)]
    rows += [(4, t, "system", f"{t}.") for t in range(101)]
    rows += [(r[0] + 5, *r[1:]) for r in random_rows(2, 3, 200)]
    assert report(spark, rows, chunk_rows=7, parts=11) == expected(rows)


def test_dropped_and_empty(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert report(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert report(spark, []) == {}


def test_repaired_turns_are_given_back(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "Who?"), (1, 2, "user", "Me."), (1, 3, "assistant", "Ah.")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for chunk_rows in (1, 100):
        found = repair.repaired_turns(turns, chunk_rows=chunk_rows, parts=3).orderBy("part", "k", "at").collect()
        _, edits, done = cheapest([r[2:] for r in rows], [""] * 4)
        assert [f"{r['role']}:{r['text']}" for r in found] == list(done)
        letters = "".join(r["audit"] for r in repair.repaired(turns, chunk_rows=chunk_rows, parts=3).orderBy("part", "k").collect())
        assert letters == edits


def test_given_table(spark):
    folder = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    found = {r[0]: tuple(r)[1:] for r in repair.repair_report(df).collect()}
    assert found == expected(rows)
