import re

import check
import pytest
from claimweave.llm import mixing
from claimweave.llm.base import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", ["op7_chat", "op9_mixing"])
def test_agrees_with_sql(spark, con, name):
    ok, note = check.compare(spark, con, name, FOLDER)
    assert ok, note


def fill(sizes, weights, budget):
    """Share the budget by weight; whoever passes twice its size stops there, and the rest is shared again."""
    out, free = {}, set(sizes)
    while free:
        left, total = budget - sum(out.values()), sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * weights[s] / total for s in free}
        out |= {s: 2 * sizes[s] for s in over}
        free -= over
    return out


def test_targets_and_takings(spark):
    rows = mixing.mix_report(table(spark, FOLDER, "documents")).collect()
    docs = {r.doc_id: r for r in table(spark, FOLDER, "documents").collect()}
    size = {i: len([w for w in re.findall(r"[^\x20\x09-\x0D]+", d.text or "")]) for i, d in docs.items()}
    assert {r.doc_id: r["size"] for r in rows} == size
    by = {}
    for i, d in docs.items():
        by[d.source] = by.get(d.source, 0) + size[i]
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(by))}
    goal = fill(by, weights, 1.5 * sum(by.values()))
    taken = {s: sum(r.taken for r in rows if docs[r.doc_id].source == s) for s in by}
    for s in by:
        assert {round(r.target, 6) for r in rows if docs[r.doc_id].source == s} == {round(goal[s], 6)}
        assert abs(taken[s] - goal[s]) <= 2 * max(size[i] for i in docs if docs[i].source == s)
    assert all(r.taken <= 2 * r["size"] for r in rows)
    assert sum(taken.values()) <= 1.5 * sum(by.values())


def test_awkward_rows(spark, odd_docs, no_docs):
    rows = mixing.mix_report(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert [r.size for r in rows if r.doc_id == 3] == [0]
    assert mixing.mix_report(no_docs).count() == 0
    mix = mixing.mixed_documents(odd_docs)
    assert mix.columns == odd_docs.columns
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sum(words(r.text) for r in mix.collect()) == sum(r.taken for r in rows)
    assert mixing.mixed_documents(no_docs).count() == 0
    assert mixing.mix_report(odd_docs.filter("doc_id in (3, 4, 5)")).filter("taken > 0").count() == 0


def test_many_repeats_of_one_row(spark):
    df = spark.createDataFrame([(1, "a b c", "x")] * 300 + [(2, "d e", "y")] * 300, "doc_id long, text string, source string")
    rows = mixing.mix_report(df).collect()
    for i, s in ((1, 900), (2, 600)):
        assert abs(sum(r.taken for r in rows if r.doc_id == i) - next(r.target for r in rows if r.doc_id == i)) <= 3
