"""Each stage against a brute-force version of what it must keep, on the smallest tables."""

import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
from claimweave.llm import mixing, pretokens
from claimweave.llm.base import saved, table

from tests.llm.test_mixing import fill
from tests.llm.test_partenum import brute, word_sets
from tests.llm.test_tokens import check_packing

FOLDER = "/root/testdata/sf0.001"


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language", "near_copies", "mix", "sequences"]

    told = saved(steps["language"](spark, docs, FOLDER), "t")
    assert told.columns == columns
    want = sorted(r for r in docs.collect() if any(c.isalpha() for c in r.text or ""))
    assert sorted(told.collect()) == want

    single = saved(steps["near_copies"](spark, told, FOLDER), "t")
    assert single.columns == columns
    groups = brute(word_sets(want))
    want = sorted(r for r in want if groups[r.doc_id] == r.doc_id)
    assert sorted(single.collect()) == want

    mixed = saved(steps["mix"](spark, single, FOLDER), "t")
    assert mixed.columns == columns
    rows = mixed.collect()
    times = Counter(r.doc_id for r in rows)
    assert set(rows) <= set(want) and max(times.values()) <= 2
    sizes = Counter()
    for r in want:
        sizes[r.source] += words(r.text)
    goal = fill(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes))}, 1.5 * sum(sizes.values()))
    for s in sizes:
        taken = sum(words(r.text) for r in rows if r.source == s)
        assert abs(taken - goal[s]) <= 2 * max(words(r.text) for r in want if r.source == s)
    report = {r.doc_id: r.taken for r in mixing.mix_report(single).collect()}
    assert {i: n for i, n in report.items() if n} == {i: times[i] * words(next(r.text for r in want if r.doc_id == i)) for i in times}

    library = pretokens.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    pieces = steps["sequences"](spark, mixed, FOLDER).collect()
    check_packing(library, mixed, pieces)
    assert Counter(p.doc_id for p in pieces if p.start == 0) == times
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, pieces))


def test_awkward_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = saved(stage(spark, docs, FOLDER), "t")
            assert out.columns == docs.columns
            docs = out
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= docs.count()


def test_the_last_stage_holds_less_and_packs_the_same(spark, odd_docs, monkeypatch):
    import corpus_pipeline
    from claimweave.llm import packing, pretokens
    from claimweave.llm.queries import word_bpe

    assert pretokens.encoder(word_bpe(), 3).remembered == 3
    held = []
    real = packing.cut_pieces
    monkeypatch.setattr(packing, "cut_pieces", lambda *a, **k: held.append(k) or real(*a, **k))
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    small = packing.pack_documents(docs, word_bpe(), 64, 3)
    assert sorted(map(repr, small.collect())) == sorted(map(repr, packing.pack_documents(docs, word_bpe()).collect()))
    corpus_pipeline.sequences(spark, docs, "")
    assert held[2] == {"block_bytes": 1 << 20, "remembered": 200_000}
