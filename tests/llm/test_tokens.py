import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from claimweave.llm import packing, pretokens, records, tokens
from claimweave.llm.base import scratch, table
from hypothesis import given, settings
from hypothesis import strategies as st

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "Ünïcödé ÇA <|endoftext|> don't 漢字 é é ½²", "a" * 5000, "aaaaaaaaa bbbb", "I'LL x!!'s ''' 's", "", " \t\n", "\x1f\x00a\x7f", "ǅ İstanbul ΑΣ ﬁ",
    "漢" * 3000, "<|startoftext|><|endoftext|>a", "... --- ####", "thethethethe" * 50, "x " * 3000, "ñ ̃",
]


@pytest.fixture(scope="module")
def library():
    return pretokens.tokenizer(PATH)


@pytest.fixture(scope="module")
def counter():
    return tokens.Counter(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library(spark, library, odd_docs, no_docs):
    for docs in (table(spark, FOLDER, "documents"), odd_docs):
        texts = defaultdict(list)
        for r in docs.collect():
            texts[r.doc_id].append(r.text)
        rows = tokens.count_tokens(docs, PATH).collect()
        assert len(rows) == docs.count()
        for r in rows:
            n = len(ids_of(library, texts[r.doc_id][0]))
            assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((texts[r.doc_id][0] or "").encode()), n > 2048)
    assert tokens.count_tokens(no_docs, PATH).count() == 0


def test_odd_texts(library, counter):
    assert counter(ODD) == [len(ids_of(library, t)) for t in ODD]
    flat, starts = pretokens.Encoder(PATH)(ODD)
    assert [flat[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)] == [ids_of(library, t) for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aehinrstÉß'’.,!<|>09 \n ́漢"), max_size=60))
def test_any_text(text):
    t = test_any_text
    if not hasattr(t, "tools"):
        t.tools = tokens.Counter(PATH), pretokens.Encoder(PATH), pretokens.tokenizer(PATH)
    count, encode, library = t.tools
    assert count([text]) == [len(ids_of(library, text))]
    assert encode([text])[0].tolist() == ids_of(library, text)


def test_windows_lose_nothing(library):
    text = "some words, don't  you\tsee " * 100
    assert "".join(pretokens.windows(text, 50)) == text
    assert sum((ids_of(library, w) for w in pretokens.windows(text, 50)), []) == ids_of(library, text)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packing(library, docs, rows):
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen, places = defaultdict(list), defaultdict(list)
    for r in rows:
        seen[r.doc_id].append(r)
        places[r.sequence_id].append(r)
    assert set(seen) == set(texts)
    for doc, pieces in seen.items():
        ids = [*ids_of(library, texts[doc]), 2]
        copies = len([p for p in pieces if p.start == 0])
        assert sum(p.length for p in pieces) == copies * len(ids)
        for p in pieces:
            assert (p.ids_crc32, p.doc_tokens) == (crc(ids[p.start : p.start + p.length]), len(ids))
    for inside in places.values():
        at = 0
        for p in sorted(inside, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096 and len(inside) <= packing.MAX_SEGMENTS
    return len(places)


def test_packing(spark, library, odd_docs, no_docs):
    docs = table(spark, FOLDER, "documents")
    rows = packing.pack_documents(docs, PATH).collect()
    n = check_packing(library, docs, rows)
    assert n <= 1.03 * sum(r.length for r in rows) / 4096 + 1
    check_packing(library, odd_docs, packing.pack_documents(odd_docs, PATH).collect())
    assert packing.pack_documents(no_docs, PATH).count() == 0


def test_every_limit_holds():
    rng = np.random.default_rng(3)
    t = rng.integers(1, 60, 400)
    loss = np.minimum(t * rng.random(400), 50).astype(np.int64)
    bins, offsets = packing.fill_bins(t, loss, (100, 4, 50))
    for b in set(bins.tolist()):
        own = bins == b
        assert t[own].sum() <= 100 and own.sum() <= 4 and loss[own].sum() <= 50
        assert offsets[own].max() <= t[own].sum() - 1
    with pytest.raises(ValueError):
        packing.fill_bins(np.array([101]), np.array([0]), (100, 4, 50))


def test_groups_are_packed_apart(spark):
    items = spark.range(3000).selectExpr("id", "id % 97 + 1 AS t", "id % 31 AS l", "1 AS offset")
    many = packing.pack(items, ["id"], "t", "l", (100, 8, 60)).collect()
    assert len(many) == 3000 and len({r.sequence_id >> 32 for r in many}) > 5
    again = packing.pack(items.repartition(7), ["id"], "t", "l", (100, 8, 60)).collect()
    assert sorted(many) == sorted(again)


def test_records(spark, library, odd_docs, no_docs):
    for docs in (table(spark, FOLDER, "documents"), odd_docs):
        want, at = [], 0
        for d in sorted(docs.collect(), key=lambda d: (d.doc_id is not None, d.doc_id or 0, d.text or "")):
            ids = [*ids_of(library, d.text), 1]
            want.append((d.doc_id, at, len(ids), crc(ids)))
            at += len(ids)
        assert sorted(map(tuple, records.record_digests(docs, PATH).collect()), key=lambda r: r[1]) == want
    assert records.record_digests(no_docs, PATH).count() == 0


def test_damage_is_noticed_and_records_can_be_read_singly(spark):
    folder = scratch(spark, "records")
    records.write_records(table(spark, FOLDER, "documents"), folder, PATH)
    store, root = records.place(folder)
    with store.open_input_stream(f"{root}/part-000000.idx") as f:
        index = np.frombuffer(f.read(), records.INDEX)
    with store.open_input_file(f"{root}/part-000000.rec") as f:
        data = f.read()
    k = len(index) // 2
    one = data[int(index["offset"][k]) :]
    doc, ids = records.parse(records.unframe(memoryview(one)))
    assert len(ids) == index["n_ids"][k]
    for place in (0, 9, 20):
        bad = bytearray(one)
        bad[place] ^= 1
        with pytest.raises(ValueError):
            records.unframe(memoryview(bytes(bad)))
    assert records.parse(records.payload_of(None, np.array([70000], np.uint32)))[1].tolist() == [70000]


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "a", "ab", "é漢ßäx"])
def test_long_words_without_white_space(letters, monkeypatch):
    rng = random.Random(len(letters))
    counter, library = tokens.Counter(PATH), pretokens.tokenizer(PATH)
    words = ["".join(rng.choice(letters) for _ in range(n)) for n in (1, 2, 3, 40, 1023, 1024, 1025, 3000)]
    want = [len(library.encode(w, add_special_tokens=False).ids) for w in words]
    assert counter(words) == want
    monkeypatch.setattr(pretokens.RankedMerges, "LONG", 2)
    assert tokens.Counter(PATH)(words) == want


def test_a_word_of_a_megabyte():
    rng = random.Random(0)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    counter = tokens.Counter(PATH)
    start = time.time()
    assert counter([word]) == [len(pretokens.tokenizer(PATH).encode(word, add_special_tokens=False).ids)]
    assert time.time() - start < 30


def test_records_of_one_doc_id_fill_many_files_that_many_tasks_read(spark):
    """Most rows have one doc_id and one text; files are read in as many tasks as there are files."""
    rows = [(5, "the same text")] * 300 + [(5, f"another {k}") for k in range(100)] + [(k, "x") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    folder = scratch(spark, "records-test")
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        manifest = records.write_records(df, folder, PATH)
        sizes = [r.records for r in manifest.collect()]
        assert len(sizes) > 4 and max(sizes) < 200
    finally:
        spark.conf.set(conf, old)
    read = records.read_records(spark, folder)
    assert read.rdd.getNumPartitions() == len(sizes)
    found = sorted((r.start, r.doc_id, r.n_tokens) for r in read.collect())
    assert [d for _, d, _ in found] == sorted(d for d, _ in rows)
    assert all(a[0] + a[2] == b[0] for a, b in zip(found, found[1:], strict=False))
