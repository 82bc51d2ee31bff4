import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from claimweave.llm import langid
from claimweave.llm.base import table
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = table(spark, FOLDER, "documents")
    lang = {r.doc_id: r for r in docs.select("doc_id", "lang", "text").collect()}
    rows = langid.predict_documents(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    told = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == lang[r.doc_id].lang for r in told) > 0.97 * len(told)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in lang[r.doc_id].text or ""))
        assert 0 <= r.score <= 1


def code_length(training: bytes, text: bytes, order: int) -> float:
    """Byte by byte, with escapes and exclusion, over plain dictionaries."""
    seen = [defaultdict(lambda: defaultdict(int)) for _ in range(order + 1)]
    for part in training.split(b"\xff"):
        for i in range(len(part)):
            for k in range(min(i, order) + 1):
                seen[k][part[i - k : i]][part[i]] += 1
    total = 0.0
    for i in range(len(text)):
        left_out: set = set()
        for k in range(min(i, order), -1, -1):
            there = {b: n for b, n in seen[k].get(text[i - k : i], {}).items() if b not in left_out}
            if not there:
                continue
            whole = sum(there.values()) + len(there)
            if text[i] in there:
                total -= math.log2(there[text[i]] / whole)
                break
            total -= math.log2(len(there) / whole)
            left_out |= set(there)
        else:
            total += math.log2(256 - len(left_out))
    return total


def counted(training: list[bytes]):
    which, size, gram, n = [], [], [], []
    for lang, data in enumerate(training):
        for k in range(1, langid.ORDER + 2):
            found = defaultdict(int)
            for part in data.split(b"\xff"):
                for i in range(len(part) - k + 1):
                    found[int.from_bytes(part[i : i + k], "big")] += 1
            for g, c in found.items():
                which.append(lang), size.append(k), gram.append(g), n.append(c)
    return [np.array(x, np.int64) for x in (which, size, gram, n)]


def test_code_lengths_equal_coding_byte_by_byte(monkeypatch):
    monkeypatch.setattr(langid, "LEAST_COUNT", 1)
    training = ["the cat sat on the mat, the rat sat too".encode() + b"\xffthat hat", "où était l'été, où était le thé".encode() + b"\xffle chat"]
    model = langid.build(["a", "b"], *counted(training))
    texts = ["the mat", "été", "", "xyz zyx", "thé 漢字 the", "that chat", "a", "\x00"]
    monkeypatch.setattr(langid, "CHUNK", 7)
    got = model.bits([t.encode() for t in texts]) / langid.UNIT
    for t, row in zip(texts, got, strict=True):
        for lang in range(2):
            assert row[lang] == pytest.approx(code_length(training[lang], t.encode(), langid.ORDER), abs=0.01)


def test_every_context_of_every_language_is_kept(monkeypatch):
    monkeypatch.setattr(langid, "LEAST_COUNT", 1)
    draw = np.random.default_rng(5)
    training = [bytes(draw.integers(97, 97 + letters, 20_000).astype(np.uint8)) for letters in (26, 25)]
    both = langid.build(["a", "b"], *counted(training))
    assert both.first[-1] - both.first[-2] == len({t[i : i + 4] for t in training for i in range(len(t) - 4)}) > 30_000
    text = training[0][5_000:5_400] + training[1][:400]
    got = both.bits([text])[0]
    assert [langid.build(["x"], *counted([t])).bits([text])[0, 0] for t in training] == got.tolist()
    assert got[1] / langid.UNIT == pytest.approx(code_length(training[1], text, langid.ORDER), abs=0.01)


def test_rare_long_contexts_go_by_their_count_in_all_languages(spark):
    rows = [("a", 5, 0x6162636465, 3), ("b", 5, 0x6162636466, 1), ("a", 5, 0x7162636465, 3), ("a", 4, 0x71626364, 3), ("b", 3, 0x616263, 1)]
    kept = langid.frequent(spark.createDataFrame(rows, "lang string, size int, gram long, n long")).collect()
    assert sorted(tuple(r) for r in kept) == sorted(rows[i] for i in (0, 1, 4))


def test_any_number_of_languages(spark, monkeypatch):
    draw = np.random.default_rng(7)
    rows = []
    for lang in range(70):
        words = ["".join(chr(c) for c in draw.integers(97, 123, 5)) for _ in range(12)]
        rows += [(100 * lang + i, " ".join(draw.choice(words, 40)), f"l{lang:02}") for i in range(8)]
    rows += [(9_000 + i, None, "l70") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = sorted(tuple(r) for r in langid.predict_documents(docs).collect())
    lang = {r[0]: r[2] for r in rows if r[1]}
    assert len(found) == len(rows) and any(r[1] for r in found)
    assert all(r[2] == lang.get(r[0], "und") for r in found)
    monkeypatch.setattr(langid, "AT_ONCE", 100)
    assert [r[:4] for r in found] == [tuple(r)[:4] for r in langid.predict_documents(docs).orderBy("doc_id").collect()]


def test_awkward_rows(spark, odd_docs, no_docs):
    rows = langid.predict_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (3, 4, 5, 7))
    assert langid.predict_documents(no_docs).count() == 0
    kept = langid.with_language(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.count() - 4
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predict_documents(unlabelled).collect()} == {"und"}


def test_stage_keeps_unlabelled_documents(spark, odd_docs, no_docs):
    kept = sorted(langid.with_language(odd_docs).collect(), key=str)
    for lang in (F.lit(None).cast("string"), F.when(langid.remainder(F.col("doc_id")) == 1, F.col("lang"))):
        unlabelled = langid.with_language(odd_docs.withColumn("lang", lang))
        assert unlabelled.columns == odd_docs.columns
        assert sorted((r.asDict() | {"lang": 0} for r in unlabelled.collect()), key=str) == sorted((r.asDict() | {"lang": 0} for r in kept), key=str)
    no_text = odd_docs.withColumn("text", F.when(F.col("lang").isNull() | (langid.remainder(F.col("doc_id")) == 1), F.col("text")))
    assert langid.with_language(no_text).count() == no_text.filter(langid.has_letter(F.col("text"))).count() > 0
    assert langid.with_language(no_docs).count() == 0
