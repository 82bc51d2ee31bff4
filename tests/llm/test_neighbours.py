"""Quality by neighbours: held-out accuracy, a loop over all pairs, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from claimweave.llm import neighbours

FOLDER = "/root/testdata/sf0.01"


def tables(spark, folder=FOLDER):
    return (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))


def terms(text):
    """Byte pairs, pairs of kinds and levels of repetition, one by one."""
    raw = b"\0" + text.encode() + b"\0"
    kind = bytes(0x80 if b > 127 else ord("a") if 97 <= b <= 122 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b for b in raw)
    out = Counter((raw[k] << 8) | raw[k + 1] for k in range(len(raw) - 1))
    out.update((1 << 16) + ((kind[k] << 8) | kind[k + 1]) for k in range(len(raw) - 1))
    words = "".join(c.lower() if c.isascii() else c for c in text).split()
    repeated = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out.update((1 << 17) + j for j in range(6) if repeated << j >= len(words) + neighbours.STEADY)
    return dict(out)


def test_terms_one_by_one():
    texts = ["", "a", "The the end. ÄÖ 12", "the " * 60, "x", "a b " * 400_000, " ", "Ü" * 300_000]
    raw = [t.encode() for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    found = neighbours.counted_terms(np.frombuffer(b"".join(raw), np.uint8), starts)
    for text, (codes, n) in zip(texts, found, strict=True):
        assert dict(zip(codes.tolist(), n.tolist(), strict=True)) == terms(text)


def test_held_out_accuracy_and_folds(spark):
    docs, labels = tables(spark)
    found = {r["doc_id"]: r for r in neighbours.score_documents(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found.values())
    held = [(found[r["doc_id"]], r["quality"]) for r in labels.collect() if found[r["doc_id"]]["held_out"]]
    good = np.array([f["predicted"] == q for f, q in held])
    assert good.mean() >= 0.97
    one, zero = ([f["score"] for f, q in held if q == x] for x in (1, 0))
    assert np.mean([a > b for a in one for b in zero]) >= 0.99


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    plain = neighbours.score_documents(docs, labels).collect()
    turned = labels.withColumn("quality", neighbours.F.when(neighbours.held_out(neighbours.F.col("doc_id")), 1 - labels.quality).otherwise(labels.quality))
    assert sorted(neighbours.score_documents(docs, turned).collect()) == sorted(plain)


def test_scores_against_a_loop():
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab c!D"), n)) for n in rng.integers(0, 60, 80)]
    counted = [(np.array(sorted(terms(t))), np.array([terms(t)[c] for c in sorted(terms(t))])) for t in texts]
    labels = rng.integers(0, 2, 60).astype(float)
    voters = neighbours.build(counted[:60], labels, dimensions=7)
    vectors = voters.embed(counted)
    for at in range(60, 80):
        cos = [math.fsum(a * b for a, b in zip(vectors[at], v, strict=True)) for v in voters.vectors]
        near = sorted(range(60), key=lambda k: (-round(cos[k], 9), k))[: neighbours.NEIGHBOURS]
        weights = [max(cos[k], 0) ** neighbours.SHARPNESS for k in near]
        want = sum(w * labels[k] for w, k in zip(weights, near, strict=True)) / sum(weights) if sum(weights) else voters.prior
        assert voters.score([counted[at]])[0] == pytest.approx(want, abs=1e-6)


def test_no_labels_no_rows_and_odd_rows(spark, no_docs, odd_docs):
    kind = "doc_id long, quality int, toxic int, text string"
    none = spark.createDataFrame([], kind)
    marked = spark.createDataFrame([(1, 1, 0, "x"), (1, 0, 0, "x"), (2, None, 0, "x"), (None, 1, 0, "x"), (6, 0, 0, "x"), (9, 1, 0, "x"), (77, 1, 0, "x")], kind)
    assert neighbours.score_documents(no_docs, marked).collect() == []
    assert {r["score"] for r in neighbours.score_documents(odd_docs, none).collect()} == {0.5}
    found = neighbours.score_documents(odd_docs, marked).collect()
    assert len(found) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in found)
    assert len({r["score"] for r in found if r["doc_id"] == 9}) == 1
