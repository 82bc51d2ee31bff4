import random
import re

import numpy as np
import pytest
from claimweave.llm import partenum, shingles
from claimweave.llm.base import table

DOCS = "doc_id long, text string"


def word_sets(rows):
    out = {}
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or ""))
        out[r.doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    return out


def brute(sets, percent=80):
    """Smallest id reachable, from all pairs."""
    ids = sorted(i for i in sets if i is not None)
    group = {i: i for i in ids}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    one, two = sorted((find(a), find(b)))
                    group[two] = one
    return {i: find(i) for i in ids}


def compare(df):
    sets = word_sets(df.collect())
    rows = partenum.jaccard_groups(df).collect()
    assert len(rows) == df.count()
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(s) for i, s in sets.items()}
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == brute(sets)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_given_documents(spark, folder):
    compare(table(spark, folder, "documents").select("doc_id", "text"))


def variants(rng, n, of, edits):
    """Texts near a common one, and some near those."""
    base = [f"w{rng.randrange(400)}" for _ in range(of)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        if rng.random() < 0.2:
            base = words
        yield " ".join(words)


def test_texts_around_the_threshold(spark):
    rng = random.Random(5)
    texts = [t for of in (1, 3, 5, 6, 8, 11, 20, 45, 100, 260) for t in variants(rng, 24, of, max(1, of // 30))]
    compare(spark.createDataFrame(list(enumerate(texts)), DOCS))


def test_one_cloud_of_near_copies_and_a_shared_passage(spark):
    rng = random.Random(6)
    texts = list(variants(rng, 150, 120, 2))
    passage = " ".join(f"p{k}" for k in range(30))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 40))) for _ in range(150)]
    texts += ["the very same text again and again"] * 60
    compare(spark.createDataFrame(list(enumerate(texts)), DOCS))


def test_mates_of_a_failed_pivot_are_compared(spark, monkeypatch):
    """All documents are mates of the first, most of them not linked with it: tiles must find every group."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base)]
    for _ in range(40):
        own = [w if rng.random() < 0.7 else f"y{rng.randrange(10**6)}" for w in base]
        for _ in range(rng.randrange(1, 6)):
            near = list(own)
            near[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(near))
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    stars = spark.createDataFrame([(0, i, None, 1) for i in range(1, len(texts))], "a long, b long, hub long, times long")
    monkeypatch.setattr(partenum, "sharing_pairs", lambda *_: stars)
    for unit in (256, 7):
        monkeypatch.setattr(partenum, "UNIT", unit)
        compare(df)


def test_copies_that_only_their_source_links(spark):
    """Each copy is edited in its own way, so that copies are linked with the source alone, which is not the smallest id."""
    rng = random.Random(10)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for _ in range(80):
        own = list(base)
        for k in rng.sample(range(150), 3):
            own[k] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    texts.insert(50, " ".join(base))
    compare(spark.createDataFrame(list(enumerate(texts)), DOCS))


def test_awkward_rows(spark, odd_docs, no_docs):
    rows = partenum.jaccard_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[2].component_id, by[3].n_shingles, by[3].component_id, by[None].component_id) == (1, 0, 3, None)
    assert partenum.jaccard_groups(no_docs).count() == 0
    kept = partenum.without_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9, 11]


def test_similar_sets_always_share_a_signature():
    rng = np.random.default_rng(1)
    bands = partenum.Bands(80)
    for n in [*range(1, 60), 100, 333, 1000]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            drop = rng.integers(0, n // 4 + 1)
            b = np.unique(np.concatenate((a[drop:], rng.integers(0, 1 << 63, rng.integers(0, n // 4 + 1)).astype(np.uint64))))
            if shingles.linked(a, b, 80):
                assert len(np.intersect1d(partenum.signatures(a, bands), partenum.signatures(b, bands)))


def test_windows_change_no_hash(monkeypatch):
    texts = ["one two  three\tfour", "", "x" * 300, "é漢 A b" * 40, " lead", "trail "]
    data = "".join(texts).encode()
    starts = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    arr = np.frombuffer(data, np.uint8)
    want = shingles.word_hashes(arr, starts)
    monkeypatch.setattr(shingles, "WINDOW", 7)
    got = shingles.word_hashes(arr, starts)
    assert (want[0] == got[0]).all() and (want[1] == got[1]).all()
    assert want[1].tolist() == [len(t.split()) for t in texts]


def test_tiles_of_few_rows_find_every_group(spark, monkeypatch):
    """Mates of a failed pivot over many tiles; sets of sizes on both sides of a sketch's length."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(80)]
    texts = [" ".join(base)]
    for _ in range(30):
        own = [w if rng.random() < 0.7 else f"y{rng.randrange(10**6)}" for w in base[: rng.randrange(60, 80)]]
        for _ in range(rng.randrange(1, 6)):
            near = list(own)
            near[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(near))
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    stars = spark.createDataFrame([(0, i, None, 1) for i in range(1, len(texts))], "a long, b long, hub long, times long")
    monkeypatch.setattr(partenum, "sharing_pairs", lambda *_: stars)
    monkeypatch.setattr(partenum, "TILE_ROWS", 14)
    monkeypatch.setattr(partenum, "TILE_WORDS", 64)
    compare(df)


def test_sketches_never_rule_out_a_similar_pair():
    rng = np.random.default_rng(12)
    sets = []
    for n in (1, 2, 5, 31, 32, 33, 63, 64, 65, 127, 130, 500):
        for _ in range(6):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            drop = rng.integers(0, n // 5 + 1)
            sets += [a, np.unique(np.concatenate((a[drop:], rng.integers(0, 1 << 63, rng.integers(0, n // 8 + 1)).astype(np.uint64))))]
    n, sketches = np.array([len(s) for s in sets]), [partenum.measures(s)[2] for s in sets]
    left = set()
    for i, j in partenum.rivals(n, np.arange(len(n)), np.zeros(len(n), int), sketches, 80):
        left |= {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist(), strict=True)}
    wanted = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if shingles.linked(sets[i], sets[j], 80)}
    assert wanted <= left and len(left) < len(sets) ** 2 / 10
    for i, j in wanted:
        assert partenum.difference(sketches[i], sketches[j]) * 180 <= (n[i] + n[j]) * 20


def test_a_cloud_of_copies_each_edited_in_its_own_way(spark):
    rng = random.Random(13)
    base = [f"w{k}" for k in range(80)]
    texts = []
    for _ in range(3000):
        own = list(base)
        for k in rng.sample(range(80), rng.randrange(1, 4)):
            own[k] = f"x{rng.randrange(10**7)}"
        texts.append(" ".join(own))
    compare(spark.createDataFrame(list(enumerate(texts)), DOCS))


def test_different_texts_of_one_doc_id_stay(spark):
    one, two = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    rows = [(1, one, "s", 3), (1, one, "r", 3), (1, two, "s", 3), (2, one, "s", 3), (3, two, "s", 3), (4, None, "s", 3), (4, "", "s", 3)]
    kept = partenum.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string, source string, _rows int"))
    assert sorted((r.doc_id, r.text or "", r.source, r._rows) for r in kept.collect()) == [(1, one, "r", 3), (1, two, "s", 3), (4, "", "s", 3)]
