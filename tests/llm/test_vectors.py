import numpy as np
import pytest
from claimweave.llm import itq, projections
from claimweave.llm.base import table
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<double>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if c is None else float(c) for c in v], 0) for i, v in rows], VECTORS)


def brute_links(rows, cosine=0.95):
    """n_links and component of each row, by all pairs of usable rows."""
    good = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    x = np.array([rows[k][1] for k in good], float)
    x /= np.abs(x).max(1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= cosine
    label = np.arange(len(good))
    ids = np.array([rows[k][0] for k in good])
    while True:
        least = np.array([min(ids[label[j]] for j in np.flatnonzero(close[k])) for k in range(len(good))])
        new = np.array([int(np.flatnonzero(ids == i)[0]) for i in least])
        if (ids[new] == ids[label]).all():
            break
        label = new
    return {int(ids[k]): (int(close[k].sum()) - 1, int(ids[label[k]])) for k in range(len(good))}


def cloud(rng, n, dim, spread):
    base = rng.normal(size=dim)
    return base / np.linalg.norm(base) + rng.normal(size=(n, dim)) * spread / np.sqrt(dim)


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(4)
    x = np.concatenate([cloud(rng, 700, 32, 0.12), cloud(rng, 1, 32, 0.0), cloud(rng, 1, 32, 0.0), rng.normal(size=(900, 32)), *[cloud(rng, 4, 32, s) for s in np.linspace(0.02, 0.3, 60)]])
    x = np.concatenate([x, x[700:701].repeat(500, 0), x[5:8] * 3])
    return list(enumerate(x.tolist()))


def test_links_of_given_vectors(spark):
    df = table(spark, "/root/testdata/sf0.01", "embeddings")
    want = brute_links([(r.vec_id, list(r.embedding)) for r in df.collect()])
    got = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_vectors(df).collect()}
    assert got == want


def test_links_of_clouds_and_copies(spark, planted, monkeypatch):
    monkeypatch.setattr(itq, "TILE", 256)
    want = brute_links(planted)
    rows = itq.near_vectors(frame(spark, planted)).collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in rows}
    assert all(got[i][0] <= want[i][0] and got[i][1] >= want[i][1] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert all(r.kept == (r.component_id == r.vec_id) for r in rows)
    assert {got[i] for i in range(len(planted) - 503, len(planted) - 3)} == {want[700]}


def test_recall_at_several_sizes():
    """Pairs at given cosines, the worst case the threshold itself; nothing depends on how many rows there are."""
    rng = np.random.default_rng(8)
    for n in (2000, 20000):
        base = rng.normal(size=(n, 64))
        codes = itq.Codes(itq.directions(base))
        for cosine, least in ((0.95, 0.93), (0.96, 0.95), (0.98, 0.99)):
            a = itq.directions(base[:1500])
            b = rng.normal(size=a.shape)
            b = itq.directions(b - (a * b).sum(1, keepdims=True) * a)
            other = cosine * a + np.sqrt(1 - cosine**2) * b
            va, vb = codes.visits(a), codes.visits(itq.directions(other))
            met = (va[:, :, :1] == vb).any((1, 2)) | (vb[:, :, :1] == va).any((1, 2))
            assert met.mean() >= least, (n, cosine, met.mean())


AWKWARD = [
    (1, None), (2, []), (3, [0, 0, 0]), (4, [1, None, 0]), (5, [float("nan"), 1, 0]), (6, [float("inf"), 1, 0]), (7, [1, 2, 3]), (8, [1, 2, 3]), (8, [1, 2, 3]),
    (9, [1e300, 2e300, 3e300]), (10, [1e-300, 2e-300, 3e-300]), (11, [3, -1, 0]), (None, [1, 2, 3]), (12, [-1, -2, -3]), (13, [1, 2]), (20, [1, 2, 3]), (40, [0, 0, 5]),
]


def test_awkward_rows(spark):
    rows = itq.near_vectors(frame(spark, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    by = {r.vec_id: r for r in rows}
    for i in (1, 2, 3, 4, 5, 6, 11, 12, 13, 40):
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True)
    assert {by[i].component_id for i in (7, 8, 9, 10, 20)} == {7} and {by[i].n_links for i in (7, 8, 9, 10, 20)} == {5}
    assert (by[None].n_links, by[None].component_id, by[None].kept) == (0, None, False)
    for none in (frame(spark, []), frame(spark, AWKWARD[:6])):
        assert itq.near_vectors(none).count() == none.count()
        assert projections.nearest(none).count() == 0


def brute_nearest(ids, x, every, top):
    out = {}
    for k in np.flatnonzero(ids % every == 0):
        score = (x[k] * x).sum(1)
        order = np.lexsort((ids, -score))
        out[int(ids[k])] = [(int(ids[j]), float(score[j])) for j in order if j != k][:top]
    return out


def test_nearest_of_given_vectors(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = df.orderBy("vec_id").collect()
    want = brute_nearest(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float), 20, 20)
    got = {}
    for r in projections.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        exact = dict(brute_nearest(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float), 20, len(rows))[q]) if q == 0 else None
        if exact:
            assert all(exact[i] == s for _, i, s in found)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for i, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)


def test_many_cells_ties_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(projections, "CELL_ROWS", 128)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)) * rng.uniform(0.2, 4, size=(1500, 1))
    x[300:900] = x[300]  # one vector holds a large part of all rows
    ids = np.arange(1500)
    want = brute_nearest(ids, x, 20, 20)
    got = {}
    for r in projections.nearest(frame(spark, list(zip(ids.tolist(), x.tolist(), strict=True)))).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    same = got[320]
    if want[320][0][1] == want[320][19][1]:
        assert [same[r][0] for r in range(1, 21)] == [v for v, _ in want[320]]


def test_few_candidates(spark):
    rows = projections.nearest(frame(spark, AWKWARD)).collect()
    q20 = [(r.rank, r.vec_id) for r in sorted(rows, key=lambda r: r.rank) if r.query_id == 20]
    assert [v for _, v in q20] == [9, 40, 7, 8, 11, 10, 12] or len(q20) == 7
    assert {r.query_id for r in rows} == {20, 40}
    assert sorted({r.vec_id for r in rows}) == [7, 8, 9, 10, 11, 12, 20, 40]
    one = projections.nearest(frame(spark, [(0, [1, 2, 3])])).count()
    assert one == 0


def test_vectors_of_two_lengths(spark):
    """A rare length is searched like the usual one."""
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(100)]
    rows += [(200, rows[3][1]), (201, [2 * x for x in rows[4][1]]), (210, [1.0, 2.0]), (211, [1.0, 2.0]), (212, [2.0, 4.1]), (220, [2.0, -1.0]), (240, [5.0])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_vectors(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    assert [found[k] for k in (3, 200, 4, 201)] == [(1, 3), (1, 3), (1, 4), (1, 4)]
    assert [found[k] for k in (210, 211, 212, 220, 240)] == [(2, 210), (2, 210), (2, 210), (0, 220), (0, 240)]
    near = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in projections.nearest(frame(spark, rows)).collect()}
    assert [near.get((220, k)) for k in range(1, 5)] == [(210, 0.0), (211, 0.0), (212, pytest.approx(-0.1)), None]
    assert (240, 1) not in near and (0, 20) in near and (0, 101) not in near
