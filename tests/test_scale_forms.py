"""The forms built for scale against plain ones: windows, all pairs, union-find."""

import random
from collections import Counter

import check
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave.functions import ordered, vectors
from claimweave.operators import cells, cluster, contradict, groups, matrix, similar
from claimweave.params import Params
from claimweave.streaming import calls as call_streams


def test_chunked_running_values_equal_plain_windows(spark):
    """One key holds most rows; values must not depend on the chunks."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"), F.col("id").alias("o"),
        F.when(F.col("id") % 5 == 0, F.col("id") % 11).alias("x"),
    )
    spec = {"n": ("sum", F.lit(1)), "top": ("max", F.col("x")), "low": ("min", F.col("x")), "next": ("later_min", F.col("x"))}
    for inclusive in (True, False):
        w = W.partitionBy("k").orderBy("o").rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
        rest = W.partitionBy("k").orderBy("o").rowsBetween(0 if inclusive else 1, W.unboundedFollowing)
        got = ordered.running(df, ["k"], ["o"], ordered.blocks("o", 64), spec, inclusive)
        want = df.select("k", "o", "x", F.coalesce(F.sum(F.lit(1)).over(w), F.lit(0)).alias("n"), F.max("x").over(w).alias("top"), F.min("x").over(w).alias("low"), F.min("x").over(rest).alias("next"))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_pages_hold_every_value_once_in_order(spark):
    df = spark.range(2500).select(F.lit("k").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    rows = ordered.pages(df, ["k"], "v", 1000, {"vs": F.col("v")}).orderBy("page_no").collect()
    assert [len(r["vs"]) for r in rows] == [1000, 1000, 500]
    flat = [v for r in rows for v in r["vs"]]
    assert flat == sorted(flat) and len(set(flat)) == 2500


def cloud(n=240, dims=16, seed=3):
    """Random vectors, a dense cloud of near copies with a third of the rows, and exact copies."""
    r = np.random.RandomState(seed)
    v = r.standard_normal((n, dims))
    v[: n // 3] = v[0] + 0.1 * r.standard_normal((n // 3, dims))
    v[n // 3 : n // 3 + 20] = v[n // 3]
    return v


@pytest.mark.parametrize("tile", [7, 1024])
def test_similar_pairs_equal_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(cells, "TILE", tile)
    v = cloud()
    ids = [f"{i:04d}" for i in range(len(v))]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, v)], "id string, embedding array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = u @ u.T
    first = {}
    for i in range(len(v)):
        first.setdefault(tuple(np.round(u[i], 12)), i)
    kept = sorted(first.values())
    want = {(ids[i], ids[j]) for i in kept for j in kept if i < j and round(s[i, j], 9) > 0.7}
    got = similar.similar_pairs(df, "id", 0.7).collect()
    assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want)
    assert {r["copies_a"] for r in got if r["a"] == ids[80]} <= {20}


@pytest.mark.parametrize("listed", [3, 1024])
def test_every_pair_has_those_between_copies(spark, monkeypatch, listed):
    """Copies, also at other lengths and under one id, ids that repeat or are NULL, and rows without a direction."""
    monkeypatch.setattr(similar, "COPIES", listed)
    v = cloud(n=90)
    v[40:44] *= 3.0
    ids = [f"{i:04d}" for i in range(len(v))]
    ids[7], ids[45], ids[35] = ids[6], ids[44], None
    rows = [(i, x.tolist()) for i, x in zip(ids, v)] + [("none", None), ("zero", [0.0] * 16), ("nought", [0.0] * 16)]
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = np.round(u @ u.T, 9)
    order = [(i, j) for i in range(len(v)) for j in range(len(v)) if ids[i] and ids[j] and ids[i] < ids[j] and s[i, j] > 0.7]
    df = spark.createDataFrame(rows, "id string, embedding array<double>")
    got = [(r["a"], r["b"], round(r["similarity"], 6)) for r in similar.every_pair(df, "id", 0.7).collect()]
    assert sorted(got) == sorted((ids[i], ids[j], round(s[i, j], 6)) for i, j in order)
    assert similar.every_pair(df, "id", 1.0).isEmpty()


def test_given_vectors_with_exact_copies_agree_with_sql(spark, tmp_path):
    import __spark_entry__ as entry

    r = np.random.RandomState(2)
    base = r.standard_normal((12, 8))
    rows = [(i, base[i % 12 if i < 30 else 0].tolist()) for i in range(40)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = check.rows_of(["a", "b", "similarity"], con.execute(entry.oracle_sql()["f1_given_vectors"]).fetchall())
    got = check.rows_of(["a", "b", "similarity"], entry.queries()["f1_given_vectors"](spark, str(tmp_path)).collect())
    assert got == want and len(got) > 100


@pytest.mark.parametrize("tile", [9, 1024])
def test_nearest_equals_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(cells, "TILE", tile)
    v = cloud()
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(f"{i:04d}", x.tolist()) for i, x in enumerate(v)], "id string, embedding array<double>")
    q, b = df.filter("id % 2 = 0").withColumnRenamed("id", "q"), df.filter("id % 2 = 1").withColumnRenamed("id", "b")
    s = np.round(u[::2] @ u[1::2].T, 9)
    want = {f"{2 * i:04d}": f"{2 * int(s[i].argmax()) + 1:04d}" for i in range(len(s)) if s[i].max() > 0.8}
    got = {r["q"]: r["b"] for r in similar.nearest_above(q, b, "q", "b", 0.8).collect()}
    assert got == want


@pytest.mark.parametrize("n", [200, 1000, 3000])
def test_pairs_on_the_threshold_are_found_at_any_size(spark, n):
    """Planted pairs just above the threshold, the worst case; the other rows do not matter."""
    r = np.random.RandomState(11)
    base = r.standard_normal((n, 32))
    a = base[:100] / np.linalg.norm(base[:100], axis=1, keepdims=True)
    b = r.standard_normal(a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.851 * a + np.sqrt(1 - 0.851**2) * b
    rows = [(f"{i:05d}", v.tolist()) for i, v in enumerate(np.concatenate([a, near, base[100:]]))] + [("none", None)]
    df = spark.createDataFrame(rows, "id string, embedding array<double>")
    got = {(x["a"], x["b"]) for x in similar.similar_pairs(df, "id", 0.85).collect()}
    assert {(f"{i:05d}", f"{i + 100:05d}") for i in range(100)} <= got


def clustered(n, dims=128, each=50, spread=0.01, seed=21):
    """Rows in clusters of ``each`` around directions of their own."""
    r = np.random.RandomState(seed)
    middle = np.repeat(r.standard_normal((n // each, dims)), each, axis=0)
    return middle / np.linalg.norm(middle, axis=1, keepdims=True) + spread * r.standard_normal((n, dims))


def directions(spark, v):
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    return u, spark.createDataFrame([(f"{i:06d}", x.tolist(), "") for i, x in enumerate(u)], "id string, v array<double>, g string")


@pytest.mark.parametrize("above", [0.35, 0.7, 0.95])
@pytest.mark.parametrize("kind", ["none", "clusters"])
def test_cells_lose_no_pair(spark, monkeypatch, above, kind):
    """Many small cells: all pairs, the same groups by forests, and the best of each, against one matrix."""
    monkeypatch.setattr(cells, "BLOCK_ROWS", 20)
    monkeypatch.setattr(cells, "TILE", 16)
    v = clustered(400, 8) if kind == "clusters" else np.random.RandomState(4).standard_normal((400, 8))
    u, df = directions(spark, np.concatenate([v, np.zeros((2, 8))])[:400])
    s = np.round(u @ u.T, 9)
    want = {(f"{i:06d}", f"{j:06d}") for i in range(400) for j in range(i + 1, 400) if s[i, j] > above}
    found = cells.meet(df, None, above).collect()
    assert {(r["a"], r["b"]) for r in found} == want and len(found) == len(want)
    links = cells.joined(cells.meet(df, None, above, answer="forest"))
    both = [{r["id"]: r["group_id"] for r in groups.components(x).collect()} for x in (links, spark.createDataFrame([*want, ("z", "z")], "a string, b string"))]
    assert both[0] == both[1]
    one, two = df.filter("id < '000150'"), df.filter("id >= '000150'")
    best = cells.meet(one, two, above, True, "best").groupBy("a").agg(F.min(F.struct((-F.round("similarity", 9)).alias("s"), "b")).alias("m")).collect()
    part = s[:150, 150:]
    assert {r["a"]: r["m"]["b"] for r in best} == {f"{i:06d}": f"{150 + int(part[i].argmax()):06d}" for i in range(150) if part[i].max() >= above}


def test_comparisons_follow_the_neighbourhood_not_the_number_of_rows(spark, monkeypatch):
    """Rows in clusters: as many comparisons a row at 1,000, 4,000 and 16,000 rows."""
    monkeypatch.setattr(cells, "BLOCK_ROWS", 250)
    each = {}
    for above in (0.7, 0.35):
        for n in (1000, 4000, 16000):
            _, df = directions(spark, clustered(n))
            sizes = cells.tiled(cells.placed(df, None, above, 17)).groupBy("block", "i", "j").pivot("side", [0, 1]).count()
            each[above, n] = sizes.select(F.sum(F.col("0") * F.col("1"))).first()[0] / n
        assert each[above, 16000] <= 2.2 * each[above, 1000], each


def test_a_cloud_of_near_copies_gives_few_links(spark):
    r = np.random.RandomState(6)
    _, df = directions(spark, np.ones(16) + 0.05 * r.standard_normal((20_000, 16)))
    links = cells.joined(cells.meet(df, None, 0.7, answer="forest")).cache()
    assert links.count() <= 20_000 * 20
    assert groups.components(links).agg(F.count(F.lit(1)), F.count_distinct("group_id")).first() == (20_000, 1)


def test_rows_travel_once_for_each_tile_and_tiles_grow_with_the_rows(spark):
    """Rows without structure: a row is copied TILES times at most, where tiles of 1,024 rows would need 20 copies and more."""
    _, df = directions(spark, np.random.RandomState(8).standard_normal((20_000, 4)))
    sides = cells.tiled(cells.placed(df, None, 0.0, 17), cells.tile_rows(20_000)).groupBy("side").count().collect()
    assert max(r["count"] for r in sides) <= 20_000 * cells.TILES
    assert cells.tile_rows(10_000_000) == cells.BLOCK_ROWS


def test_a_million_rows_are_cut_into_no_more_tiles_than_a_hundred_thousand(spark, monkeypatch):
    """Copies of a row stay as many while rows grow; blocks hold whole tiles."""
    assert cells.tile_rows(1_000_000) * cells.TILES >= 1_000_000
    monkeypatch.setattr(cells, "BLOCK_ROWS", 900)
    monkeypatch.setattr(cells, "TILE", 64)
    _, df = directions(spark, np.random.RandomState(8).standard_normal((4000, 4)))
    size = cells.tile_rows(4000)
    cuts = cells.tiled(cells.placed(df, None, -1.0, 17), size).filter("side = 1").groupBy("block").agg(F.max("j").alias("j"), F.count_distinct("id").alias("n")).collect()
    assert sum(r["n"] for r in cuts) == 4000 and max(r["n"] for r in cuts) <= size and all(r["j"] == 0 for r in cuts)


@pytest.mark.parametrize("blocks", [300, 100_000])
def test_rows_that_meet_each_other_travel_to_half_the_tiles(spark, monkeypatch, blocks):
    """Only tiles on and above the diagonal, in one block or several; every pair is in one of them, once."""
    monkeypatch.setattr(cells, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(cells, "TILE", 32)
    _, df = directions(spark, np.random.RandomState(8).standard_normal((900, 4)))
    size = cells.tile_rows(900) if blocks > 900 else 64
    rows = cells.tiled(cells.placed(df, None, -1.0, 17), size, True).select("id", "side", "own", "block", "i", "j").collect()
    tiles = {}
    for r in rows:
        assert not r["own"] or r["i"] <= r["j"]
        tiles.setdefault((r["own"], r["block"], r["i"], r["j"]), ([], []))[r["side"]].append(r["id"])
    met = Counter()
    for (own, _, i, j), (one, two) in tiles.items():
        met.update(frozenset((a, b)) for a in one for b in (one if own and i == j else two) if not (own and i == j) or a < b)
    assert len(met) == 900 * 899 // 2 and set(met.values()) == {1}
    if blocks > 900:
        assert len(rows) <= 900 * cells.TILES


def test_packed_vectors_keep_twelve_places(spark):
    u, df = directions(spark, np.random.RandomState(8).standard_normal((300, 24)))
    column = pa.array(vectors.pack(u), pa.binary())
    assert np.abs(cells.matrix(column) - u).max() <= vectors.STEP and np.abs(cells.matrix(column.slice(7, 5)) - u[7:12]).max() <= vectors.STEP
    assert {len(x) for x in vectors.pack(u)} == {24 * 6}
    edge = np.array([[1.0, -1.0, 0.0, 2.0**-25, 1 - 2.0**-25, 1e-12]])
    assert np.abs(vectors.whole(*vectors.unpack(pa.array(vectors.pack(edge), pa.binary()))) - edge).max() <= vectors.STEP


def test_centroids_and_names_of_clusters_with_copies(spark):
    """Copies count each time, travel once; a member without a vector counts for nothing, nor can one without a text give a name."""
    r = np.random.RandomState(4)
    v = r.standard_normal((60, 6))
    v[10:40] = v[10]
    rows = [(f"{i:03d}", f"c{i % 3 if i != 10 else 0}", x.tolist() if i != 5 else None) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "canonical_id string, cluster_id string, embedding array<double>").repartition(4)
    member, given = df.select("canonical_id", "cluster_id"), df.select("canonical_id", "embedding")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    of = {c: [i for i, x in enumerate(rows) if x[1] == c and x[2]] for c in ("c0", "c1", "c2")}
    want = {c: u[i].mean(0) for c, i in of.items()}
    plan = cluster.centroids(member, given)
    got = {x["cluster_id"]: x["centroid"] for x in plan.collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[c], want[c], atol=1e-12) for c in want)
    texts = member.filter("canonical_id <> '011'").select("canonical_id", F.concat(F.lit("text "), "canonical_id").alias("canonical_text"))
    near = {c: min((i for i in of[c] if i != 11), key=lambda i: (-round(float(u[i] @ want[c] / np.linalg.norm(want[c])), 9), i)) for c in want}
    named = {x["cluster_id"]: x["name"] for x in cluster.names(member, given, texts, plan).collect()}
    assert named == {c: f"text {i:03d}" for c, i in near.items()}


def test_cells_are_measured_in_slices(spark, monkeypatch):
    """A batch of Spark against all centres would be a table of 10,000 by 4,096 numbers."""
    plain, most = cells.angles, cells.ROWS

    def few(x, centres):
        assert len(x) <= most
        return plain(x, centres)

    monkeypatch.setattr(cells, "angles", few)
    monkeypatch.setattr(cells, "BLOCK_ROWS", 500)
    _, df = directions(spark, clustered(2000, 8))
    assert cells.placed(df.coalesce(1), None, 0.9, 17).filter("side = 1").count() == 2000


def test_a_task_of_joined_knows_few_ids_at_once(spark, monkeypatch):
    """What is forgotten costs links and joins the same ids; a forest of all 300 would be 290 links."""
    monkeypatch.setattr(cells, "NAMES", 20)
    pairs = [(f"{10 * g + i:04d}", f"{10 * g + j:04d}") for i in range(10) for j in range(i + 1, 10) for g in range(30)]
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    links = cells.joined(df)
    assert 270 < links.count() <= len(pairs)
    assert groups.components(links).agg(F.count(F.lit(1)), F.count_distinct("group_id")).first() == (300, 30)


def test_a_tile_of_ids_that_are_null_or_met_twice(spark):
    """Ids count by their order, NULL after all others; a tile without one of its sides has no answer."""
    ids, place = cells.places(pa.chunked_array([["b", None, "a"], ["é", "b", "z"]], pa.string()))
    assert ids.to_pylist() == ["a", "b", "z", "é", None] and place.tolist() == [1, 4, 0, 3, 1, 2]
    parts = [np.ones((2, 3)), np.full((1, 3), 2.0), np.full((2, 3), 3.0)]
    assert cells.stacked(parts)[:, 0].tolist() == [1, 1, 2, 3, 3] and cells.stacked([]).shape == (0, 0)


def test_a_tile_thins_its_links_as_it_goes(spark, monkeypatch):
    """A cloud whose pairs are far more than a task may hold."""
    monkeypatch.setattr(cells, "LINKS", 1000)
    r = np.random.RandomState(6)
    _, df = directions(spark, np.ones(8) + 0.05 * r.standard_normal((3000, 8)))
    links = cells.meet(df, None, 0.7, answer="forest").collect()
    assert len(links) <= 3000 * 2 * 9
    assert groups.components(spark.createDataFrame([(x["a"], x["b"]) for x in links], "a string, b string")).agg(F.count_distinct("group_id")).first()[0] == 1


def test_zero_vectors_are_linked_with_nothing(spark):
    rows = [("a", [0.0, 0.0]), ("b", [0.0, 0.0]), ("c", [1.0, 0.0]), ("d", [2.0, 0.1]), ("e", None), ("f", [3.0, 0.0])]
    df = spark.createDataFrame(rows, "canonical_id string, embedding array<double>")
    found = {r["canonical_id"]: r["cluster_id"] for r in cluster.link_clusters(df, 0.3).collect()}
    assert len({found[k] for k in "abc"}) == 3 and found["c"] == found["d"] == found["f"] and "e" not in found
    members = {(r["vector_id"], r["member_id"]) for r in similar.vector_members(df, "canonical_id").collect()}
    assert members == {("a", "a"), ("b", "b"), ("c", "c"), ("d", "d"), ("c", "f")}
    near = similar.nearest_above(df.withColumnRenamed("canonical_id", "q"), df.withColumnRenamed("canonical_id", "k"), "q", "k", -1.0, True)
    assert {r["q"]: r["k"] for r in near.collect()} == {"c": "c", "d": "d", "f": "c"}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("ratio", [0.85, 0.75, 0.6])
def test_fuzzy_pairs_lose_nothing(spark, ratio):
    r = random.Random(5)
    texts = set()
    for _ in range(60):
        t = "".join(r.choice("abcé ") for _ in range(r.randint(1, 24))).strip()
        texts.add(t)
        for _ in range(3):
            c = list(t)
            for _ in range(r.randint(0, 3)):
                if c:
                    c[r.randrange(len(c))] = r.choice("abcé")
            texts.add("".join(c).strip())
    texts = sorted(x for x in texts if x)
    df = spark.createDataFrame([(f"{i:03d}", t) for i, t in enumerate(texts)], "canonical_id string, norm_text string")
    want = set()
    for i, a in enumerate(texts):
        for j in range(i + 1, len(texts)):
            n = max(len(a), len(texts[j]))
            if edits(a, texts[j]) <= int(n * (1 - ratio) + 1e-9):
                want.add((f"{i:03d}", f"{j:03d}"))
    got = similar.fuzzy_pairs(df, Params(fuzzy_ratio=ratio)).collect()
    assert {(x["a"], x["b"]) for x in got} == want and len(got) == len(want)


def test_negation_keeps_long_texts_apart(spark):
    long = "the committee has approved the new budget for the coming year"
    df = spark.createDataFrame([("1", long), ("2", "not " + long), ("3", long + "s")], "canonical_id string, norm_text string")
    assert [(r["a"], r["b"]) for r in similar.fuzzy_pairs(df).collect()] == [("1", "3")]


@pytest.mark.parametrize("at_least", [0.5, 0.7])
def test_opposed_pairs_lose_nothing(spark, at_least):
    r = random.Random(9)
    rows = []
    for i in range(200):
        words = ["hot"] * r.randint(0, 1) + [r.choice("abcdefgh") for _ in range(r.randint(1, 6))]
        rows.append((f"{i:03d}", " ".join((["not"] if r.random() < 0.4 else []) + words)))
    def parts(t):
        w = t.split()
        return w.count("not") % 2, set(w) - {"not"}
    want = set()
    for i, (a, x) in enumerate(rows):
        for b, y in rows[i + 1 :]:
            (p, s), (q, u) = parts(x), parts(y)
            if p != q and s and u and round(len(s & u) / len(s | u), 9) >= at_least:
                want.add((a, b))
    df = spark.createDataFrame(rows, "canonical_id string, norm_text string")
    got = similar.opposed_pairs(df, at_least).collect()
    assert {(x["a"], x["b"]) for x in got} == want and len(got) == len(want)


@pytest.mark.parametrize("at_least", [0.3, 0.5, 0.9])
def test_opposed_pairs_of_sets_of_all_sizes(spark, at_least):
    """Sets of 1 to 60 words and parts of them, so that pairs lie in all classes of sizes."""
    r = random.Random(3)
    sets = []
    for n in [1, 2, 2, 3, 4, 6, 7, 8, 9, 10, 11, 14, 20, 26, 34, 45, 60]:
        words = [f"w{r.randrange(90):02d}" for _ in range(n)]
        for _ in range(6):
            sets.append((["not"] if r.random() < 0.5 else []) + [w for w in words if r.random() < r.choice([0.5, 0.8, 1.0])] + [f"w{r.randrange(90)}"])
    rows = [(f"{i:03d}", " ".join(x)) for i, x in enumerate(sets)]
    parts = [("not" in x, set(x) - {"not"}) for x in sets]
    want = {
        (rows[i][0], rows[j][0]) for i, (p, s) in enumerate(parts) for j, (q, u) in enumerate(parts)
        if i < j and p != q and round(len(s & u) / len(s | u), 9) >= at_least
    }
    got = similar.opposed_pairs(spark.createDataFrame(rows, "canonical_id string, norm_text string"), at_least).collect()
    assert {(x["a"], x["b"]) for x in got} == want and len(got) == len(want) and want


def test_claims_that_share_one_frequent_word_do_not_meet(spark):
    """Sets of two words must share both for an overlap of a half: no key of theirs is shared by those with one in common."""
    rows = spark.range(300).select(F.array(F.lit("the"), F.concat(F.lit("w"), F.col("id").cast("string"))).alias("rare"))
    keys = rows.select(F.explode(similar._meeting_keys(F.col("rare"), 0.5, True)).alias("k"), "rare")
    twice = keys.groupBy("k").count().filter("count > 1").count()
    assert twice <= 1  # the one for sets of the frequent word alone


def test_components_equal_union_find(spark):
    r = random.Random(2)
    n = 300
    pairs = [(0, i) for i in range(1, 60)]  # a hub
    pairs += [(i, i + 1) for i in range(100, 180)]  # a chain
    pairs += [(r.randrange(180, n), r.randrange(180, n)) for _ in range(70)]
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame([(f"{a:03d}", f"{b:03d}") for a, b in pairs], "a string, b string")
    got = {x["id"]: x["group_id"] for x in groups.components(df).collect()}
    want = {f"{i:03d}": f"{find(i):03d}" for p in pairs if p[0] != p[1] for i in p}
    assert got == want


def test_micro_clusters_are_flagged(spark):
    m = spark.createDataFrame([(str(i), "big" if i < 3 else "small") for i in range(5)], "canonical_id string, cluster_id string")
    rows = cluster.flag_micro(m).collect()
    assert sorted((r["canonical_id"], r["cluster_id"], r["is_outlier"]) for r in rows)[2:4] == [("2", "big", False), ("3", None, True)]


def test_dense_blocks_are_bounded(spark):
    cells = spark.range(10).select(
        F.lit("e").alias("episode_id"), F.md5(F.col("id").cast("string")).alias("canonical_id"), F.lit(0.5).alias("conviction_avg"),
        F.lit(1).cast("bigint").alias("frequency"), F.lit(1.0).alias("stability_score"), F.lit(True).alias("presence_flag"),
    )
    eps = spark.createDataFrame([("e",), ("f",)], "episode_id string")
    rows = matrix.dense_blocks(eps, cells, Params(max_columns=4)).collect()
    assert sorted((r["episode_id"], len(r["weights"])) for r in rows) == [("e", 2), ("e", 4), ("e", 4), ("f", 2), ("f", 4), ("f", 4)]
    assert all(w["presence_flag"] == (r["episode_id"] == "e") for r in rows for w in r["weights"])


def test_the_grid_of_the_dense_matrix_is_never_broadcast(spark):
    """Its rows are episodes times blocks, which the planner takes for as few as the episodes."""
    cells = spark.range(50).select(
        F.lit("e").alias("episode_id"), F.md5(F.col("id").cast("string")).alias("canonical_id"), F.lit(0.5).alias("conviction_avg"),
        F.lit(1).cast("bigint").alias("frequency"), F.lit(1.0).alias("stability_score"), F.lit(True).alias("presence_flag"),
    )
    rows = matrix.dense_blocks(spark.createDataFrame([("e",), ("f",)], "episode_id string"), cells, Params(max_columns=4))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate explode")]
    assert above.count("strategy=merge") == 2


@pytest.mark.parametrize("heavy", [0, 2, 1000])
def test_overlaps_of_speakers_equal_sets(spark, monkeypatch, heavy):
    """Claims held by few and by most; speakers who share nothing have no row."""
    monkeypatch.setattr(contradict, "BLOCK_SPEAKERS", 7)
    monkeypatch.setattr(contradict, "BLOCK_CLAIMS", 5)
    r = random.Random(14)
    held = {f"s{i:02d}": {f"c{r.randrange(40)}" for _ in range(r.randrange(8))} | ({"all"} if i % 3 else set()) for i in range(30)}
    rows = [(s, c) for s, cs in held.items() for c in cs for _ in range(2)]
    df = spark.createDataFrame(rows, "speaker string, canonical_id string")
    got = {(x["speaker_1"], x["speaker_2"]): (x["shared"], x["only_1"], x["only_2"]) for x in contradict.overlaps(df, heavy).collect()}
    names = sorted(held)
    want = {(a, b): (len(held[a] & held[b]), len(held[a] - held[b]), len(held[b] - held[a])) for a in names for b in names if a < b and held[a] & held[b]}
    assert got == want
    few = contradict.compare_speakers(df, spark.createDataFrame(list(want)[:9], "speaker_1 string, speaker_2 string")).collect()
    assert {(x["speaker_1"], x["speaker_2"]): (x["shared"], x["only_1"], x["only_2"]) for x in few} == {k: want[k] for k in list(want)[:9]}


def test_many_speakers_on_both_sides_are_one_row(spark):
    """1,000 by 1,000 speakers, 100 of whom hold both claims: counted by pair, without the million contradictions."""
    sides = spark.range(1000).select(F.lit("a").alias("canonical_id"), F.col("id"), (F.col("id") % 2).alias("episode_seq")).unionByName(
        spark.range(900, 1900).select(F.lit("b").alias("canonical_id"), F.col("id"), F.lit(0).cast("bigint").alias("episode_seq"))
    )
    mentions = sides.select(
        "canonical_id", F.col("id").cast("string").alias("speaker"), "episode_seq", F.concat(F.lit("e"), "episode_seq").alias("episode_id")
    )
    pairs = spark.createDataFrame([("a", "b", 0.9)], "a string, b string, score double")
    counted = contradict.pair_counts(pairs, mentions)
    assert list(map(tuple, counted.collect())) == [("a", "b", 0.9, 1000, 1000, 100, 999_900, 50)]
    by_type = {r["type"]: (r["contradictions"], r["reversals"]) for r in contradict.counts_by_type(counted).collect()}
    listed = contradict.contradictions(pairs, mentions).groupBy("type").agg(F.count("*").alias("n"), F.count_if("is_reversal").alias("r"))
    assert by_type == {r["type"]: (r["n"], r["r"]) for r in listed.collect()}
    by_episode = {r["episode_id"]: r["contradictions"] for r in contradict.counts_by_episode(counted, mentions).collect()}
    # e0: all of one side and half of the other; e1: half of one side with all of the other
    assert by_episode == {"e0": 1_000_000, "e1": 500_000}


def test_alarm_over_five_batches_with_late_calls_and_eviction(spark, tmp_path):
    """A call is judged by what has come by then; one behind the watermark is left out, old slices are forgotten."""
    start, schema = 1_700_000_000, "call_id bigint, caller bigint, ts timestamp, tokens bigint"
    rng = np.random.default_rng(5)
    batches, no = [], 0
    for b in range(5):
        rows = []
        for _ in range(60):
            rows.append((no, 1 if rng.random() < 0.5 else int(rng.integers(2, 6)), start + 300 * b + int(rng.integers(0, 300)), int(rng.integers(0, 9))))
            no += 1
        if b:
            rows += [(no, 1, start + 300 * b - 60, 5), (no + 1, 1, start + 300 * b - 290, 5)]  # late, and too late
            no += 2
        batches.append(rows)
    for rows in batches:
        spark.createDataFrame(rows, "call_id bigint, caller bigint, s bigint, tokens bigint").select(
            "call_id", "caller", F.timestamp_seconds("s").alias("ts"), "tokens"
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    params = Params(budget_window_s=60, budget_requests=5, budget_tokens=30)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = call_streams.budget_alarm(stream, params).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "state")
    ).trigger(availableNow=True).start()
    run.awaitTermination()

    want, come, newest, slices = [], [], None, set()
    for rows in batches:
        rows = [r for r in rows if newest is None or r[2] > newest - 120]
        come += rows
        newest = max(r[2] for r in rows)
        slices |= {(r[1], (r[2] + k) // 240) for r in rows for k in (0, 60)}
        for i, caller, at, tokens in rows:
            before = [r for r in come if r[1] == caller and at - 60 <= r[2] and (r[2], r[0]) < (at, i)]
            spent = sum(r[3] for r in before)
            if len(before) >= 5 or (tokens > 0 and spent + tokens > 30):
                want.append((i, len(before), spent))
    got = spark.read.parquet(str(tmp_path / "out")).select("call_id", "prior_requests", "prior_tokens").collect()
    assert len(want) > 20 and sorted(map(tuple, got)) == sorted(want)
    left = run.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert left <= sum((s + 1) * 240 >= newest - 120 for _, s in slices) < len(slices) / 2


@pytest.mark.parametrize("ratio", [0.8, 0.85])
def test_texts_of_some_edits_meet_on_pieces(spark, ratio):
    """Edits anywhere in texts that allow three to five of them; texts that only share grams do not meet."""
    pick = random.Random(9)
    letters = "abdeinorstu"
    texts = set()
    for _ in range(70):
        t = "".join(pick.choices(letters, k=pick.randint(13, 38)))
        texts.add(t)
        for _ in range(4):
            u = list(t)
            for _ in range(pick.randint(1, 5)):
                at = pick.randrange(len(u))
                u[at : at + 1] = pick.choice([[], [pick.choice(letters)], [u[at], pick.choice(letters)]])
            texts.add("".join(u))
    rows = [(f"{k:04d}", t) for k, t in enumerate(sorted(texts))]
    most, own, _ = similar.pieces(ratio)
    assert most == 5 and {e for _, e, *_ in own} == {3, 4, 5} and similar.pieces(0.99)[1] == []

    def allowed(n):
        return int(n * (1 - ratio) + 1e-9)

    want = {(a, b) for a, t in rows for b, u in rows if a < b and abs(len(t) - len(u)) <= allowed(max(len(t), len(u))) and edits(t, u) <= allowed(max(len(t), len(u)))}
    df = spark.createDataFrame(rows, "canonical_id string, norm_text string")
    got = [(r["a"], r["b"]) for r in similar.fuzzy_pairs(df, Params(fuzzy_ratio=ratio)).collect()]
    assert len(want) > 50 and set(got) == want and len(got) == len(want)
    base = df.select(F.col("canonical_id").alias("id"), F.col("norm_text").alias("t"), F.length("norm_text").alias("n"), F.lit(0).alias("parity"))
    assert similar._met_on_pieces(base, ratio).count() < 10 * len(want)


def test_alarm_keeps_few_states_for_many_callers(spark, tmp_path, monkeypatch):
    """Callers that share a state are judged apart, that without a number too; tokens may be NULL."""
    monkeypatch.setattr(call_streams, "CALLERS", 3)
    rng = np.random.default_rng(8)
    rows = [
        (no, [None, -5, *range(0, 40)][int(rng.integers(0, 42))], 1_700_000_000 + int(rng.integers(0, 480)), None if no % 9 == 0 else int(rng.integers(0, 9)))
        for no in range(1500)
    ]
    spark.createDataFrame(rows, "call_id bigint, caller bigint, s bigint, tokens bigint").select(
        "call_id", "caller", F.timestamp_seconds("s").alias("ts"), "tokens"
    ).repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("call_id bigint, caller bigint, ts timestamp, tokens bigint").parquet(str(tmp_path / "in"))
    params = Params(budget_window_s=60, budget_requests=6, budget_tokens=15)
    run = call_streams.budget_alarm(stream, params, late="1 hour").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "state")
    ).trigger(availableNow=True).start()
    run.awaitTermination()
    want = []
    for i, caller, at, tokens in rows:
        before = [r for r in rows if r[1] == caller and at - 60 <= r[2] and (r[2], r[0]) < (at, i)]
        spent = sum(r[3] or 0 for r in before)
        over_requests, over_tokens = len(before) >= 6, None if tokens is None else tokens > 0 and spent + tokens > 15
        if over_requests or over_tokens:
            want.append((i, caller, len(before), spent, over_requests, over_tokens))
    got = spark.read.parquet(str(tmp_path / "out")).select("call_id", "caller", "prior_requests", "prior_tokens", "over_requests", "over_tokens").collect()
    assert len(want) > 100 and sorted(map(tuple, got)) == sorted(want)
    assert run.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * 4


def test_short_texts_meet_on_what_few_others_have(spark):
    """Claims of two words share grams with very many others; hardly any two that are far apart are compared."""
    pick = random.Random(5)
    words = ["".join(pick.choices("abdeinorstu", k=pick.randint(2, 9))) + end for end in ("tion", "ing", "ed") for _ in range(40)]
    texts = sorted({f"{pick.choice(words)} {pick.choice(words)}" for _ in range(1500)} | {"ab", "abc", "not abc", "not abd"})
    texts += [t[:-1] for t in texts[::7] if len(t) > 3] + [f"x{t}" for t in texts[::11]]
    rows = [(f"{k:05d}", t) for k, t in enumerate(sorted(set(texts)))]
    found = similar.fuzzy_pairs(spark.createDataFrame(rows, "canonical_id string, norm_text string")).collect()

    def negations(t: str) -> int:
        return sum(w in ("not", "no", "never", "none", "cannot") for w in t.split(" ")) % 2

    def edits(a: str, b: str) -> int:
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    want = set()
    for k, (a, s) in enumerate(rows):
        for b, t in rows[k + 1 :]:
            most = int(max(len(s), len(t)) * 0.15 + 1e-9)
            if min(len(s), len(t)) >= 3 and abs(len(s) - len(t)) <= most and negations(s) == negations(t):
                shared = sum((Counter(s) & Counter(t)).values())
                if max(len(s), len(t)) - shared <= most and edits(s, t) <= most:
                    want.add((a, b))
    assert {(r["a"], r["b"]) for r in found} == want and len(found) == len(want) > 100
    assert {len(dict(rows)[a]) * 15 // 100 for a, _ in want} >= {1, 2, 3}

    base = spark.createDataFrame([(a, t, len(t), negations(t)) for a, t in rows], "id string, t string, n int, parity int")
    assert similar._met_on_rest(base, 0.85).count() < 3 * len(want)


def test_certain_pairs_are_searched_at_their_own_threshold(spark, monkeypatch):
    from claimweave.plans.conversation import Conversations

    searched = []
    real = contradict.opposed_pairs
    monkeypatch.setattr(contradict, "opposed_pairs", lambda rows, at_least, params: searched.append(at_least) or real(rows, at_least, params))
    texts = ["a b c d e f g", "not a b c d e f g", "not a b c d e f h", "a b c", "not a b x", "not a b c x", "a", "not a"]
    c = Conversations(None, None, keep=True)
    c.__dict__["canonicals"] = spark.createDataFrame([(f"{k}", t) for k, t in enumerate(texts)], "canonical_id string, norm_text string")
    some, all_ = sorted(map(tuple, c.certain.collect())), sorted(map(tuple, c.opposed.collect()))
    assert searched == [0.7, 0.5] and some == [r for r in all_ if r[2] >= 0.7] and 0 < len(some) < len(all_)


def test_answers_in_order_are_taken_as_they_are(spark):
    import pandas as pd

    from claimweave.operators import extract

    asked = pd.DataFrame({"a": ["1", "2", None], "b": [1, 2, 3]})
    assert extract.echoes(asked, asked.copy(), ["a", "b"])
    assert not extract.echoes(asked, asked.iloc[::-1], ["a", "b"]) and not extract.echoes(asked, asked.iloc[:2], ["a", "b"])
    rows = spark.createDataFrame([(f"{k}",) for k in range(95)], "utterance_id string").repartition(1)

    def model(frame):
        return frame.assign(response="r", error=None, tokens=1, latency=float(len(frame)))

    out = extract.call_model(rows, model)
    assert sorted(r["latency"] for r in out.collect()) == [5.0] * 5 + [10.0] * 90
    assert out.mapInPandas(lambda frames: (pd.DataFrame({"n": [len(f)]}) for f in frames), "n long").collect()[0]["n"] == 95


def test_strip_trims_every_white_space(spark):
    from claimweave.functions.text import strip
    from pyspark.sql import functions as F

    edges = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
    rows = [(f"{chr(c)}a {chr(c)} b{chr(c)}\n{chr(c)}",) for c in [*range(1, 0x3100), 0xFEFF]] + [("",), (" \n",), (None,), ("x\r\n",)]
    got = spark.createDataFrame(rows, "t string").select(strip(F.col("t")).alias("x"), F.regexp_replace("t", edges, "").alias("y"))
    assert got.filter("NOT x <=> y").count() == 0


def test_opposed_pairs_look_only_for_sizes_that_the_other_side_has(spark, monkeypatch):
    """Sets of one or two words need no order of rarity; a longer one that meets them does, and no pair is lost."""
    asked, ordered = [], []
    real, needs = similar._meeting_keys, similar._needs_order
    monkeypatch.setattr(similar, "_meeting_keys", lambda rare, s, first, own, met: asked.append(list(met)) or real(rare, s, first, own, met))
    monkeypatch.setattr(similar, "_needs_order", lambda n, own, s, met: ordered.append(list(met)) or needs(n, own, s, met))
    rows = [("1", "a b"), ("2", "not b a"), ("3", "not a"), ("4", "c"), ("5", "d e"), ("6", "not f g h i j"), ("7", "j i h g f k"), ("8", "f z")]
    df = spark.createDataFrame(rows, "canonical_id string, norm_text string")
    got = {(r["a"], r["b"]): r["score"] for r in similar.opposed_pairs(df, 0.5).collect()}
    assert got == {("1", "2"): 1.0, ("1", "3"): 0.5, ("6", "7"): round(5 / 6, 9)}
    assert asked == ordered == [[1, 2, 5], [1, 2, 6]]
    assert similar.opposed_pairs(df.filter("canonical_id IN ('1', '4')"), 0.5).count() == 0


def test_short_sets_need_no_order(spark):
    sets = spark.range(1, 9).select(F.col("id").cast("int").alias("n")).select("n", similar._size_class(F.col("n")).alias("own"))
    got = sets.select("n", similar._needs_order(F.col("n"), F.col("own"), 0.5, [1, 2]).alias("x")).orderBy("n").collect()
    assert [r["x"] for r in got][:2] == [False, False]
