"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation is learnt on a bounded sample: principal axes, then in turns the binary
codes of the rotated sample and the rotation that fits them best.  A code has 64
bits, cut into 4 tables of 16.  A vector is at home, per table, in the bucket of its
16 bits, and also visits the buckets got by turning over the bits it is least sure of.
Whoever meets in a bucket, one of them being at home there, is reranked by the cosine
of the original vectors, in double precision.

Equal vectors are folded first.  A bucket is compared in tiles of bounded size, and a
tile answers with sums and a spanning forest of its links: a cloud of n near copies
costs comparisons, but never a list of its pairs.  A pair that meets several times is
counted once, in the first of its meetings, which both ends can work out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import saved
from claimweave.llm.vectors import directions, lengths, matrix, usable
from claimweave.operators.groups import components

COSINE = 0.95
BITS, TABLES = 64, 4
WIDTH = BITS // TABLES
# bits turned over in the visits of a table, by how unsure they are; none: the home
VISITS = [(), (0,), (1,), (2,), (3,), (0, 1), (0, 2), (1, 2)]
SAMPLE, ROUNDS, SEED = 20_000, 40, 29
TILE = 1024
HOME, VISITOR = 1, 2


class Codes:
    """Learnt on the rows of ``x`` (directions); fewer dimensions than bits make several rotations."""

    def __init__(self, x: np.ndarray):
        rng = np.random.default_rng(SEED)
        d = x.shape[1]
        self.mean = x.mean(0)
        _, axes = np.linalg.eigh(np.cov(x - self.mean, rowvar=False, bias=True).reshape(d, d))
        blocks = []
        while sum(b.shape[1] for b in blocks) < BITS:
            k = min(d, BITS - sum(b.shape[1] for b in blocks))
            v = (x - self.mean) @ axes[:, ::-1][:, :k]
            turn, _ = np.linalg.qr(rng.normal(size=(k, k)))
            for _ in range(ROUNDS):
                left, _, right = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
                turn = (left @ right).T
            blocks.append(axes[:, ::-1][:, :k] @ turn)
        # bits of one table come from axes of all strengths
        self.turn = np.concatenate(blocks, 1)[:, np.arange(BITS).reshape(WIDTH, TABLES).T.reshape(-1)]

    def visits(self, x: np.ndarray) -> np.ndarray:
        """Buckets of each row of ``x`` (directions): (rows, tables, visits), the home first."""
        y = ((x - self.mean) @ self.turn).reshape(len(x), TABLES, WIDTH)
        weight = (1 << np.arange(WIDTH)).astype(np.int64)
        home = ((y >= 0) * weight).sum(2)
        unsure = weight[np.argsort(np.abs(y), axis=2, kind="stable")[:, :, :4]]
        flips = [sum((unsure[:, :, k] for k in bits), np.zeros_like(home)) for bits in VISITS]
        return np.stack([home ^ f for f in flips], 2)


def fit(nodes: DataFrame) -> Codes:
    """Learn from about ``SAMPLE`` of the given vectors, one at least, chosen by hash."""
    place = F.pmod(F.xxhash64("node", F.lit("itq")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = nodes.filter(place < SAMPLE / nodes.count()).select("embedding").toArrow()
    if not some.num_rows:
        some = nodes.limit(1).select("embedding").toArrow()
    return Codes(directions(matrix(some.column(0).combine_chunks())))


def buckets(nodes: DataFrame, codes: Codes) -> DataFrame:
    """(node, bucket, home): bucket counts through all tables."""
    shared = nodes.sparkSession.sparkContext.broadcast(codes)  # 64 axes

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                seen = shared.value.visits(directions(matrix(batch.column(1))))
                seen = seen + (np.arange(TABLES) << WIDTH)[None, :, None]
                home = np.zeros(seen.shape, bool)
                home[:, :, 0] = True
                node = np.repeat(batch.column(0).to_numpy(), TABLES * len(VISITS))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(seen.reshape(-1).astype(np.int32)), pa.array(home.reshape(-1))], names=["node", "bucket", "home"])

    return nodes.select("node", "embedding").mapInArrow(keys, "node long, bucket int, home boolean")


def tiles(keys: DataFrame) -> DataFrame:
    """(node, bucket, tile, role): who is compared where.

    A bucket of more than ``TILE`` rows is cut into tiles of about that many at home
    against as many visitors (those at home visit, too); a row goes to all tiles of its
    line or column.
    """
    sizes = keys.groupBy("bucket").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("rows"))
    sizes = sizes.filter("homes > 0 AND rows > 1").select("bucket", F.ceil(F.col("homes") / TILE).alias("h"), F.ceil(F.col("rows") / TILE).alias("v"))
    met = keys.join(sizes, "bucket")
    line = F.pmod(F.xxhash64("node", F.lit("line")), F.col("h"))
    column = F.pmod(F.xxhash64("node", F.lit("column")), F.col("v"))
    one = (F.col("h") == 1) & (F.col("v") == 1)
    small = met.filter(one).select("node", "bucket", F.lit(0).cast("long").alias("tile"), F.when(F.col("home"), HOME + VISITOR).otherwise(VISITOR).alias("role"))
    large = met.filter(~one)
    zero = F.lit(0).cast("long")
    over_columns = F.transform(F.sequence(zero, F.col("v") - 1), lambda c: line * F.col("v") + c)
    over_lines = F.transform(F.sequence(zero, F.col("h") - 1), lambda r: r * F.col("v") + column)
    across = large.filter("home").select("node", "bucket", F.explode(over_columns).alias("tile"), F.lit(HOME).alias("role"))
    down = large.select("node", "bucket", F.explode(over_lines).alias("tile"), F.lit(VISITOR).alias("role"))
    return small.unionByName(across).unionByName(down)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Label of each of n places: the smallest place it is linked to, by links a - b."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare(node: np.ndarray, copies: np.ndarray, role: np.ndarray, x: np.ndarray, seen: np.ndarray, bucket: int, cosine: float):
    """Links of one tile: (node, linked rows) sums and (node, root) edges.

    ``x`` holds directions and ``seen`` the buckets of each row, table by table.
    """
    at_home, visiting = np.flatnonzero(role & HOME), np.flatnonzero(role & VISITOR)
    h, v = np.nonzero(x[at_home] @ x[visiting].T >= cosine - 1e-9)
    h, v = at_home[h], visiting[v]
    keep = node[h] != node[v]
    h, v = h[keep], v[keep]
    # products of matrices may differ in the last bit from place to place, sums of rows do not
    close = np.empty(len(h), bool)
    for a in range(0, len(h), 1 << 15):
        own = slice(a, a + (1 << 15))
        close[own] = (x[h[own]] * x[v[own]]).sum(1) >= cosine
    h, v = h[close], v[close]
    label = forest(h, v, len(node))
    table = bucket >> WIDTH
    lower = node[h] < node[v]
    lo, hi = np.where(lower, h, v), np.where(lower, v, h)
    first = np.ones(len(h), bool)
    for t in range(table + 1):
        at_lo = (seen[hi, t] == seen[lo, t, 0][:, None]).any(1)
        at_hi = (seen[lo, t] == seen[hi, t, 0][:, None]).any(1)
        if t < table:
            first &= ~(at_lo | at_hi)
        else:
            first &= np.where(at_lo, seen[lo, t, 0], seen[hi, t, 0]) == bucket
            # both at home: they meet twice in one bucket
            first &= (seen[lo, t, 0] != seen[hi, t, 0]) | (h == lo)
    h, v = h[first], v[first]
    sums = np.bincount(h, weights=copies[v], minlength=len(node)) + np.bincount(v, weights=copies[h], minlength=len(node))
    some, moved = np.flatnonzero(sums), np.flatnonzero(label != np.arange(len(node)))
    return node[some], sums[some].astype(np.int64), node[moved], node[label[moved]]


def links(nodes: DataFrame, codes: Codes, cosine: float) -> DataFrame:
    """Per tile, (node, n, root): n linked rows, or a node linked with a root."""
    shared = nodes.sparkSession.sparkContext.broadcast(codes)
    keys = saved(buckets(nodes, codes), "itq-keys")
    rows = tiles(keys).join(nodes, "node").select("bucket", "tile", "role", "node", "copies", "embedding")

    def answer(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        group = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        bucket, tile, role, node, copies = (group.column(c).to_numpy() for c in range(5))
        x = directions(matrix(group.column(5)))
        seen = shared.value.visits(x) + (np.arange(TABLES) << WIDTH)[None, :, None]
        cuts = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(tile) != 0)) + 1
        nodes_out, sums_out, roots_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)], strict=True):
            if b - a > 1:
                own = slice(a, b)
                some, sums, moved, roots = compare(node[own], copies[own], role[own], x[own], seen[own], int(bucket[a]), cosine)
                nodes_out += [some, moved]
                sums_out += [sums, np.zeros(len(moved), np.int64)]
                roots_out += [np.zeros(len(some), np.int64), roots]
        n = np.concatenate(sums_out)
        root = pa.array(np.concatenate(roots_out), mask=n > 0)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes_out)), pa.array(n), root], names=["node", "n", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole tiles at a time: the last tile of a batch waits for the next batch."""
        waiting: list[pa.RecordBatch] = []

        def ends_of(batch: pa.RecordBatch, k: int) -> tuple:
            return batch.column(0)[k].as_py(), batch.column(1)[k].as_py()

        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, tile = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            last = np.flatnonzero((bucket != bucket[-1]) | (tile != tile[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            begins_new = not waiting or ends_of(waiting[-1], -1) != ends_of(batch, 0)
            if cut or begins_new:
                if cut:
                    waiting.append(batch.slice(0, cut))
                if waiting:
                    yield answer(waiting)
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield answer(waiting)

    dealt = rows.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile")
    return dealt.mapInArrow(run, "node long, n long, root long")


def grouped(nodes: DataFrame, cosine: float) -> DataFrame:
    """(node, n_other, group_id, embedding, copies) of ``nodes``, all of one length."""
    seen = saved(links(nodes, fit(nodes), cosine), "itq-links")
    sums = seen.groupBy("node").agg(F.sum("n").alias("n_other"))
    groups = components(seen.filter("root IS NOT NULL").select(F.col("node").alias("a"), F.col("root").alias("b")))
    found = nodes.join(sums, "node", "left").join(groups.toDF("node", "group_id"), "node", "left")
    return found.select("node", F.coalesce("n_other", F.lit(0)).alias("n_other"), F.coalesce("group_id", "node").alias("group_id"), "embedding", "copies")


def near_vectors(df: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``df`` (vec_id, embedding).

    n_links counts the other rows linked directly, component_id is the smallest vec_id
    reachable, kept says whether that is the row's own.  Vectors that are NULL, zero, or
    hold NULL or non-finite components are linked with nothing, as are rows without
    vec_id.  Only vectors of one length have a cosine: each length is searched by itself,
    with codes of its own, in a run of jobs.  Equal vectors are linked; rows that repeat a
    vec_id with another vector of that length share its links.  Other columns are not read; no rows: no
    rows.

    Reported links are exact; a pair may be missed if it meets in no bucket.
    """
    rows = df.select("vec_id", "embedding")
    good = rows.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    # a vec_id that is repeated at another length is a node of each
    nodes = good.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    nodes = saved(nodes, "itq-nodes")
    found = nodes.select("node", F.lit(0).cast("long").alias("n_other"), F.col("node").alias("group_id"), "embedding", "copies").limit(0)
    for length in lengths(nodes, "embedding"):
        found = found.unionByName(saved(grouped(nodes.filter(F.size("embedding") == length), cosine), "itq-found"))
    named = rows.withColumn("_good", F.col("vec_id").isNotNull()).join(found.withColumn("_good", F.lit(True)), ["embedding", "_good"], "left")
    component = F.coalesce("group_id", "vec_id")
    return named.select(
        "vec_id",
        F.coalesce(F.col("n_other") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
