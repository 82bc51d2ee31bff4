"""Nearest neighbours by low-dimensional stable projections, kd-trees and a chi-square stopping test.

Largest inner product becomes least distance: a candidate x gets one more component,
the root of (M^2 - |x|^2) with M the largest length, a query q gets 0; then the squared
distance is |q|^2 + M^2 - 2qx.  Both are projected on 8 Gaussian directions, a stable
law: of two points at squared distance D, the squared distance of the projections is D
times a chi-square variable with 8 degrees of freedom.

Candidates are dealt into cells of a kd-tree over the projections, fitted on a bounded
sample.  A task builds a kd-tree of its own over one cell and takes a query's leaves by
projected distance; their points are verified on original vectors.  It stops when a
point at the k-th distance found would lie within the next leaf's distance with a
chance of ``SURE`` or more.  A query first visits its nearest cell, then, with the bound
from there, the cells for which the test does not hold yet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave.llm.base import saved
from claimweave.llm.vectors import lengths, matrix, usable

TOP, EVERY = 20, 20
DIMENSIONS, SEED, SURE = 8, 31, 0.97
# the tree of cells: fitted on a sample, at most 2**10 cells; a cell's candidates and queries come in chunks
SAMPLE, CELL_ROWS, MOST_LEVELS, LEAF = 20_000, 4096, 10, 64


def chi_square(x: np.ndarray) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.clip(x, 0, 1e6) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for k in range(1, DIMENSIONS // 2):
        term = term * half / k
        total = total + term
    return 1 - np.exp(-half) * total


def kd_leaves(points: np.ndarray, levels: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows of each leaf of a tree that halves the widest side, and the splits (side, value) level by level."""
    rows = [np.arange(len(points))]
    sides, values = np.zeros((1 << levels) - 1, np.int64), np.zeros((1 << levels) - 1)
    for level in range(levels):
        below = []
        for k, own in enumerate(rows):
            at = (1 << level) - 1 + k
            here = points[own]
            if len(own):
                sides[at] = int(np.argmax(here.max(0) - here.min(0)))
                values[at] = np.median(here[:, sides[at]])
            left = here[:, sides[at]] < values[at]
            below += [own[left], own[~left]]
        rows = below
    return rows, sides, values


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``q`` to each box."""
    out = np.zeros((len(q), len(low)))
    for d in range(q.shape[1]):
        gap = np.maximum(np.maximum(low[None, :, d] - q[:, d, None], q[:, d, None] - high[None, :, d]), 0)
        out += gap * gap
    return out


@dataclass
class Plan:
    """Projection, largest length, and the tree of cells; cells are boxes of what lies in them."""

    directions: np.ndarray
    longest: float
    levels: int
    sides: np.ndarray
    values: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def candidates(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(1), 0))
        return np.column_stack((x, rest)) @ self.directions

    def queries(self, x: np.ndarray) -> np.ndarray:
        return x @ self.directions[:-1]

    def cells(self, projected: np.ndarray) -> np.ndarray:
        at = np.zeros(len(projected), np.int64)
        for level in range(self.levels):
            node = (1 << level) - 1 + at
            at = 2 * at + (projected[np.arange(len(projected)), self.sides[node]] >= self.values[node])
        return at

    def distance(self, x: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Squared distance at an inner product, for queries ``x``."""
        return np.maximum((x * x).sum(1) + self.longest**2 - 2 * score, 0)


def fit(rows: DataFrame, dim: int) -> Plan:
    """Plan from about ``SAMPLE`` candidates chosen by hash; there must be some."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    n, longest = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    plan = Plan(np.random.default_rng(SEED).normal(size=(dim + 1, DIMENSIONS)), float(longest), 0, np.zeros(0, np.int64), np.zeros(0))
    levels = min(MOST_LEVELS, max(0, math.ceil(math.log2(n / CELL_ROWS))))
    place = F.pmod(F.xxhash64("vec_id", F.lit("cells")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = rows.filter(place < SAMPLE / n).select("embedding").toArrow() if levels else None
    if some is not None and some.num_rows:
        plan.levels = levels
        _, plan.sides, plan.values = kd_leaves(plan.candidates(matrix(some.column(0).combine_chunks())), levels)
    return plan


class Leaves:
    """The kd-tree of one task over candidates of one cell."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, plan: Plan):
        points = plan.candidates(x)
        rows, _, _ = kd_leaves(points, max(0, math.ceil(math.log2(max(1, len(ids)) / LEAF))))
        self.rows = [r for r in rows if len(r)]
        self.low = np.array([points[r].min(0) for r in self.rows])
        self.high = np.array([points[r].max(0) for r in self.rows])
        self.ids, self.x, self.plan = ids, x, plan

    def search(self, ids: np.ndarray, x: np.ndarray, bound: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Best (ids, scores) of each query, at least ``bound``; unused places hold a score of minus infinity."""
        away = box_distance(self.plan.queries(x), self.low, self.high)
        turn = np.argsort(away, axis=1, kind="stable")
        none = np.iinfo(np.int64).max
        best_ids, best = np.full((len(x), top), none), np.full((len(x), top), -np.inf)
        slack = 1e-9 * (1 + np.sqrt((x * x).sum(1)) * self.plan.longest)
        active = np.arange(len(x))
        for step in range(len(self.rows)):
            least = np.maximum(best[active, -1], bound[active])
            reach = self.plan.distance(x[active], least)
            next_away = away[active, turn[active, step]]
            # a point as near as the k-th would show up to here with a chance of SURE
            done = np.isfinite(least) & (chi_square(next_away / np.maximum(reach, 1e-300)) >= SURE)
            active = active[~done]
            if not len(active):
                break
            leaf = turn[active, step]
            for k in np.unique(leaf):
                who, own = active[leaf == k], self.rows[k]
                least = np.maximum(best[who, -1], bound[who]) - slack[who]
                q, c = np.nonzero((x[who] @ self.x[own].T >= least[:, None]) & (self.ids[own][None, :] != ids[who][:, None]))
                if not len(q):
                    continue
                # sums of rows do not depend on the place, as a product of matrices may
                score = (x[who[q]] * self.x[own[c]]).sum(1)
                wide = len(own)
                new_ids, new = np.full((len(who), wide), none), np.full((len(who), wide), -np.inf)
                good = score >= bound[who[q]]
                new_ids[q[good], c[good]], new[q[good], c[good]] = self.ids[own[c[good]]], score[good]
                all_ids, all_scores = np.hstack((best_ids[who], new_ids)), np.hstack((best[who], new))
                order = np.lexsort((all_ids, -all_scores))[:, :top]
                best_ids[who], best[who] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_scores, order, 1)
        return best_ids, best


def visits(queries: DataFrame, plan: Plan, chunks: dict[int, int], first: bool) -> DataFrame:
    """(cell, chunk, query_id, bound, embedding): the nearest cell of each query, or the others that may hold more.

    ``chunks`` says in how many pieces the candidates of a cell come.
    """
    shared = queries.sparkSession.sparkContext.broadcast((plan, chunks))  # 2**10 cells at most

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, chunks = shared.value
        pieces = np.array([chunks.get(c, 0) for c in range(1 << plan.levels)])
        for batch in batches:
            if not batch.num_rows:
                continue
            x, bound = matrix(batch.column(2)), batch.column(1).to_numpy()
            away = box_distance(plan.queries(x), plan.low, plan.high)
            nearest = np.argmin(away, 1)
            if first:
                q, cell = np.arange(len(x)), nearest
            else:
                open_ended = ~np.isfinite(bound)
                reach = plan.distance(x, np.where(open_ended, 0.0, bound))[:, None]
                more = open_ended[:, None] | (chi_square(away / np.maximum(reach, 1e-300)) < SURE)
                more[np.arange(len(x)), nearest] = False
                more &= np.isfinite(plan.low[:, 0])[None, :]
                q, cell = np.nonzero(more)
            piece = np.concatenate([np.arange(pieces[c]) for c in cell]) if len(cell) else np.zeros(0, np.int64)
            q, cell = np.repeat(q, pieces[cell]), np.repeat(cell, pieces[cell])
            out = [pa.array(cell), pa.array(piece.astype(np.int64)), batch.column(0).take(pa.array(q)), batch.column(1).take(pa.array(q)), batch.column(2).take(pa.array(q))]
            yield pa.RecordBatch.from_arrays(out, names=["cell", "chunk", "query_id", "bound", "embedding"])

    kind = queries.schema["embedding"].dataType.simpleString()
    return queries.select("query_id", "bound", "embedding").mapInArrow(choose, f"cell long, chunk long, query_id long, bound double, embedding {kind}")


def found_in_cells(visiting: DataFrame, held: DataFrame, plan: Plan, top: int) -> DataFrame:
    """(query_id, vec_id, score) lists of each visit: one row per query and piece of a cell."""
    shared = held.sparkSession.sparkContext.broadcast(plan)
    # queries of one piece come in blocks, each with a copy of the piece
    blocks = visiting.groupBy("cell", "chunk").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("blocks"))
    asked = visiting.join(blocks, ["cell", "chunk"]).withColumn("block", F.pmod(F.xxhash64("query_id", F.lit("block")), F.col("blocks")))
    given = held.join(blocks, ["cell", "chunk"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))

    def search(asked: pa.Table, given: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
        if not asked.num_rows or not given.num_rows:
            return pa.Table.from_arrays([pa.array([], k) for k in kinds], names=names)
        given = given.sort_by("vec_id").combine_chunks()
        leaves = Leaves(given.column("vec_id").to_numpy(), matrix(given.column("embedding").combine_chunks()), shared.value)
        asked = asked.combine_chunks()
        ids = asked.column("query_id").to_numpy()
        best_ids, best = leaves.search(ids, matrix(asked.column("embedding").combine_chunks()), asked.column("bound").to_numpy(), top)
        counts = np.isfinite(best).sum(1)
        used, ends = np.isfinite(best), np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v[used])) for v in (best_ids, best)]
        return pa.Table.from_arrays([pa.array(ids), *lists], names=names)

    key = ["cell", "chunk", "block"]
    both = asked.select(*key, "query_id", "bound", "embedding").groupBy(*key).cogroup(given.select(*key, "vec_id", "embedding").groupBy(*key))
    return both.applyInArrow(search, "query_id long, vec_id array<long>, score array<double>")


def best_of(found: DataFrame, top: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``top`` of the lists."""
    each = found.select("query_id", F.explode(F.arrays_zip("vec_id", "score")).alias("c")).select("query_id", "c.vec_id", "c.score")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def nearest(df: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by ``every``, its ``top`` largest inner products.

    Candidates are all rows with another vec_id; ties go to the smaller vec_id.  Vectors
    that are NULL, zero, or hold NULL or non-finite components take no part, nor do rows
    without vec_id.  Only vectors of one length have a product: each length is searched by
    itself, in a run of jobs; a vec_id with vectors of several lengths gets one list of
    all.  A row that repeats vec_id and vector is a candidate and a query once.  Other
    columns are not read; no rows: no rows.  Scores are exact; which rows are found is a
    matter of chance (``SURE`` for each).
    """
    rows = df.select("vec_id", "embedding").filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = saved(rows.dropDuplicates(["vec_id", "embedding"]), "ann-rows")
    found = df.sparkSession.createDataFrame([], "query_id long, vec_id array<long>, score array<double>")
    for length in lengths(rows, "embedding"):
        found = found.unionByName(searched(rows.filter(F.size("embedding") == length), length, every, top))
    return best_of(found, top)


def searched(rows: DataFrame, dim: int, every: int, top: int) -> DataFrame:
    """(query_id, vec_id, score) lists that hold the nearest of each query, for vectors of one length."""
    spark = rows.sparkSession
    plan = fit(rows, dim)
    shared = spark.sparkContext.broadcast(plan)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = shared.value.candidates(matrix(batch.column(1)))
                out = [*batch.columns, pa.array(shared.value.cells(points)), pa.FixedSizeListArray.from_arrays(pa.array(points.reshape(-1)), DIMENSIONS).cast(pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(out, names=["vec_id", "embedding", "cell", "point"])

    kind = rows.schema["embedding"].dataType.simpleString()
    dealt = saved(rows.mapInArrow(deal, f"vec_id long, embedding {kind}, cell long, point array<double>"), "ann-cells")
    sides = [f(F.col("point")[d]).alias(f"{name}{d}") for name, f in (("low", F.min), ("high", F.max)) for d in range(DIMENSIONS)]
    boxes = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *sides).collect()  # one row per cell
    plan.low, plan.high = (np.full((1 << plan.levels, DIMENSIONS), np.inf) for _ in range(2))
    for r in boxes:
        plan.low[r["cell"]] = [r[f"low{d}"] for d in range(DIMENSIONS)]
        plan.high[r["cell"]] = [r[f"high{d}"] for d in range(DIMENSIONS)]
    chunks = {r["cell"]: math.ceil(r["n"] / CELL_ROWS) for r in boxes}
    many = spark.createDataFrame([(c, n) for c, n in chunks.items()], "cell long, chunks long")
    held = dealt.join(F.broadcast(many), "cell").select("vec_id", "embedding", "cell", F.pmod(F.xxhash64("vec_id", F.lit("chunk")), F.col("chunks")).alias("chunk"))
    queries = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    at_first = queries.withColumn("bound", F.lit(float("-inf")))
    one = saved(best_of(found_in_cells(visits(at_first, plan, chunks, True), held, plan, top), top), "ann-first")
    kth = one.filter(F.col("rank") == top).select("query_id", F.col("score").alias("bound"))
    then = queries.join(kth, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    two = found_in_cells(visits(then, plan, chunks, False), held, plan, top)
    again = one.groupBy("query_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("c"))  # at most top each
    lists = again.select("query_id", F.col("c.vec_id").alias("vec_id"), F.col("c.score").alias("score"))
    return lists.unionByName(two)
