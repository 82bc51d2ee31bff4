"""An exact index for directions: cells around centres, pruned by the triangle inequality of angles.

Centres are fitted to a bounded sample.  Every vector is in the cell of its nearest
centre, and of each cell it is known how near and how far its members are from its own
centre and from some others.  Angles obey the triangle inequality, so a vector has
nobody within an angle in a cell whose range it misses by more than that angle.  Cells
that lie side by side are put together in blocks of up to ``BLOCK_ROWS`` rows; a vector is
at home in one block and visits those with a cell that is left.  Nothing within the
angle is lost, and what is compared follows from how the vectors lie: those in clusters
meet their surroundings, as long as there are no more clusters than cells; vectors
without structure meet all others once, and travel once for each block.

A block is compared in tiles of some thousands of rows at home against as many visitors.
Rows that all meet each other need only the tiles on and above the diagonal.
A task holds the numbers of one tile and takes the product of a thousand of either side at
a time, so rows travel once for each tile and not for each product.  Tiles grow with the
rows, so that copies of a row stay as many, until a tile is as large as a task may hold.
Rows travel packed.  Products of their single numbers, which are off by a known bound at most,
say which pairs may be above the threshold; these are then taken in full.
What is answered is chosen by the caller: the pairs, the links that a spanning forest of a
tile's pairs needs, or the best of each visitor.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.vectors import pack, unpack, whole

TILE = 1024  # rows of either side that are compared at once
TILES = 6  # rows that all meet are cut into so many tiles of either side, of TILE to BLOCK_ROWS rows
TASKS = 256  # that tiles are dealt to, if there are as many
MANY = 1 / 32  # beyond such a part of a product, all of it is taken in full
LINKS = 1 << 20  # links that a task holds before it thins them
NAMES = 1 << 18  # ids that a task of ``joined`` knows before it forgets them
ROWS = 256  # rows that are placed or measured at once
# rows of a block, and of either side of a tile, at most; rows of a cell, as long as there are no more than so many cells
BLOCK_ROWS, CELL_ROWS, MOST_CELLS = 196608, 16, 4096
# the fit: sampled rows for each centre, numbers in the sample, rounds; centres at which all ranges are known
SAMPLED, SAMPLE_NUMBERS, ROUNDS, SHARED = 8, 1 << 23, 4, 32
SLACK = 1e-6  # angles this much beyond a bound still count as within it
PAIR = "a string, b string, similarity double"


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column, or of packed vectors, all of one length."""
    if not pa.types.is_list(column.type) and not pa.types.is_large_list(column.type):
        return whole(*unpack(column))
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def angles(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ centres.T, -1.0, 1.0))


def fit(rows: DataFrame, n: int, seed: int) -> np.ndarray:
    """Centres for ``n`` rows: far points of a sample, then moved to the middle of what is nearest to them."""
    cells = min(MOST_CELLS, math.ceil(n / CELL_ROWS))
    dims = len(matrix(rows.select("v").limit(1).toArrow()["v"].combine_chunks())[0])
    cells = max(1, min(cells, SAMPLE_NUMBERS // (SAMPLED * dims)))
    place = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    x = matrix(rows.filter(place < SAMPLED * cells / n).select("id", "v").toArrow().sort_by("id")["v"].combine_chunks())
    cells = min(cells, len(x))
    chosen, near = [0], x @ x[0]
    while len(chosen) < cells:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    centres = x[chosen]
    for _ in range(ROUNDS):
        own = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-9, sums / np.where(length > 1e-9, length, 1), centres)
    return centres


def side_by_side(centres: np.ndarray) -> list[int]:
    """The centres in an order that keeps near ones together: halved again and again along their widest axis."""
    out, todo = [], [np.arange(len(centres))]
    while todo:
        some = todo.pop()
        if len(some) < 3:
            out += some.tolist()
            continue
        x = centres[some] - centres[some].mean(0)
        axis = x[np.argmax((x * x).sum(1))]
        for _ in range(8):
            axis = x.T @ (x @ axis)
            axis /= max(np.linalg.norm(axis), 1e-300)
        order = some[np.argsort(x @ axis, kind="stable")]
        todo += [order[len(order) // 2 :], order[: len(order) // 2]]
    return out


class Plan:
    """Of every cell, the range of its members' angles at its own centre and at the shared ones; and its block."""

    def __init__(self, rows: DataFrame, centres: np.ndarray, most: int):
        self.centres = centres
        n, self.shared = len(centres), min(SHARED, len(centres))
        known = rows.sparkSession.sparkContext.broadcast(centres)
        width = self.shared + 1

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high, count = np.full((n, width), np.inf), np.full((n, width), -np.inf), np.zeros(n, np.int64)
            for batch in batches:
                for a in range(0, batch.num_rows, ROWS):
                    at = angles(matrix(batch.column(0).slice(a, ROWS)), known.value)
                    own = at.argmin(1)
                    at = np.concatenate((at[:, : width - 1], at.min(1, keepdims=True)), 1)
                    np.minimum.at(low, own, at)
                    np.maximum.at(high, own, at)
                    count += np.bincount(own, minlength=n)
            cell, centre = np.nonzero(high >= 0)
            columns = [cell, centre, low[cell, centre], high[cell, centre], count[cell]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "centre", "low", "high", "n"])

        self.low, self.high, size = np.full((n, width), np.inf), np.full((n, width), -np.inf), np.zeros(n, np.int64)
        found = rows.select("v").mapInArrow(measure, "cell long, centre long, low double, high double, n long")
        found = found.groupBy("cell", "centre").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        for r in found.collect():  # MOST_CELLS times SHARED + 1 at most
            self.low[r["cell"], r["centre"]], self.high[r["cell"], r["centre"]] = r["low"], r["high"]
            size[r["cell"]] = r["n"]
        self.block = np.zeros(n, np.int64)
        held, block = 0, 0
        for cell in side_by_side(centres):
            if held and held + size[cell] > most:
                held, block = 0, block + 1
            self.block[cell] = block
            held += size[cell]
        self.blocks = block + 1

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.block[angles(x, self.centres).argmin(1)]

    def visits(self, x: np.ndarray, reach: float) -> np.ndarray:
        """Which blocks rows may have somebody in, within the angle ``reach``: (rows, blocks)."""
        at = angles(x, self.centres)
        left = (self.low[:, -1] <= at + reach) & (self.high[:, -1] >= at - reach)
        for centre in range(self.shared):
            own = at[:, centre, None]
            left &= (self.low[None, :, centre] <= own + reach) & (self.high[None, :, centre] >= own - reach)
        out = np.zeros((len(x), self.blocks), bool)
        row, cell = np.nonzero(left)
        out[row, self.block[cell]] = True
        return out


def placed(left: DataFrame, right: DataFrame | None, above: float, seed: int) -> DataFrame:
    """(id, v, g, block, own, side): rows at home (side 1) and where they visit (side 0); own says whether that is their block.

    Without ``right``, the rows of ``left`` meet each other: each visits its own block and later ones.
    """
    home = left if right is None else right
    n = home.count()
    if n <= BLOCK_ROWS:
        one = ["id", "v", "g", F.lit(0).cast("long").alias("block"), F.lit(True).alias("own")]
        return left.select(*one, F.lit(0).alias("side")).unionByName(home.select(*one, F.lit(1).alias("side")))
    # blocks of whole tiles, so that none is cut into a full one and a scrap
    most = BLOCK_ROWS // tile_rows(n) * tile_rows(n) or BLOCK_ROWS
    shared = left.sparkSession.sparkContext.broadcast(Plan(home, fit(home, n, seed), most))
    reach = math.acos(max(-1.0, min(1.0, above))) + SLACK
    same = right is None

    def deal(visiting: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            plan = shared.value
            for batch in batches:
                for a in range(0, batch.num_rows, ROWS):
                    some = batch.slice(a, ROWS)
                    x = matrix(some.column(1))
                    own = plan.home(x)
                    row, block = np.arange(len(own)), own
                    if visiting:
                        row, block = np.nonzero(plan.visits(x, reach))
                        if same:
                            later = block >= own[row]
                            row, block = row[later], block[later]
                    marks = [pa.array(block), pa.array(block == own[row]), pa.array(np.full(len(row), int(not visiting), np.int32))]
                    yield pa.RecordBatch.from_arrays([*some.take(pa.array(row)).columns, *marks], names=["id", "v", "g", "block", "own", "side"])

        return run

    kind = f"id string, v {left.schema['v'].dataType.simpleString()}, g string, block long, own boolean, side int"
    columns = ["id", "v", "g"]
    return left.select(*columns).mapInArrow(deal(True), kind).unionByName(home.select(*columns).mapInArrow(deal(False), kind))


def tile_rows(n: int) -> int:
    """Rows of either side of a tile where ``n`` are at home: enough tiles for all tasks, and few copies of a row."""
    return max(TILE, min(BLOCK_ROWS, -(-n // TILES)))


def tiled(rows: DataFrame, size: int = TILE, same: bool = False) -> DataFrame:
    """``placed`` rows with the tiles (i, j) they go to, i counting visitors and j those at home.

    A block beyond a tile of ``size`` rows, such as a cloud of near copies, is cut into tiles
    of both sides, so a task never holds more than one tile of each whatever the skew.
    With ``same``, which is for ``placed`` without ``right``, the rows of a block meet each other in tiles of
    their own, which ``own`` marks: those with i <= j alone, and on the diagonal as side 0 alone.
    """
    place = ["block", "g"]
    if same:
        home, foreign = rows.filter("side = 1"), rows.filter("side = 0 AND NOT own")
        cuts = rows.groupBy(*place).agg(
            F.ceil(F.count_if(F.col("side") == 1) / size).cast("int").alias("cuts"),
            F.ceil(F.count_if((F.col("side") == 0) & ~F.col("own")) / size).cast("int").alias("cuts_0"),
        ).filter("cuts > 0")

        def mine(of: str) -> Column:
            return F.pmod(F.xxhash64("id"), F.col(of)).cast("int")

        def upto(n: str) -> Column:  # nothing for none
            return F.filter(F.sequence(F.lit(0), F.greatest(F.col(n) - 1, F.lit(0))), lambda x: x < F.col(n))

        def tile(i: Column, j: Column, side: Column, own: bool) -> Column:
            return F.struct(side.cast("int").alias("side"), F.lit(own).alias("own"), i.alias("i"), j.alias("j"))

        m = F.col("_mine")
        among = F.transform(upto("cuts"), lambda x: tile(F.least(m, x), F.greatest(m, x), F.when(m <= x, 0).otherwise(1), True))
        seen = F.transform(upto("cuts_0"), lambda x: tile(x, m, F.lit(1), False))
        met = F.transform(upto("cuts"), lambda x: tile(m, x, F.lit(0), False))
        keep = [F.col(c) for c in ("id", "v", "g", "block")]
        one = home.join(cuts, place).withColumn("_mine", mine("cuts")).select(*keep, F.inline(F.concat(among, seen)))
        two = foreign.join(cuts, place).withColumn("_mine", mine("cuts_0")).select(*keep, F.inline(met))
        return one.unionByName(two).select("id", "v", "g", "side", "block", "own", "i", "j")
    # what has nobody at home or no visitor goes
    cuts = rows.groupBy(*place).agg(*[F.ceil(F.count_if(F.col("side") == s) / size).cast("int").alias(f"cuts_{s}") for s in (0, 1)])
    cuts = cuts.filter("cuts_0 > 0 AND cuts_1 > 0")
    cut = rows.join(cuts, place)
    own = F.when(F.col("side") == 0, F.col("cuts_0")).otherwise(F.col("cuts_1"))
    other = F.when(F.col("side") == 0, F.col("cuts_1")).otherwise(F.col("cuts_0"))
    mine = F.pmod(F.xxhash64("id"), own).cast("int")
    each = cut.select("id", "v", "g", "side", "block", "own", mine.alias("_mine"), F.explode(F.sequence(F.lit(0), other - 1)).alias("_theirs"))
    return each.select(
        "id", "v", "g", "side", "block", "own",
        F.when(F.col("side") == 0, F.col("_mine")).otherwise(F.col("_theirs")).alias("i"),
        F.when(F.col("side") == 0, F.col("_theirs")).otherwise(F.col("_mine")).alias("j"),
    )


def label(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Of n places, the smallest that each is joined to by links a - b."""
    out = np.arange(n)
    while True:
        least = np.minimum(out[a], out[b])
        new = out.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == out).all():
            return out
        out = new


def thinned(a: np.ndarray, b: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links a - b between n places; where they are more than ``most``, those of a forest that joins the same."""
    if len(a) <= most:
        return a, b
    root = label(a, b, n)
    moved = np.flatnonzero(root != np.arange(n))
    return root[moved], moved


def places(ids: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct ids in their order, NULL last, and the place of each row's id among them."""
    known = pc.unique(ids)
    known = known.take(pc.sort_indices(known))
    return known, pc.index_in(ids, value_set=known).to_numpy().astype(np.int64)


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    """The rows of all parts, each of which goes as it is copied."""
    out = np.empty((sum(map(len, parts)), parts[0].shape[1] if parts else 0), parts[0].dtype if parts else float)
    end = len(out)
    while parts:
        part = parts.pop()
        out[end - len(part) : end] = part
        end -= len(part)
    return out


def meet(left: DataFrame, right: DataFrame | None, above: float, at_least: bool = False, answer: str = "pairs", seed: int = 17) -> DataFrame:
    """Rows (id, v, g) of equal g whose cosine is above ``above`` (or equal, with ``at_least``), as (a, b, similarity).

    ``v`` has length 1; zero vectors have no direction and meet nobody.  Without
    ``right`` the pairs are of ``left`` with itself, a before b.  Cosines count to 9 places.
    ``answer``: ``pairs``, all of them; ``forest``, per tile the links that join what its
    pairs join, each to the first of them; ``best``, per tile the best b of each a, ties
    to the smaller b.
    """
    left, right = packed(left), None if right is None else packed(right)
    same = right is None

    def answered(ids: pa.Array, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        columns = [ids.take(pa.array(a)), ids.take(pa.array(b)), pa.array(value, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "similarity"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of a batch only its numbers stay, in the order of their sides
        ids, high, low, diagonal = ([], []), ([], []), ([], []), False
        for batch in batches:
            if same and batch.num_rows:
                diagonal = batch["own"][0].as_py() and batch["i"][0].as_py() == batch["j"][0].as_py()
            side = batch["side"].to_numpy()
            for s in (0, 1):
                some = batch.filter(pa.array(side == s))
                if not some.num_rows:
                    continue
                ids[s].append(some["id"])
                for parts, numbers in zip((high, low), unpack(some["v"])):
                    parts[s].append(numbers)
        cut = sum(map(len, ids[0]))
        ids, place = places(pa.chunked_array([*ids[0], *ids[1]], pa.string()))
        one, two = [(stacked(high[s]), stacked(low[s]), place[:cut] if s == 0 else place[cut:]) for s in (0, 1)]
        if diagonal:
            two = one
        # what the product of single numbers may lack
        least = above - 1e-6 - (one[0].shape[1] + 8) * 2.0**-24
        links, held = [], 0
        for i in range(0, len(one[0]), TILE):
            here = slice(i, i + TILE)
            for j in range(i if diagonal else 0, len(two[0]), TILE):
                there = slice(j, j + TILE)
                near = one[0][here] @ two[0][there].T > least
                found = np.count_nonzero(near)
                if not found:
                    continue
                x, y = np.nonzero(near)
                if found > MANY * near.size:
                    value = (whole(one[0][here], one[1][here]) @ whole(two[0][there], two[1][there]).T)[x, y]
                else:
                    value = np.einsum("ij,ij->i", whole(one[0][i + x], one[1][i + x]), whole(two[0][j + y], two[1][j + y]))
                rounded = np.round(value, 9)
                ok = rounded >= above if at_least else rounded > above
                a, b = one[2][i + x], two[2][j + y]
                if same:
                    # an id that comes twice is no pair, nor does a pair come in both orders
                    ok &= a != b
                    if diagonal:
                        ok &= i + x < j + y
                    a, b = np.minimum(a, b), np.maximum(a, b)
                a, b, value, rounded = a[ok], b[ok], value[ok], rounded[ok]
                if answer == "forest":
                    links.append((a, b))
                    held += len(a)
                    if held > LINKS:
                        links = [thinned(*map(np.concatenate, zip(*links)), len(ids), LINKS)]
                        held = len(links[0][0])
                    continue
                if answer == "best" and len(a):
                    order = np.lexsort((b, -rounded, a))
                    first = order[np.concatenate(([True], a[order][1:] != a[order][:-1]))]
                    a, b, value = a[first], b[first], value[first]
                if len(a):
                    yield answered(ids, a, b, value)
        if held:
            a, b = thinned(*map(np.concatenate, zip(*links)), len(ids), 0)
            yield answered(ids, a, b, np.full(len(a), np.nan))

    n = left.count()
    others = n if same else right.count()
    size = tile_rows(others)
    # by number, since a tile is little to read and much to compare: small ones must not be put together in one task,
    # and few should get two of them
    tiles = -(-n // size) * -(-others // size)
    tasks = max(1, min(TASKS, 4 * tiles if tiles > 1 else 1))
    place = ["block", "g", "i", "j", *(["own"] if same else [])]
    return tiled(placed(left, right, above, seed), size, same).repartition(tasks, *place).groupBy(*place).applyInArrow(compare, PAIR)


def packed(rows: DataFrame) -> DataFrame:
    """(id, v, g) with packed vectors, those without a direction left out."""
    if rows.schema["v"].dataType.typeName() == "binary":
        return rows.select("id", "v", "g").filter(F.col("v") != F.repeat(F.lit("\0"), F.length("v")).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(pack(matrix(batch["v"])), pa.binary()), batch["g"]], names=["id", "v", "g"])

    return rows.filter(F.exists("v", lambda x: x != 0)).select("id", "v", "g").mapInArrow(run, "id string, v binary, g string")


def joined(pairs: DataFrame) -> DataFrame:
    """Fewer links (a, b) that join the same: each task keeps a forest of those it has, and begins a new one when it knows ``NAMES`` ids."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[str, str] = {}

        def root(x: str) -> str:
            while top.setdefault(x, x) != x:
                top[x] = x = top[top[x]]
            return x

        for batch in batches:
            keep = []
            for k, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                one, two = root(a), root(b)
                if one != two:
                    top[max(one, two)] = min(one, two)
                    keep.append(k)
                if len(top) > NAMES:
                    top.clear()
            yield batch.take(pa.array(keep, pa.int64()))

    return pairs.select("a", "b").mapInArrow(thin, "a string, b string")
