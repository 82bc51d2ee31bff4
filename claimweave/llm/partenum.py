"""N-gram Jaccard join by PartEnum signatures.

Sizes are cut into bands so that sets of Jaccard similarity J or more lie in one
band or in neighbouring ones; a set takes part in its own band and, where a partner
may be larger, in the next.  In a band whose largest size is r, such sets differ in
at most k = 2r(1-J)/(1+J) elements.  The domain is dealt by hash into n parts, each of
three cells.  With n > k/2 some part differs in one element at most, so two of its
three cells are equal: for each part, each way to leave out one cell gives a
signature, the sum of what is in the other two.  Similar sets share a signature.

An empty signature would bring together sets that have nothing in common, so none is
sent.  With n parts to spare, similar sets still share another, unless one difference
each in the parts where two cells are empty, and two each in others, can spoil all
parts; a set can tell that of itself.  Both sets of a pair that shares no signature are
of that kind (few are), and such sets deal the domain once more, by another hash.

Signatures are packed per task and bucket before the shuffle; a bucket holds a share
of one band.  Of the sets that share one, each is paired with the smallest id, and with
the hub, the set whose signatures bring it together with most others (of copies that
were edited each in its own way, that is the one they come from).  Pairs that differ
too much in size or in a sketch of parities (both exact bounds) go.  Then pairs are
verified on whole texts, in three rounds: each document with its hub; pairs whose ends
are not yet in one group; and, where a smallest id failed, those under it that are still
in different groups.  These are first held against each other by sketch alone, in tiles
of thousands; texts go only where a sketch leaves a partner in another group possible.
So every link between two signature mates is either tested or its ends are in one group
already, and groups are those of all links, though a cloud of n near copies is never
turned into n*n pairs, and its texts are not sent to each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import saved, slices, text_or_empty, utf8
from claimweave.llm.shingles import U, linked, mix, shingle_sets
from claimweave.operators.groups import components

PERCENT = 80
CELLS = 3
LEAST_BITS = 128
DEALS = 8
BLOCK_BYTES = 1 << 20
# signatures and documents that a task packs at once; signatures that a bucket should hold
FLUSH_SIGNATURES, FLUSH_DOCS, BUCKET_SIGNATURES = 1 << 19, 30_000, 1 << 21
UNIT, SLOTS = 256, 1 << 20
# rows and shingles of a tile, and words that a comparison inside it holds at once
TILE_ROWS, TILE_SHINGLES, TILE_WORDS = 8192, 1 << 20, 1 << 21


class Bands:
    """Size bands for a similarity of ``percent`` in 100, and how each is partitioned."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]

    def of(self, size: int) -> int:
        while self.low[-1] * 100 // self.percent < size:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.low, size, side="right")) - 1

    def high(self, band: int) -> int:
        return self.of_low(band) * 100 // self.percent

    def of_low(self, band: int) -> int:
        while len(self.low) <= band:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return self.low[band]

    def bands(self, size: int) -> list[int]:
        """The band of a size, and the next if a partner may lie there."""
        own = self.of(size)
        return [own, own + 1] if size * 100 // self.percent > self.high(own) else [own]

    def parts(self, band: int) -> tuple[int, int]:
        """(k, parts): the largest difference of two sets that meet in a band, and the number of parts."""
        k = 2 * self.high(band) * (100 - self.percent) // (100 + self.percent)
        least = k // 2 + 1
        return k, least + (least + 15) // 16 if least > 2 else least


def signatures(hashes: np.ndarray, bands: Bands) -> np.ndarray:
    """Signatures of one non-empty set, given as sorted hashes."""
    return np.concatenate([s for _, s in by_band(hashes, bands)])


def by_band(hashes: np.ndarray, bands: Bands) -> list[tuple[int, np.ndarray]]:
    out = []
    for band in bands.bands(len(hashes)):
        k, parts = bands.parts(band)
        if k == 0:
            out.append((band, mix(mix(hashes).sum(keepdims=True, dtype=U) + U((band + 1) << 40))))
            continue
        for deal in range(DEALS):
            found, empty, void = dealt(hashes, band, parts, deal)
            one = min(int((empty.any(1) & ~void).sum()), k)
            spoilt = int(void.sum()) + one + (k - one) // 2
            last = deal == DEALS - 1 and spoilt >= parts
            out.append((band, found.reshape(-1) if last else found[~empty]))
            if spoilt < parts:
                break
    return out


def dealt(hashes: np.ndarray, band: int, parts: int, deal: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of one deal (parts, cells left out), which of them are empty, and which parts are."""
    if deal:
        hashes = np.sort(mix(hashes + U(deal)))
    cells = parts * CELLS
    sums = np.concatenate((np.zeros(1, U), np.cumsum(mix(hashes ^ U(0xD1B54A32D192ED03)))))
    edges = np.searchsorted(((hashes >> U(32)) * U(cells)) >> U(32), np.arange(cells + 1, dtype=U))
    inside = (sums[edges[1:]] - sums[edges[:-1]]).reshape(parts, CELLS)
    counts = np.diff(edges).reshape(parts, CELLS)
    left = inside.sum(1, dtype=U)[:, None] - inside
    names = mix(np.arange(cells, dtype=U) + U((band + 1) << 40 | deal << 32)).reshape(parts, CELLS)
    return mix(left + names), counts.sum(1)[:, None] == counts, counts.sum(1) == 0


def measures(hashes: np.ndarray) -> tuple[int, bytes, bytes]:
    """Size, a 128-bit fingerprint of the set, and a sketch: whether each share of the domain holds an odd number.

    There are two to four shares for each element, a power of two.  Two sets differ in
    at least as many elements as their sketches do in bits.
    """
    bits = max(LEAST_BITS, 1 << (2 * len(hashes)).bit_length())
    odd = np.bincount((hashes & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    two = [mix(hashes ^ U(seed)).sum(dtype=U) for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return len(hashes), b"".join(int(x).to_bytes(8, "little") for x in two), np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, n, print, sketch) of each row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK_BYTES):
            rows = [measures(s) for s in shingle_sets(*utf8(batch.column(1)))]
            n, prints, sketches = (list(c) for c in zip(*rows, strict=True))
            out = [batch.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n", "print", "sketch"])

    return docs.mapInArrow(measure, "doc_id long, n long, print binary, sketch binary")


def shares(sizes: list[tuple[int, int]], percent: int) -> dict[int, tuple[int, int]]:
    """Band -> (first bucket, buckets), from (size, sets of that size): as many as the band's signatures take."""
    bands, load = Bands(percent), {}
    for n, many in sizes:
        for band in bands.bands(n):
            load[band] = load.get(band, 0) + many * CELLS * bands.parts(band)[1]
    out, first = {}, 0
    for band in sorted(load):
        out[band] = (first, -(-load[band] // BUCKET_SIGNATURES))
        first += out[band][1]
    return out


def sharing_pairs(docs: DataFrame, percent: int, places: dict[int, tuple[int, int]]) -> DataFrame:
    """(a, b, hub, times), a < b: both share a signature, and a is the smallest id that has it or hub (a or b) its hub.

    ``places`` says which buckets a band has.  hub is NULL for pairs with the smallest
    id; times counts the buckets that found the pair.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
        held, known = 0, set()
        for batch in slices(batches, "text", BLOCK_BYTES):
            sets = shingle_sets(*utf8(batch.column(1)))
            for doc, own in sorted(zip(batch.column(0).to_pylist(), sets, strict=True), key=lambda x: x[0]):
                # copies have equal signatures: of those packed together, the smallest id of a block speaks
                same = measures(own)[:2]
                if not len(own) or same in known:
                    continue
                known.add(same)
                for band, found in by_band(own, bands):
                    first, cuts = places[band]
                    waiting.append((doc, found, ((found >> U(32)) * U(cuts) >> U(32)).astype(np.int64) + first))
                    held += len(found)
            known = set()
            if held > FLUSH_SIGNATURES or len(waiting) > FLUSH_DOCS:
                yield packed(waiting)
                waiting, held = [], 0
        if waiting:
            yield packed(waiting)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs_of, found = [], []
        bucket = None
        for batch in batches:
            for b, d, c, s in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if b != bucket and bucket is not None:
                    yield stars(docs_of, found)
                    docs_of, found = [], []
                bucket = b
                docs_of.append(np.repeat(np.frombuffer(d, np.int64), np.frombuffer(c, np.uint32)))
                found.append(np.pad(np.frombuffer(s, np.uint8).reshape(-1, 6), ((0, 0), (0, 2))).view(U).reshape(-1))
        if bucket is not None:
            yield stars(docs_of, found)

    blocks = docs.filter("doc_id IS NOT NULL").mapInArrow(pack, "bucket int, docs binary, counts binary, found binary")
    buckets = max(1, sum(n for _, n in places.values()))
    met = blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    found = met.mapInArrow(meet, "a long, b long, hub long")
    return found.groupBy("a", "b", "hub").agg(F.count(F.lit(1)).alias("times"))


def packed(waiting: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """One row per bucket: ids, how many signatures each has there, and the signatures' low 48 bits, by id.

    The bucket follows from the band and the high bits, so it adds to the 48.
    """
    counts = np.array([len(s) for _, s, _ in waiting])
    found, bucket = (np.concatenate([w[k] for w in waiting]) for k in (1, 2))
    doc = np.repeat(np.arange(len(waiting)), counts)
    order = np.argsort(bucket, kind="stable")  # ids stay together within a bucket
    found, doc, bucket = found[order], doc[order], bucket[order]
    low = found.view(np.uint8).reshape(-1, 8)[:, :6]
    ids = np.array([w[0] for w in waiting], np.int64)
    edges = np.append(np.flatnonzero(np.concatenate(([True], np.diff(bucket) != 0))), len(bucket))
    rows: tuple = ([], [], [], [])
    for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
        own = slice(a, b)
        first = np.flatnonzero(np.concatenate(([True], np.diff(doc[own]) != 0)))
        rows[0].append(int(bucket[a]))
        rows[1].append(ids[doc[own][first]].tobytes())
        rows[2].append(np.diff(np.append(first, b - a)).astype(np.uint32).tobytes())
        rows[3].append(low[own].tobytes())
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names=["bucket", "docs", "counts", "found"])


def stars(docs_of: list[np.ndarray], found: list[np.ndarray]) -> pa.RecordBatch:
    """For each signature of a bucket, its smallest id and its hub with each other id.

    The hub is the id that shares its signatures in this bucket with most others.
    """
    doc, key = np.concatenate(docs_of), np.concatenate(found)
    order = np.argsort(key, kind="stable")
    doc, key = doc[order], key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(first, len(doc)))
    many = np.repeat(sizes > 1, sizes)  # all other signatures bring nobody together
    doc, sizes = doc[many], sizes[sizes > 1]
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    if not len(doc):
        none = pa.array([], pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none], names=["a", "b", "hub"])
    ids, which = np.unique(doc, return_inverse=True)
    place = np.empty(len(ids), np.int64)
    # ids in the order of what they share, of equals the smaller one last
    rank = np.lexsort((-np.arange(len(ids)), np.bincount(which, weights=np.repeat(sizes, sizes))))
    place[rank] = np.arange(len(ids))
    least = np.repeat(np.minimum.reduceat(which, first), sizes)
    hub = np.repeat(rank[np.maximum.reduceat(place[which], first)], sizes)
    out = []
    for centre, named in ((least, False), (hub, True)):
        other = centre != which
        pairs = np.unique(centre[other] * len(ids) + which[other])
        a, b = ids[pairs // len(ids)], ids[pairs % len(ids)]
        out.append((np.minimum(a, b), np.maximum(a, b), pa.array(a, pa.int64(), mask=np.full(len(a), not named))))
    columns = [pa.array(np.concatenate([o[k] for o in out])) for k in (0, 1)]
    return pa.RecordBatch.from_arrays([*columns, pa.concat_arrays([o[2] for o in out])], names=["a", "b", "hub"])


def folded(sketch: np.ndarray) -> np.ndarray:
    """The sketch (along the last axis) of half as many shares."""
    half = sketch.shape[-1] // 2
    return sketch[..., :half] ^ sketch[..., half:]


def difference(one: bytes, two: bytes) -> int:
    """The least number of elements in which two sets with these sketches differ."""
    a, b = np.frombuffer(one, U), np.frombuffer(two, U)
    while len(a) != len(b):
        a, b = (folded(a), b) if len(a) > len(b) else (a, folded(b))
    return int(np.bitwise_count(a ^ b).sum())


def rivals(n: np.ndarray, group: np.ndarray, side: np.ndarray, sketches: list[bytes], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs in different groups that sizes and sketches do not rule out, block by block.

    Of two sides, pairs are across.  Sets that may be similar have sketches of one
    length, or of which one is twice as long.
    """
    across = bool((side != side[0]).any())
    lengths = np.array([len(s) for s in sketches])
    stacks = {m: (np.flatnonzero(lengths == m), np.frombuffer(b"".join(s for s in sketches if len(s) == m), U).reshape(-1, m // 8)) for m in np.unique(lengths).tolist()}
    for m, (place, rows) in stacks.items():
        for other in (m, 2 * m):
            if other not in stacks:
                continue
            there, those = stacks[other]
            those = those if other == m else folded(those)
            step = max(1, TILE_WORDS // max(1, those.size))
            for a in range(0, len(place), step):
                first = a if other == m else 0
                own, at, to = rows[a : a + step], place[a : a + step], there[first:]
                apart = np.bitwise_count(own[:, None, :] ^ those[None, first:, :]).sum(-1, dtype=np.int64)
                na, nb = n[at][:, None], n[to][None, :]
                good = (apart * (100 + percent) <= (na + nb) * (100 - percent)) & (np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent)
                good &= group[at][:, None] != group[to][None, :]
                if across:
                    good &= side[at][:, None] != side[to][None, :]
                if other == m:
                    good &= np.arange(len(at))[:, None] < np.arange(len(to))[None, :]
                i, j = np.nonzero(good)
                if len(i):
                    yield at[i], to[j]


def near_enough(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb, sa, sb) that sizes and sketches do not rule out, as (a, b)."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = (batch.column(2).to_numpy() + batch.column(3).to_numpy()).tolist()
            least = map(difference, batch.column(4).to_pylist(), batch.column(5).to_pylist())
            good = [d * (100 + percent) <= both * (100 - percent) for d, both in zip(least, n, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good))

    least, most = F.least("na", "nb"), F.greatest("na", "nb")
    return pairs.filter(least * 100 >= most * percent).select("a", "b", "na", "nb", "sa", "sb").mapInArrow(test, "a long, b long")


def with_texts(need: DataFrame, docs: DataFrame) -> DataFrame:
    """``need`` with the text of each doc_id.

    Texts that nothing needs are sorted out before the shuffle, by a table of hashed
    ids with 2**20 rows at most.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")
    slots = need.select(slot.alias("_slot")).distinct()
    texts = docs.withColumn("_slot", slot).join(F.broadcast(slots), "_slot", "left_semi").select("doc_id", "text")
    return texts.join(need, "doc_id")


def verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, tested on whole texts.

    A unit is an id a with at most some hundreds of its partners; each text goes to the
    units that need it, a's first.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / UNIT).alias("units"))
    dealt = pairs.join(many, "a").withColumn("unit", F.pmod(F.xxhash64("b"), F.col("units")))
    need = dealt.select("a", "unit", F.col("b").alias("doc_id")).unionByName(dealt.select("a", "unit", F.col("a").alias("doc_id")).distinct())

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, pivot = None, None
        for batch in slices(batches, "text", BLOCK_BYTES):
            sets = shingle_sets(*utf8(batch.column(3)))
            out: tuple[list, list] = ([], [])
            for a, u, doc, own in zip(*(batch.column(c).to_pylist() for c in range(3)), sets, strict=True):
                if doc == a:
                    unit, pivot = (a, u), own
                elif unit == (a, u) and linked(pivot, own, percent):
                    out[0].append(a)
                    out[1].append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b"])

    ordered = with_texts(saved(need, "jaccard-need"), docs).select("a", "unit", "doc_id", "text").repartition("a", "unit")
    return ordered.sortWithinPartitions("a", "unit", F.col("doc_id") != F.col("a")).mapInArrow(test, "a long, b long").distinct()


def tiled(mates: DataFrame) -> DataFrame:
    """``mates`` (a, doc_id, g, n and more) with the tiles they go to: (a, tile, side, ...), side 0 or 1.

    The mates of one smallest id are dealt into slices of half of ``TILE_ROWS`` or
    ``TILE_SHINGLES``; every two slices meet in one tile, and each with itself.
    """
    least = F.greatest(F.count(F.lit(1)) * 2 / TILE_ROWS, F.sum("n") * 2 / TILE_SHINGLES)
    cuts = mates.groupBy("a").agg(F.ceil(least).alias("cuts"))
    own = F.pmod(F.xxhash64("doc_id"), F.col("cuts"))
    meets = F.transform(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1), lambda k: F.struct((F.least(own, k) * F.col("cuts") + F.greatest(own, k)).alias("tile"), (own > k).cast("int").alias("side")))
    placed = mates.join(cuts, "a").withColumn("_tile", F.explode(meets))
    return placed.select("a", "_tile.tile", "_tile.side", *[c for c in mates.columns if c != "a"])


def by_tile(batches: Iterator[pa.RecordBatch], read) -> Iterator[tuple[int, list[tuple]]]:
    """(a, rows) of each tile; ``read`` turns a batch of a, tile and more into rows that start with these two."""
    tile, held = None, []
    for batch in batches:
        for row in read(batch):
            if row[:2] != tile:
                if held:
                    yield tile[0], held
                tile, held = row[:2], []
            held.append(row[2:])
    if held:
        yield tile[0], held


def suspects(mates: DataFrame, percent: int) -> DataFrame:
    """The (a, doc_id) that some mate of the same a, in another group, may be linked with, by size and sketch."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = by_tile(batches, lambda batch: zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for a, held in rows:
            side, doc, g, n, sketches = (list(c) for c in zip(*held, strict=True))
            found = np.zeros(len(doc), bool)
            for i, j in rivals(np.array(n), np.array(g), np.array(side), sketches, percent):
                found[i] = found[j] = True
            own = np.array(doc, np.int64)[found]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), a, np.int64)), pa.array(own)], names=["a", "doc_id"])

    tiles = tiled(mates).select("a", "tile", "side", "doc_id", "g", "n", "sketch").repartition("a", "tile")
    return tiles.sortWithinPartitions("a", "tile").mapInArrow(test, "a long, doc_id long").distinct()


def crossed(mates: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join the groups of ``mates`` (a, doc_id, g, n): within a tile no more than it takes.

    A tile holds the sets of some thousands of documents or a million shingles; sketches
    say which of them to compare, and what is joined already is not compared again.
    """

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read(batch: pa.RecordBatch) -> Iterator[tuple]:
            return zip(*(batch.column(c).to_pylist() for c in range(5)), shingle_sets(*utf8(batch.column(5))), strict=True)

        for _, held in by_tile(slices(batches, "text", BLOCK_BYTES), read):
            side, doc, g, sets = (list(c) for c in zip(*held, strict=True))
            top = {x: x for x in g}

            def root(x: int, top: dict = top) -> int:
                while top[x] != x:
                    top[x] = x = top[top[x]]
                return x

            out: tuple[list, list] = ([], [])
            n = np.array([len(x) for x in sets])
            for found in rivals(n, np.array(g), np.array(side), [measures(x)[2] for x in sets], percent):
                for i, j in zip(*(x.tolist() for x in found), strict=True):
                    one, two = root(g[i]), root(g[j])
                    if one != two and linked(sets[i], sets[j], percent):
                        top[one] = two
                        out[0].append(min(doc[i], doc[j]))
                        out[1].append(max(doc[i], doc[j]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b"])

    need = saved(tiled(mates).select("a", "tile", "side", "doc_id", "g"), "jaccard-tiles")
    rows = with_texts(need, docs).select("a", "tile", "side", "doc_id", "g", "text")
    return rows.repartition("a", "tile").sortWithinPartitions("a", "tile").mapInArrow(test, "a long, b long").distinct()


def jaccard_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Documents are linked when 100 times the intersection of their sets of 5-word
    shingles reaches ``percent`` times the union; component_id is the smallest doc_id
    reachable by links.  NULL and wordless texts have an empty set and are linked with
    nothing.  Rows that repeat a doc_id count as one document.  A NULL doc_id is linked
    with nothing and has a NULL component_id.  No rows: no rows.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    sets = saved(measured(rows), "jaccard-sets")
    whole = sets.filter("doc_id IS NOT NULL AND n > 0")
    copies = whole.groupBy("n", "print").agg(F.min("doc_id").alias("rep"))
    # one row per document: its smallest copy speaks for it
    known = saved(whole.select("doc_id", "n", "print", "sketch").join(copies, ["n", "print"]).select("doc_id", "rep", "n", "sketch").distinct(), "jaccard-known")
    name = known.select("doc_id", "rep")
    # one row per size that occurs
    sizes = [(r["n"], r["count"]) for r in whole.groupBy("n").count().collect()]
    found = sharing_pairs(rows, percent, shares(sizes, percent))
    raw = found.join(name.toDF("a", "ra"), "a").join(name.toDF("b", "rb"), "b").filter("ra <> rb")
    hub = F.when(F.col("hub") == F.col("a"), F.col("ra")).when(F.col("hub") == F.col("b"), F.col("rb"))
    raw = raw.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"), hub.alias("hub"), "times")
    raw = saved(raw.groupBy("a", "b", "hub").agg(F.sum("times").alias("times")), "jaccard-raw")
    hubs = raw.filter("hub IS NOT NULL")
    own = F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    best = hubs.groupBy(own.alias("x")).agg(F.max(F.struct("times", (-F.col("hub")).alias("h")))["h"].alias("h"))
    best = best.select(F.least("x", -F.col("h")).alias("a"), F.greatest("x", -F.col("h")).alias("b")).distinct()
    everything = raw.select("a", "b").distinct()
    raw = raw.filter("hub IS NULL").select("a", "b")
    spoken = known.filter("doc_id = rep")

    def sized(pairs: DataFrame) -> DataFrame:
        one = spoken.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        two = spoken.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        return near_enough(pairs.join(one, "a").join(two, "b"), percent)

    def named(pairs: DataFrame, groups: DataFrame) -> DataFrame:
        """Pairs whose ends are in different groups, with the groups (ga, gb)."""
        a, b = groups.toDF("a", "ga"), groups.toDF("b", "gb")
        both = pairs.join(a, "a", "left").join(b, "b", "left")
        both = both.withColumn("ga", F.coalesce("ga", "a")).withColumn("gb", F.coalesce("gb", "b"))
        return both.filter("ga <> gb")

    near = saved(sized(everything), "jaccard-near")
    links = saved(verified(near.join(best, ["a", "b"], "left_semi"), rows, percent), "jaccard-links")
    groups = saved(components(links), "jaccard-groups")
    rest = saved(named(near, groups).select("a", "b"), "jaccard-rest")
    if not rest.isEmpty():
        links = saved(links.unionByName(verified(rest, rows, percent)), "jaccard-links")
        groups = saved(components(links), "jaccard-groups")
    failed = named(raw, groups).select("a").distinct()
    mates = raw.join(failed, "a", "left_semi").select("a", F.col("b").alias("doc_id")).join(groups.toDF("doc_id", "g"), "doc_id", "left")
    mates = mates.withColumn("g", F.coalesce("g", "doc_id")).join(spoken.select("doc_id", "n", "sketch"), "doc_id")
    mates = saved(mates.select("a", "doc_id", "g", "n", "sketch"), "jaccard-mates")
    if not mates.isEmpty():
        doubtful = saved(mates.drop("sketch").join(suspects(mates, percent), ["a", "doc_id"]), "jaccard-doubt")
        more = saved(crossed(doubtful, rows, percent), "jaccard-links")
        if not more.isEmpty():
            groups = components(links.unionByName(more))
    reps = name.join(groups.toDF("rep", "group_id"), "rep", "left")
    final = reps.select("doc_id", F.coalesce("group_id", "rep").alias("component_id")).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = sets.select("doc_id", F.col("n").alias("n_shingles")).join(final, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def without_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id; rows without doc_id stay.  Columns are kept.

    Rows of one doc_id are one document: of those with equal texts the least row stays,
    different texts all stay.  No rows: no rows.
    """
    keep = jaccard_groups(docs, percent).filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    kept = docs.filter("doc_id IS NOT NULL").select("doc_id", F.struct(*docs.columns).alias("_doc")).join(keep, "doc_id")
    single = kept.filter("_rows = 1").select("_doc.*")
    several = kept.filter("_rows > 1").groupBy("doc_id", F.md5(text_or_empty(F.col("_doc.text")).cast("binary")).alias("_text")).agg(F.min("_doc").alias("_doc"))
    return single.unionByName(several.select("_doc.*")).unionByName(docs.filter("doc_id IS NULL"))
