"""Shards by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

The ring has a fixed number of cells.  A row falls into the cell of its key's
hash; a cell belongs to the first virtual node at or after it, clockwise.  Every
shard has a capacity, and the capacities add up to the number of rows, so counts
differ by one at most (law ``rows``).  Rows that find their shard full go on
clockwise to the next virtual node whose shard has room; rows at home are never
displaced by such guests, so that only overflowing rows move.

Only the number of rows per cell is needed to say which ranks of a cell go to
which shard.  That table has at most ``cells`` rows whatever the input, so it is
planned on the driver and broadcast; rows are ranked within their cell and look
up their rank.  Texts are never shuffled.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave.llm.base import text_or_empty

SHARDS, VIRTUAL_NODES, CELLS = 40, 64, 16384
PLAN = "_cell int, _first long, _end long, shard int, _slot long"


def nodes(shards: int, virtual: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of each virtual node in ring order."""
    places = sorted((zlib.crc32(f"shard {s} node {v}".encode()), s) for s in range(shards) for v in range(virtual))
    return [(h * cells >> 32, s) for h, s in places]


def plan(loads: dict[int, int], shards: int, virtual: int, cells: int) -> list[tuple[int, int, int, int, int]]:
    """Which ranks of a cell go to which shard: (cell, first rank, end rank, shard, slot of the first)."""
    ring = nodes(shards, virtual, cells)
    total = sum(loads.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    parts, over = [], []

    def place(cell: int, first: int, rows: int, shard: int) -> int:
        n = min(rows, room[shard])
        if n:
            parts.append((cell, first, first + n, shard, filled[shard]))
            filled[shard] += n
            room[shard] -= n
        return n

    at = 0
    for cell in range(cells):
        while at < len(ring) and ring[at][0] < cell:
            at += 1
        rows = loads.get(cell, 0)
        home = at % len(ring)
        n = place(cell, 0, rows, ring[home][1])
        if n < rows:
            over.append((cell, n, rows - n, home))
    for cell, first, rows, home in over:
        step = home
        while rows:
            step = (step + 1) % len(ring)
            n = place(cell, first, rows, ring[step][1])
            first, rows = first + n, rows - n
    return parts


def ring_shards(
    df: DataFrame, key: Column, order: list[str], shards: int = SHARDS, virtual: int = VIRTUAL_NODES, cells: int = CELLS
) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard) to every row.

    ``key`` decides the place on the ring; ``order`` breaks ties of its hash, so that
    reruns agree.  Rows that agree in key and order are interchangeable.  A NULL key
    is a key like any other.  No rows: no rows.  Columns of ``df`` that are called
    shard or slot already are replaced.
    """
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    hashed = F.xxhash64(key)
    cell = F.pmod(hashed, F.lit(cells)).cast("int")
    counted = df.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("n")).collect()
    parts = df.sparkSession.createDataFrame(plan({r["_cell"]: r["n"] for r in counted}, shards, virtual, cells), PLAN)
    rows = df.select(F.struct(*kept).alias("_row"), cell.alias("_cell"), hashed.alias("_hash"))
    near = W.partitionBy("_cell").orderBy("_hash", *[F.col("_row")[c] for c in order])
    ranked = rows.withColumn("_rank", F.row_number().over(near) - 1)
    # at most two parts a cell and one more a shard: 16384 cells make under 2 MB
    return (
        ranked.join(F.broadcast(parts), "_cell")
        .filter((F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")))
        .select("_row.*", "shard", (F.col("_slot") + F.col("_rank") - F.col("_first")).alias("slot"))
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs``.

    The place on the ring follows doc_id (the text, where doc_id is NULL).  The size
    is the bytes of the text (NULL: none) and 16 more.  Documents of equal text are
    rows like others and may lie in different shards.
    """
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.when(F.col("doc_id").isNull(), F.xxhash64(text)).alias("_text"),
    )
    placed = ring_shards(rows, F.struct("doc_id", "_text"), ["doc_id", "text_crc32", "size"], shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
