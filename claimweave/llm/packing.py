"""Vector bin packing of token sequences by the dot-product heuristic.

Items have three sizes: tokens, one segment each, and loss-bearing tokens.  A bin
is open at a time; of the items that fit, the one whose size vector has the largest
dot product with the room left (each in shares of the limit) goes in, until none
fits.  Items are dealt at random into groups of about ``GROUP_BINS`` bins, each
packed in one task, so all groups have a bounded size whatever the input, and only
the last bins of a group are left unfilled.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import saved, slices, text_or_empty
from claimweave.llm.pretokens import Encoder, encoder

MAX_TOKENS, MAX_SEGMENTS, END_ID = 4096, 128, 2
GROUP_BINS, GROUP_ROWS = 128, 100_000
BLOCK_BYTES = 4 << 20
PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(
    df: DataFrame,
    path: str,
    size: int = MAX_TOKENS,
    end_id: int = END_ID,
    block_bytes: int = BLOCK_BYTES,
    remembered: int = Encoder.REMEMBERED,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids and an end id, cut every ``size`` ids.

    NULL text is empty: one piece that holds the end id.  Repeated rows give repeated
    pieces; no rows give none.  A worker's memory follows from the texts it encodes at
    once, ``block_bytes``, and the words it remembers; neither changes a result.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, remembered)
        for batch in slices(batches, "text", block_bytes):
            ids, starts = encode(batch.column(1).to_pylist())
            rows, columns = [], ([], [], [], [])
            for k in range(batch.num_rows):
                own = np.append(ids[starts[k] : starts[k + 1]], np.uint32(end_id)).astype("<u4")
                for a in range(0, len(own), size):
                    piece = own[a : a + size]
                    rows.append(k)
                    for column, value in zip(columns, (a, len(piece), zlib.crc32(piece.tobytes()), len(own)), strict=True):
                        column.append(value)
            out = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = df.select("doc_id", text_or_empty().alias("text"))
    return rows.mapInArrow(cut, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, {PIECES}")


def fill_bins(tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each item and its offset in tokens there.  Items of equal sizes are taken in the order given."""
    kinds, kind = np.unique(np.stack((tokens, loss), 1), axis=0, return_inverse=True)
    kind = kind.reshape(-1)
    waiting = [list(x[::-1]) for x in np.split(np.argsort(kind, kind="stable"), np.cumsum(np.bincount(kind, minlength=len(kinds)))[:-1])]
    sizes = np.stack((kinds[:, 0], np.ones(len(kinds), np.int64), kinds[:, 1]), 1)
    limit = np.array(limits, np.int64)
    if len(tokens) and (sizes > limit).any():
        raise ValueError(f"an item passes the limits {limits}")
    share = sizes / limit
    bins, offsets = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
    left, number, room = len(tokens), 0, limit.copy()
    there = np.ones(len(kinds), bool)
    while left:
        fits = there & (sizes <= room).all(1)
        if not fits.any():
            number, room = number + 1, limit.copy()
            continue
        best = int(np.argmax(np.where(fits, share @ (room / limit), -1.0)))
        item = waiting[best].pop()
        bins[item], offsets[item] = number, limit[0] - room[0]
        room -= sizes[best]
        left -= 1
        there[best] = bool(waiting[best])
    return bins, offsets


def pack(
    items: DataFrame,
    keys: list[str],
    tokens: str,
    loss: str,
    limits: tuple[int, int, int] = (MAX_TOKENS, MAX_SEGMENTS, MAX_TOKENS),
) -> DataFrame:
    """Add sequence_id and offset to every item (columns so called before are replaced).

    ``keys`` tell items apart and make reruns agree; items with equal keys and sizes are
    interchangeable.  ``loss`` may name a column that counts loss-bearing tokens, NULL
    counting as none.  An item beyond the limits is an error.  No items: none.
    """
    items = items.drop("sequence_id", "offset")
    totals = items.agg(F.sum(tokens).alias("t"), F.sum(loss).alias("l"), F.count(F.lit(1)).alias("n")).first()
    bins = max((totals["t"] or 0) / limits[0], totals["n"] / limits[1], (totals["l"] or 0) / limits[2])
    groups = max(1, math.ceil(bins / GROUP_BINS), math.ceil(totals["n"] / GROUP_ROWS))
    names = items.columns

    def place(group: pa.Table) -> pa.Table:
        order = [("_order", "ascending"), *((k, "ascending") for k in keys)]
        group = group.take(pa.compute.sort_indices(group, sort_keys=order))
        sizes = [group.column(c).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in (tokens, loss)]
        number, offset = fill_bins(*sizes, limits)
        which = group.column("_group").to_numpy()
        return group.select(names).append_column("sequence_id", pa.array((which << 32) + number)).append_column("offset", pa.array(offset))

    dealt = items.withColumn("_order", F.xxhash64(*keys)).withColumn("_group", F.pmod("_order", F.lit(groups)).cast("long"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return dealt.groupBy("_group").applyInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES, remembered: int = Encoder.REMEMBERED
) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens, 128 pieces and 4096 loss-bearing tokens.

    In plain documents every token bears loss but the first of a piece, which nothing precedes.
    """
    pieces = saved(cut_pieces(docs, path, block_bytes=block_bytes, remembered=remembered), "pieces").withColumn("loss_tokens", F.col("length") - 1)
    return pack(pieces, ["doc_id", "start", "ids_crc32"], "length", "loss_tokens")
