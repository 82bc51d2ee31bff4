"""Quality by nearest-neighbour voting in a latent semantic space.

Terms are pairs of neighbouring bytes, with a mark before and after each text; pairs of
their kinds (a small letter, a capital, a digit, a byte beyond ASCII, or the byte
itself); and how large a share of the words repeats the word before.  So spelling, case, symbols and
repetition all count in any language, and no text is without terms.  The space is learned from labelled rows: their terms, weighted by
logarithmic counts and rarity, are reduced to the leading right singular vectors of
their matrix.  Labelled vectors travel to every task.  A document's cosines with all
of them are one exact matrix product per block; its nearest neighbours vote with their
labels, weighted by a power of their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.llm.base import saved, slices, text_or_empty, utf8
from claimweave.llm.shingles import word_hashes

# bounds of what is fitted and broadcast: labelled rows, terms, dimensions
SAMPLE, TERMS, DIMENSIONS = 2048, 4096, 64
NEIGHBOURS, SHARPNESS, THRESHOLD = 15, 20, 0.3
BLOCK_BYTES, BLOCK_ROWS = 1 << 20, 512
PIECE = 1 << 18
PAIRS = 1 << 16
LEVELS, STEADY = 6, 24  # a share counts as if so many words more did not repeat
CODES = 2 * PAIRS + LEVELS  # pairs of bytes, pairs of kinds, levels of repetition
EDGE = 0  # the byte that stands before and after a text
_KIND = np.arange(256, dtype=np.int32)
_KIND[ord("a") : ord("z") + 1] = ord("a")
_KIND[ord("A") : ord("Z") + 1] = ord("A")
_KIND[ord("0") : ord("9") + 1] = ord("0")
_KIND[0x80:] = 0x80


def codes_of(framed: np.ndarray) -> np.ndarray:
    kinds = _KIND[framed]
    return np.concatenate((framed[:-1] << 8 | framed[1:], (kinds[:-1] << 8 | kinds[1:]) + PAIRS))


def counted_terms(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes that occur, how often) of each text; long texts are counted in pieces."""
    hashes, words = word_hashes(data, starts)
    same = np.concatenate((np.zeros(1, np.int64), np.cumsum(hashes[1:] == hashes[:-1]))) if len(hashes) else np.zeros(0, np.int64)
    last = np.cumsum(words)
    for a, b, end, n in zip(starts[:-1].tolist(), starts[1:].tolist(), last.tolist(), words.tolist(), strict=True):
        if b - a > PIECE:
            total = np.zeros(CODES, np.int64)
            for at in range(a, b - 1, PIECE):
                total += np.bincount(codes_of(data[at : min(at + PIECE + 1, b)].astype(np.int32)), minlength=CODES)
            for ends in ((EDGE, data[a]), (data[b - 1], EDGE)):
                total[codes_of(np.array(ends, np.int32))] += 1
            codes = np.flatnonzero(total)
            found = codes, total[codes]
        else:
            framed = np.full(b - a + 2, EDGE, np.int32)
            framed[1:-1] = data[a:b]
            found = np.unique(codes_of(framed), return_counts=True)
        repeated = int(same[end - 1] - same[end - n]) if n else 0
        # a level for each halving that the share of repeating words reaches
        levels = [2 * PAIRS + j for j in range(LEVELS) if repeated << j >= n + STEADY]
        yield np.concatenate((found[0], np.array(levels, found[0].dtype))), np.concatenate((found[1], np.ones(len(levels), found[1].dtype)))


@dataclass
class Voters:
    """What scoring needs: the term of each code (-1: none), weights, the projection, labelled unit vectors and labels."""

    term: np.ndarray
    weight: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    @property
    def kinds(self) -> list[slice]:
        codes = np.flatnonzero(self.term >= 0)
        edges = [0, *np.searchsorted(codes, (PAIRS, 2 * PAIRS)).tolist(), len(codes)]
        return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a]

    def embed(self, counted: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Unit vectors of texts in the latent space; zero for texts without a known term."""
        rows = np.zeros((len(counted), len(self.weight)))
        for k, (codes, n) in enumerate(counted):
            term = self.term[codes]
            known = term >= 0
            rows[k, term[known]] = 1 + np.log(n[known])
        rows *= self.weight
        for own in self.kinds:  # each kind of terms counts alike
            rows[:, own] = unit(rows[:, own])
        return unit(rows @ self.projection)

    def score(self, counted: list[tuple[np.ndarray, np.ndarray]], neighbours: int = NEIGHBOURS, sharpness: float = SHARPNESS) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors; the prior where nothing is similar."""
        found = self.embed(counted) @ self.vectors.T
        # one whole number per pair, so that neither blocks nor ties change who the neighbours are
        rank = np.rint(found * 1e9).astype(np.int64) * len(self.labels) - np.arange(len(self.labels))
        k = min(neighbours, len(self.labels))
        near = np.sort(np.argpartition(-rank, k - 1, axis=1)[:, :k], axis=1)
        power = np.maximum(np.rint(np.take_along_axis(found, near, 1) * 1e9) / 1e9, 0) ** sharpness
        total = power.sum(1)
        share = np.divide((power * self.labels[near]).sum(1), total, out=np.full(len(found), self.prior), where=total > 0)
        return np.round(np.clip(share, 0, 1), 9)


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(1, keepdims=True))
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 1e-12)


def build(counted: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, terms: int = TERMS, dimensions: int = DIMENSIONS) -> Voters:
    """Fit on counted labelled texts: the ``terms`` most widespread codes, and the leading singular vectors."""
    spread = np.zeros(CODES, np.int64)
    for codes, _ in counted:
        spread[codes] += 1
    chosen = np.lexsort((np.arange(CODES), -spread))[:terms]
    chosen = np.sort(chosen[spread[chosen] > 0])
    term = np.full(CODES, -1, np.int32)
    term[chosen] = np.arange(len(chosen))
    weight = np.log((1 + len(counted)) / (1 + spread[chosen])) + 1
    voters = Voters(term, weight, np.eye(len(chosen)), np.zeros((0, 0)), labels, float(labels.mean()))
    rows = voters.embed(counted)
    # right singular vectors by way of the smaller product
    values, left = np.linalg.eigh(rows @ rows.T)
    lead = np.argsort(-values, kind="stable")[:dimensions]
    lead = lead[values[lead] > 1e-9 * max(values.max(), 1e-300)]
    voters.projection = rows.T @ (left[:, lead] / np.sqrt(values[lead]))
    voters.vectors = voters.embed(counted)
    return voters


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of doc_id as text leaves no remainder; false for a NULL doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def counts_of(rows: DataFrame) -> DataFrame:
    """(key, label, codes, n) of (key, label, text) rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK_BYTES):
            found = list(counted_terms(*utf8(batch.column(2))))
            out = [pa.array([x[k].astype(kind).tobytes() for x in found], pa.binary()) for k, kind in ((0, "<u4"), (1, "<i8"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *out], names=["key", "label", "codes", "n"])

    return rows.mapInArrow(count, "key string, label double, codes binary, n binary")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Voters | None:
    """Learn from labelled documents that are not held out; None if there are none.

    At most ``sample`` of them take part, those with the least hash of doc_id: what the
    driver gets and what is broadcast is bounded by it, and by 131,073 codes a row.  A
    doc_id with several labels has their mean; NULL labels and NULL ids do not count.
    """
    marked = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("label"))
    ids = docs.select("doc_id").join(marked, "doc_id").distinct()
    key = F.md5(F.col("doc_id").cast("string").cast("binary"))
    chosen = saved(ids.select("doc_id", "label", key.alias("key")).orderBy("key", "doc_id").limit(sample), "quality-sample")
    # as many rows as the sample at most
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    # a doc_id that is repeated with several texts gives its least text
    rows = rows.groupBy("key", "label").agg(F.min("text").alias("text")).select("key", "label", "text")
    found = sorted(counts_of(rows).collect(), key=lambda r: r["key"])
    if not found:
        return None
    counted = [(np.frombuffer(r["codes"], "<u4").astype(np.int64), np.frombuffer(r["n"], "<i8")) for r in found]
    return build(counted, np.array([r["label"] for r in found]))


def score_texts(df: DataFrame, voters: Voters | None, text_col: str = "text") -> DataFrame:
    """``df`` with score (0 to 1), worked out from whole texts in blocks of rows; NULL text is empty.

    Without voters every score is 0.5.  ``df`` must not have a column named score or _text.
    """
    shared = df.sparkSession.sparkContext.broadcast(voters)
    kept = df.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for block in slices(batches, "_text", BLOCK_BYTES):
            for a in range(0, block.num_rows, BLOCK_ROWS):
                batch = block.slice(a, BLOCK_ROWS)
                out = np.full(batch.num_rows, 0.5) if own is None else own.score(list(counted_terms(*utf8(batch.column(len(kept))))))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(out)], names=[*kept, "score"])

    rows = df.select("*", text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(score, T.StructType([*df.schema.fields, T.StructField("score", T.DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    score is the weight of label 1 among the nearest labelled texts.  Empty and NULL
    texts are scored by their edge marks alone.  Repeated rows get equal scores; a NULL
    doc_id is not held out and never learned from; without labels every score is 0.5;
    no rows: no rows.  Labels, lang, source and doc_id are no inputs of a score.
    """
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = score_texts(rows, fit(docs, labels)).select("doc_id", "held_out", "score")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
