"""Language identification by prediction by partial matching.

For each language, byte counts in contexts of 0 to ``ORDER`` bytes make a context
tree.  A byte is coded in the longest context the tree knows; a byte not seen there
costs an escape (its chance: kinds of bytes seen, over those and all bytes seen) and
is coded in the next shorter context, leaving out what the longer one had; below the
empty context all bytes left are equally likely.  Statistics are frozen after the
fit, so the cost of a byte depends on its context alone and is worked out once per
language for each byte in each context that the language met, in units of 2**-16 bits.  The language whose code of the
whole text is shortest wins.

Scoring walks the contexts of all positions of a block at once in numpy; the sums
are whole numbers, so blocks and partitions do not change them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.llm.base import saved, slices, text_or_empty

ORDER = 4
# the fit reads about so many documents a language, chosen by hash, and keeps each context of three bytes and more that occurs so often
SAMPLE_DOCS, LEAST_COUNT = 300, 4
# so many languages are fitted, broadcast and scored at once; there may be any number of such blocks
AT_ONCE = 16
UNIT = 1 << 16
BLOCK_BYTES, CHUNK, ROWS = 1 << 20, 1 << 18, 1 << 12
GAP = 0xFF  # never part of UTF-8: no context reaches across it


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


@dataclass
class Model:
    """``child[k][n * width + s]``: place among contexts of k + 1 bytes of context n of order k preceded by s, or -1;
    ``first[k]``: number of the first context of order k; ``own[l][context]``: the longest part of the context that
    language l met, times width, in the numbers of l; ``cost[l][own + s]``: for the contexts that l met alone."""

    languages: list[str]
    symbol: np.ndarray
    width: int
    child: list[np.ndarray]
    first: list[int]
    own: list[np.ndarray]
    cost: list[np.ndarray]

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text under each language, in units."""
        gap = bytes([GAP]) * ORDER
        joined = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        begins = ORDER + np.concatenate(([0], np.cumsum(sizes + ORDER)))[:-1]
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        for a in range(ORDER, len(joined), CHUNK):
            b = min(a + CHUNK, len(joined))
            state, now = self._states(self.symbol[joined[a - ORDER : b]])
            first = max(0, int(np.searchsorted(begins, a, side="right")) - 1)
            last = int(np.searchsorted(begins, b, side="left"))
            texts_here = np.arange(first, max(last, first))
            lo, hi = np.clip(begins[texts_here] - a, 0, b - a), np.clip(begins[texts_here] + sizes[texts_here] - a, 0, b - a)
            some = hi > lo
            if some.any():
                for lang, (own, cost) in enumerate(zip(self.own, self.cost, strict=True)):
                    # gaps cost nothing, so a text may be summed up to where the next one starts
                    out[texts_here[some], lang] += np.add.reduceat(cost[own[state] + now], lo[some], dtype=np.int64)
        return out

    def _states(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest known context at positions ORDER and on, and the symbol there."""
        now = symbols[ORDER:]
        state = np.zeros(len(now), np.int64)
        for k, child in enumerate(self.child):
            alive = state >= self.first[k]
            before = symbols[ORDER - 1 - k : len(symbols) - 1 - k]
            longer = child[np.where(alive, state - self.first[k], 0) * self.width + before]
            state = np.where(alive & (longer >= 0), longer + self.first[k + 1], state)
        return state, now


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, size, gram, n): how often each byte string of 1 to ORDER + 1 bytes occurs in the texts of a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK_BYTES):
            langs = batch.column(0).to_pylist()
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            for lang in sorted(set(langs)):
                data = np.frombuffer(bytes([GAP]).join(t for t, x in zip(texts, langs, strict=True) if x == lang), np.uint8)
                for size in range(1, ORDER + 2):
                    if len(data) < size:
                        continue
                    gram = np.zeros(len(data) - size + 1, np.int64)
                    whole = np.ones(len(gram), bool)
                    for j in range(size):
                        part = data[j : j + len(gram)]
                        gram = gram * 256 + part
                        whole &= part != GAP
                    values, counts = np.unique(gram[whole], return_counts=True)
                    names = pa.array([lang] * len(values), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [names, pa.array(np.full(len(values), size, np.int32)), pa.array(values), pa.array(counts.astype(np.int64))],
                        names=["lang", "size", "gram", "n"],
                    )

    grams = rows.mapInArrow(count, "lang string, size int, gram long, n long")
    return grams.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


def sample(labelled: DataFrame, per_language: int = SAMPLE_DOCS) -> tuple[list[str], DataFrame | None]:
    """The languages, and about ``per_language`` whole documents of each, chosen by a hash of doc_id."""
    found = labelled.groupBy("lang").count().collect()
    if not found:
        return [], None
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.element_at(F.create_map(*[F.lit(x) for r in found for x in (r["lang"], per_language / r["count"])]), F.col("lang"))
    return sorted(r["lang"] for r in found), labelled.filter(place < share).filter("text IS NOT NULL").select("lang", "text")


def fit(docs: DataFrame, per_language: int = SAMPLE_DOCS, least_count: int | None = None) -> list[Model]:
    """Learn from text and non-NULL lang of the documents that are not held out: models of ``AT_ONCE`` languages; none if there are none.

    Counting is a Spark job; the counts brought to the driver are those of a bounded sample, and of one model at a time.
    """
    labelled = docs.select("doc_id", "lang", "text").filter("lang IS NOT NULL").filter(remainder(F.col("doc_id")) != 1)
    languages, rows = sample(labelled, per_language)
    if rows is None:
        return []
    counts = saved(frequent(gram_counts(rows.repartition(min(len(languages), AT_ONCE) * 4)), least_count), "langid-counts")
    models, some = [], False
    for a in range(0, len(languages), AT_ONCE):
        block = languages[a : a + AT_ONCE]
        own = counts.filter(F.col("lang").isin(block)).toArrow()
        which = pc.index_in(own.column("lang"), pa.array(block, pa.string())).to_numpy()
        models.append(build(block, which, *(own.column(c).to_numpy().astype(np.int64) for c in ("size", "gram", "n"))))
        some |= own.num_rows > 0
    return models if some else []


def frequent(counts: DataFrame, least_count: int | None = None) -> DataFrame:
    """The counts in contexts of up to two bytes, and in longer ones that occur ``least_count`` times (``LEAST_COUNT``) in all languages together.

    The shorter parts of a context occur no less often, so they stay with it.
    """
    total = F.sum("n").over(W.partitionBy("size", F.shiftright("gram", 8)))
    long = F.col("size") > 3
    rare = counts.filter(long).withColumn("_total", total).filter(F.col("_total") >= (LEAST_COUNT if least_count is None else least_count)).drop("_total")
    return counts.filter(~long).unionByName(rare)


def build(languages: list[str], which: np.ndarray, size: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """The model of every context that was counted; what a language costs does not depend on the others' counts."""
    by = np.argsort(which, kind="stable")
    which, size, gram, n = which[by], size[by], gram[by], n[by]
    seen = np.unique(gram[size == 1])
    width = len(seen) + 2  # beside the bytes seen: any other byte, and the gap
    symbol = np.full(256, len(seen), np.int64)
    symbol[seen] = np.arange(len(seen))
    symbol[GAP] = len(seen) + 1
    met, cost = [], []
    for lang in range(len(languages)):
        a, b = np.searchsorted(which, [lang, lang + 1])
        orders, costs = _language(size[a:b], gram[a:b], n[a:b], symbol, width)
        met.append(orders)
        cost.append(costs)
    orders = [np.unique(np.concatenate([m[k] for m in met])) for k in range(ORDER + 1)]
    first = [0, *np.cumsum([len(o) for o in orders]).tolist()]
    child, parents = [], [np.zeros(1, np.int64)]
    for k in range(ORDER):
        table = np.full(max(1, len(orders[k])) * width, -1, np.int32)
        parent = np.searchsorted(orders[k], orders[k + 1] & ((1 << 8 * k) - 1))
        table[parent * width + symbol[orders[k + 1] >> 8 * k]] = np.arange(len(orders[k + 1]))
        child.append(table)
        parents.append(parent)
    own = [_longest_met(orders, m, first, parents) * width for m in met]
    return Model(languages, symbol, width, child, first, own, cost)


def _longest_met(orders, met, first, parents) -> np.ndarray:
    """For each context of ``orders``, the number in ``met`` of its longest part that is there."""
    own, before = np.zeros(first[-1], np.int64), 0
    for k in range(1, len(orders)):
        before += len(met[k - 1])
        here = own[first[k - 1] + parents[k]]
        at = np.searchsorted(orders[k], met[k])
        here[at] = before + np.arange(len(at))
        own[first[k] : first[k + 1]] = here
    return own


def _language(size, gram, n, symbol, width) -> tuple[list[np.ndarray], np.ndarray]:
    """The contexts of each order that a language met, and its costs there, from the empty context to the longest.

    ``escaped`` is what a byte costs once a context has been left: coded in the next
    shorter one without the bytes that the left one had.
    """
    orders, costs = [], []
    counts_up = escaped_up = None
    for k in range(ORDER + 1):
        own = size == k + 1
        by = np.argsort(gram[own])
        grams, many = gram[own][by], n[own][by]
        contexts = np.unique(grams >> 8) if k else np.zeros(1, np.int64)
        up = np.searchsorted(orders[-1], contexts & ((1 << 8 * (k - 1)) - 1)) if k else None
        orders.append(contexts)
        kept_counts, kept_escaped = [], []
        for a in range(0, len(contexts), ROWS):
            here = contexts[a : a + ROWS]
            lo, hi = np.searchsorted(grams >> 8, [here[0], here[-1] + 1])
            counts = np.zeros((len(here), width))
            np.add.at(counts, (np.searchsorted(here, grams[lo:hi] >> 8), symbol[grams[lo:hi] & 255]), many[lo:hi])
            has = counts > 0
            total, kinds = counts.sum(1), has.sum(1)
            if k == 0:
                # of 256 bytes, those not seen in the empty context; "any other byte" stands for one of them
                escaped = np.full((1, width), np.log2(max(1, 256 - int(kinds[0]))))
                out = np.where(has, -np.log2(np.maximum(counts, 1) / (total + kinds)[:, None]), escaped - np.log2(kinds / (total + kinds))[:, None]) if total[0] else escaped
            else:
                above, shorter = counts_up[up[a : a + ROWS]], escaped_up[up[a : a + ROWS]]
                over = (above > 0) & ~has
                rest, kinds_rest = np.where(has, 0, above).sum(1), over.sum(1)
                whole = np.maximum(rest + kinds_rest, 1)[:, None]
                leave = np.where(kinds_rest > 0, -np.log2(np.maximum(kinds_rest, 1) / whole[:, 0]), 0.0)[:, None]
                escaped = np.where(over, -np.log2(np.maximum(above, 1) / whole), leave + shorter)
                own_total = (total + kinds)[:, None]
                out = np.where(has, -np.log2(np.maximum(counts, 1) / own_total), -np.log2(kinds[:, None] / own_total) + escaped)
            out[:, width - 1] = 0  # the gap is not coded
            costs.append(np.round(out * UNIT).astype(np.int32).reshape(-1))
            if k < ORDER:
                kept_counts.append(counts)
                kept_escaped.append(escaped)
        if kept_counts:
            counts_up, escaped_up = np.concatenate(kept_counts), np.concatenate(kept_escaped)
    return orders, np.concatenate(costs)


def identify(df: DataFrame, models: list[Model], kept: list[str], text_col: str = "text") -> DataFrame:
    """The ``kept`` columns of every row, with lang_pred (a learned language, or ``und``), score (0 to 1) and bits_per_byte.

    ``und`` with score 0 is the answer for a text that is NULL or has no letter, and for
    every text where nothing could be learned.  The score is the share of the winner in
    two to the power of minus the code lengths; ties go to the first language by name.
    Whole texts are read, a long one in chunks; nothing is shuffled.  No rows: no rows.
    """
    added = ["lang_pred", "score", "bits_per_byte"]
    rows = df.select(*kept, text_or_empty(text_col).alias("_bytes"), has_letter(F.col(text_col)).alias("_letter"))
    fields = [*rows.schema.fields[:-2], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())]
    shared = [df.sparkSession.sparkContext.broadcast(m) for m in models]  # as large as what the sampled texts hold
    languages = np.array([x for m in models for x in m.languages], object)
    place = len(kept)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_bytes", BLOCK_BYTES):
            texts = [t.encode() for t in batch.column(place).to_pylist()]
            letter = np.array(batch.column(place + 1).to_pylist(), bool)
            if not shared:
                letter[:] = False
            names, scores, rates = np.full(len(texts), "und", object), np.zeros(len(texts)), np.full(len(texts), np.nan)
            if letter.any():
                some = np.flatnonzero(letter)
                lettered = [texts[k] for k in some]
                bits = np.concatenate([s.value.bits(lettered) for s in shared], 1) / UNIT
                best = bits.argmin(1)
                least = bits[np.arange(len(some)), best]
                names[some] = languages[best]
                scores[some] = 1 / np.exp2(-(bits - least[:, None])).sum(1)
                rates[some] = least / np.array([len(texts[k]) for k in some])
            out = [pa.array(names.tolist(), pa.string()), pa.array(scores), pa.array(rates, from_pandas=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], *out], names=[*kept, *added])

    return rows.mapInArrow(predict, T.StructType(fields))


def predict_documents(docs: DataFrame, least_count: int | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte of every document, by a model of those not held out.

    A NULL doc_id counts as an empty string in the choice of held-out rows; repeated rows
    are predicted each, alike.  ``least_count``: see ``frequent``; 1 keeps every context.
    """
    found = identify(docs.select("doc_id", "text", (remainder(F.col("doc_id")) == 1).alias("held_out")), fit(docs, least_count=least_count), ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def with_language(docs: DataFrame) -> DataFrame:
    """The documents whose language could be told, with the columns they had; those without a letter go.

    Where nothing could be learned, as no text that is not held out has a lang, every
    document with a letter stays.
    """
    models = fit(docs)
    if not models:
        return docs.filter(has_letter(F.col("text")))
    rows = docs.select(F.struct("*").alias("_row"), F.col("text").alias("text"))
    return identify(rows, models, ["_row"]).filter("lang_pred <> 'und'").select("_row.*")
