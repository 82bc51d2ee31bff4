"""Token counts by rank-synchronous array merging."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import slices, text_or_empty
from claimweave.llm.pretokens import PreTokens, RankedMerges, windows

BLOCK_BYTES = 4 << 20
# pre-tokens whose counts a worker remembers; the memory is emptied when full, which changes no result
REMEMBERED, LONGEST_REMEMBERED = 400_000, 64


class Counter:
    def __init__(self, path: str):
        self.pre = PreTokens(path)
        self.merges = RankedMerges(self.pre.spec)
        self.known: dict = {}

    def __call__(self, texts: list[str]) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        cut, owner = [], []
        out = [0] * len(texts)
        for k, text in enumerate(texts):
            for part in windows(text):
                owner.append(k)
                if self.pre.plain(part):
                    cut.append(self.pre.words(part))
                else:
                    parts, special = self.pre.parts(part)
                    cut.append(parts)
                    out[k] += special
        known = self.known
        new = list(set().union(*cut) - known.keys())
        raw = [t.encode() if isinstance(t, str) else t for t in new]
        known.update(zip(new, self.merges.counts(raw).tolist(), strict=True))
        for k, words in zip(owner, cut, strict=True):
            out[k] += sum(map(known.__getitem__, words))
        for t in new:
            if len(t) > LONGEST_REMEMBERED:
                del known[t]
        return out


@lru_cache(maxsize=1)
def counter_of(path: str) -> Counter:
    """The counter of a worker, which keeps what it has learned from task to task."""
    return Counter(path)


def count_tokens(df: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    Counts are those of the tokenizer file at ``path`` without added special tokens;
    special strings inside texts count as one token each.  NULL text is empty and has
    no tokens.  Repeated rows are counted each; no rows: no rows.  Whole texts are
    counted, in blocks of rows; nothing is shuffled.  ``path`` must be readable where
    tasks run, as an installed package's files are.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for batch in slices(batches, "text", BLOCK_BYTES):
            tokens = pa.array(counter(batch.column(2).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens], names=["id", "n_bytes", "n_tokens"])

    text = text_or_empty(text_col)
    rows = df.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
