"""Fill-in-middle transformation with a sparse index of multibyte characters.

Texts are worked on as UTF-8 bytes, many at a time.  Only multibyte characters are
recorded: where each lies and how many bytes beyond one it has taken so far.  Between
them a code point is a byte, so either position follows from the other by one search
and one sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.base import slices, text_or_empty, utf8

BLOCK_BYTES = 4 << 20
# marks before prefix, suffix and middle
MARKS = ("<P>", "<S>", "<M>")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Exceptions:
    """Multibyte characters of a run of UTF-8 bytes: places in bytes and code points, and excess bytes before each."""

    def __init__(self, data: np.ndarray):
        self.in_bytes = np.flatnonzero(data >= 0xC0)
        lead = data[self.in_bytes]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate((np.zeros(1, np.int64), np.cumsum(excess)))
        self.in_chars = self.in_bytes - self.before[:-1]

    def chars_at(self, at: np.ndarray) -> np.ndarray:
        """Code points before each byte position (between characters)."""
        return at - self.before[np.searchsorted(self.in_bytes, at)]

    def bytes_at(self, at: np.ndarray) -> np.ndarray:
        """Bytes before each position in code points."""
        return at + self.before[np.searchsorted(self.in_chars, at)]


def word_ends(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where each token of the texts ends: words with the white space before them, and white space at a text's end."""
    last = np.zeros(len(data), bool)
    last[starts[1:][starts[1:] > starts[:-1]] - 1] = True
    space = _SPACE[data]
    before_space = np.concatenate((space[1:], np.ones(min(1, len(data)), bool)))
    return np.flatnonzero(last | (~space & before_space)) + 1


def cuts(data: np.ndarray, starts: np.ndarray, h1: np.ndarray, h2: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(units, byte cuts, code points of prefix, of middle) of each text; the cuts are two columns."""
    index = Exceptions(data)
    opens = index.chars_at(starts)
    if unit == "char":
        n = np.diff(opens)
        units = np.sort(np.stack((h1 % (n + 1), h2 % (n + 1)), 1), axis=1)
        at = index.bytes_at(opens[:-1, None] + units)
        points = units
    else:
        ends = word_ends(data, starts)
        first = np.searchsorted(ends, starts, side="right")
        n = np.diff(first)
        units = np.sort(np.stack((h1 % (n + 1), h2 % (n + 1)), 1), axis=1)
        ends = np.append(ends, len(data))  # never chosen; for texts without tokens
        at = np.where(units == 0, starts[:-1, None], ends[np.maximum(first[:-1, None] + units - 1, 0)])
        points = index.chars_at(at) - opens[:-1, None]
    return n, at, points[:, 0], points[:, 1] - points[:, 0]


def infill(df: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, unit: str = "word", marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    A text is cut in three after whole units (``word``: a word with the white space
    before it, white space at the end being a unit of its own; ``char``: a code point).
    The places are two remainders of the sha256 of ``seed:doc_id`` by units + 1, and its
    next two numbers choose whether to transform (``percent`` of 100) and how
    (``spm_percent``: suffix first, else prefix first).  Empty texts and texts that hold
    a mark stay plain.  NULL text is empty; a NULL doc_id is hashed as an empty string;
    repeated rows are transformed alike; no rows: no rows.  Nothing is shuffled.
    """
    if unit not in ("word", "char"):
        raise ValueError(f"unit {unit!r}: word or char")
    text = text_or_empty()
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = lambda k: F.conv(F.substring("_digest", 8 * k + 1, 8), 16, 10).cast("long")
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains("_text", F.lit(mark))
    plain = (F.col("_text") == "") | marked | (number(2) % 100 >= percent)
    form = F.when(plain, "plain").when(number(3) % 100 < spm_percent, "spm").otherwise("psm")
    rows = df.select(F.col("doc_id"), digest.alias("_digest"), text.alias("_text"))
    rows = rows.select("doc_id", F.col("_text").alias("text"), number(0).alias("h1"), number(1).alias("h2"), form.alias("form"))
    p, s, m = (x.encode() for x in marks)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK_BYTES):
            data, starts = utf8(batch.column(1))
            h1, h2 = (batch.column(k).to_numpy() for k in (2, 3))
            n, at, prefix, middle = cuts(data, starts, h1, h2, unit)
            raw, out = memoryview(data), []
            forms = batch.column(4).to_pylist()
            for a, (b, c), d, kind in zip(starts[:-1].tolist(), at.tolist(), starts[1:].tolist(), forms, strict=True):
                if kind == "spm":
                    out.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
                elif kind == "psm":
                    out.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
                else:
                    out.append(bytes(raw[a:d]))
            none = np.array([kind == "plain" for kind in forms], bool)
            columns = [batch.column(0), pa.array(n, pa.int64()), batch.column(4), pa.array(prefix, pa.int64(), mask=none), pa.array(middle, pa.int64(), mask=none)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(transform, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column | str = "output", form: Column | str = "form", marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made of; only the three marks that were set are found, as no transformed text holds one."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    p, s, m = marks

    def parts(one: str, two: str) -> tuple[Column, Column, Column]:
        """What follows ``one``, ``two`` and the last mark."""
        rest = F.substr(output, F.lit(len(one) + 1))
        head = F.substring_index(rest, two, 1)
        tail = F.substr(rest, F.length(head) + len(two) + 1)
        body = F.substring_index(tail, m, 1)
        return head, body, F.substr(tail, F.length(body) + len(m) + 1)

    suffix, prefix, middle = parts(s, p)
    before, after, between = parts(p, s)
    return F.when(form == "spm", F.concat(prefix, middle, suffix)).when(form == "psm", F.concat(before, between, after)).otherwise(output)


def infill_digests(docs: DataFrame) -> DataFrame:
    """Every document's form and cuts, with digests of its output and of the text read back from that output."""
    done = infill(docs)
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


DIGEST_SQL = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM documents),
numbers AS (
    SELECT doc_id, text, units, len(units) AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS c2,
           ('0x' || h[17:24])::BIGINT % 100 AS share, ('0x' || h[25:32])::BIGINT % 100 AS way FROM cut),
formed AS (
    SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR share >= 50 THEN 'plain'
                   WHEN way < 80 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(units[1:least(c1, c2)], '') AS prefix, array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
           array_to_string(units[greatest(c1, c2) + 1:], '') AS suffix FROM numbers)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM formed
"""
