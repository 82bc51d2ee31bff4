"""Fill-in-middle against a plain version with regular expressions."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plainly(doc_id, text, percent=50, unit="word"):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNIT.findall(text) if unit == "word" else list(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in infill.MARKS) or h3 % 100 >= percent:
        return len(units), "plain", None, None, text
    if h4 % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    odd = ["", None, " ", "\t\n x", "x \r\n", "a <P> b", "<M>", "< S>", "é", "日本 語 x y", "😀 a😀b  ", "<P", "S> <S", "\x0b\x0c", "nul\x00 byte ü", "\xa0 \x85"]
    rng = np.random.default_rng(3)
    letters = list("ab <SPM>é日😀 \n.")
    return odd + ["".join(rng.choice(letters, size)) for size in rng.integers(1, 60, 150)] + ["wort " * 50_000 + "ö" * 70_000]


@pytest.mark.parametrize("unit, percent", [("word", 50), ("word", 100), ("char", 100)])
def test_against_regular_expressions(spark, unit, percent):
    rows = [(k, t, "f", 1) for k, t in enumerate(texts())] + [(None, "no id here", "f", 1), (5, "again", "f", 1), (5, "again", "f", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")
    done = infill.infill(df, percent=percent, unit=unit).withColumn("back", infill.restored()).collect()
    want = sorted(((r[0], *plainly(r[0], r[1], percent, unit), r[1] or "") for r in rows), key=repr)
    assert sorted((tuple(r) for r in done), key=repr) == want


def test_positions_both_ways():
    text = "aé日😀 b" * 50
    raw = text.encode()
    index = infill.Exceptions(np.frombuffer(raw, np.uint8))
    chars = np.arange(len(text) + 1)
    want = np.array([len(text[:k].encode()) for k in chars])
    assert (index.bytes_at(chars) == want).all() and (index.chars_at(want) == chars).all()
    assert len(index.in_bytes) == 150


def test_no_rows_and_odd_documents(spark, no_docs, odd_docs):
    assert infill.infill_digests(no_docs).collect() == []
    found = infill.infill_digests(odd_docs).collect()
    assert len(found) == odd_docs.count()
    wanted = {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in odd_docs.collect()}
    assert all(r["restored_sha256"] == wanted[r["doc_id"]] for r in found)
    assert infill.infill(odd_docs).filter(F.col("form") == "plain").filter("prefix_chars IS NOT NULL").isEmpty()


def test_other_units_are_refused(odd_docs):
    with pytest.raises(ValueError):
        infill.infill(odd_docs, unit="line")
