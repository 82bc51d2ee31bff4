"""Small tables with the awkward cases: NULL everywhere, empty and long texts, ties, repeated rows, clashing names."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    long = "lorem ipsum dolor sit amet " * 4000
    rows = [
        (1, "the cat sat on the mat and looked at the dog", "en", "a", 1),
        (2, "the cat sat on the mat and looked at the dog", "en", "b", None),
        (3, None, "en", "a", 0),
        (4, "", None, None, 0),
        (5, " \t\n ", "fr", "a", 0),
        (6, long, "de", "c", 1),
        (7, "12 34 !!", "es", "d", 1),
        (8, "x", "es", None, 1),
        (9, "twice the same row", "en", "a", 1),
        (9, "twice the same row", "en", "a", 1),
        (None, "no id", None, "b", 1),
        (11, "Ünïcödé ÇA <|endoftext|> don't 漢字   é ½²", "fr", "b", 1),
    ]
    wide = "doc_id long, text string, lang string, source string, n_chars long, size int, shard int, target string, finish int, copies int, component_id int, _key int"
    return spark.createDataFrame([r + (0, 0, "t", 0, 0, 0, 0) for r in rows], wide)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
