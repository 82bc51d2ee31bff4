"""Text expressions, all JVM-side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.params import DEFAULT, Params

# white space of Unicode, and the separators from 1c to 1f
_EDGE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.trim(c, F.lit(_EDGE))


def blank(c: Column) -> Column:
    return F.length(strip(c)) == 0


def one_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def sentences(c: Column) -> Column:
    """Pieces that end after ``.``, ``!`` or ``?`` before white space; blanks dropped."""
    return F.filter(F.split(c, r"(?U)(?<=[.!?])\s+"), lambda s: ~blank(s))


def norm_tokens(c: Column, params: Params = DEFAULT) -> Column:
    """Lower-cased words without punctuation, contractions opened, synonyms replaced."""
    opened = F.regexp_replace(F.lower(c), r"n['’]t\b", " not")
    words = F.split(one_space(F.regexp_replace(opened, r"[^\p{L}\p{N}\s]", " ")), " ")
    if not params.synonyms:
        return words
    table = F.create_map(*[F.lit(x) for pair in params.synonyms.items() for x in pair])
    return F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))


def norm_text(c: Column, params: Params = DEFAULT) -> Column:
    return F.array_join(norm_tokens(c, params), " ")


def is_negator(word: Column, params: Params = DEFAULT) -> Column:
    return word.isin(*params.negators)


def negation_parity(words: Column, params: Params = DEFAULT) -> Column:
    return F.size(F.filter(words, lambda w: is_negator(w, params))) % 2


def content_words(words: Column, params: Params = DEFAULT) -> Column:
    """The distinct words that are no negators, sorted."""
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: ~is_negator(w, params) & (w != ""))))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
