"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add ``columns`` so that later steps read them instead of repeating them.

    A plain projection is merged into the steps after it and its expressions are
    copied to every use, also into filters.  After a few steps of text parsing the
    copies multiply until generated code no longer fits a method.  A one-row
    ``inline`` keeps each value where it is computed, stays inside code generation
    and needs no shuffle.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
