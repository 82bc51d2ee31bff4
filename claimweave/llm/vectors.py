"""Vectors that can be compared: not NULL, not zero, all components finite; those of one length with each other."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def lengths(df: DataFrame, vector: str) -> list[int]:
    """The numbers of components that occur, ascending."""
    return sorted(r["d"] for r in df.select(F.size(vector).alias("d")).distinct().collect())


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column without NULLs, all of one length, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def directions(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))
