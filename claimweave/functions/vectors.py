"""Vector expressions."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.functions.settle import settled


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, p: s + p)


def unit(v: Column) -> Column:
    """The vector at length 1; a zero vector stays as it is.

    The length sits in a one-element array, so it is taken once per vector and not
    once per element.
    """
    v = v.cast("array<double>")
    bound = F.array(F.struct(v.alias("v"), F.sqrt(dot(v, v)).alias("n")))
    scaled = F.transform(
        bound, lambda b: F.when(b["n"] > 0, F.transform(b["v"], lambda x: x / b["n"])).otherwise(b["v"])
    )
    return F.get(scaled, F.lit(0))


STEP = 2.0**-40  # unit of what is added to the single numbers of a packed vector


def pack(m: np.ndarray) -> list[bytes]:
    """Rows of numbers from -1 to 1 as bytes: single numbers, then what they lack, to within a STEP; 6 bytes a number."""
    high = m.astype("<f4")
    low = np.clip(np.rint((m - high) / STEP), -32768, 32767).astype("<i2")
    return [a.tobytes() + b.tobytes() for a, b in zip(high, low)]


def unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The single numbers of packed rows and what they lack, in units of STEP; ``whole`` adds them."""
    if not len(column):
        return np.empty((0, 0), "<f4"), np.empty((0, 0), "<i2")
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    rows = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(column), -1)
    cut = rows.shape[1] // 6 * 4
    return rows[:, :cut].copy().view("<f4"), rows[:, cut:].copy().view("<i2")


def whole(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(float) + low * STEP


_DIRECTION = T.StructType([T.StructField("v", T.BinaryType()), T.StructField("k", T.StringType()), T.StructField("none", T.BooleanType())])


@F.pandas_udf(_DIRECTION)
def direction(v: pd.Series) -> pd.DataFrame:
    """The unit vector without its last bits, packed; a hash of it that copies share; whether it has no direction."""
    if not len(v):
        return pd.DataFrame({"v": [], "k": [], "none": []}, dtype=object)
    m = np.stack(v.to_numpy()).astype(float)
    length = np.linalg.norm(m, axis=1, keepdims=True)
    m = np.round(m / np.where(length > 0, length, 1.0), 12) + 0.0
    return pd.DataFrame({"v": pack(m), "k": [hashlib.md5(row.tobytes()).hexdigest() for row in m], "none": (m == 0).all(1)})


def with_token_vector(rows: DataFrame, words: Column, name: str = "embedding", dims: int = 64) -> DataFrame:
    """Default text embedding: each word adds +1 or -1 at a place given by its md5; unit length."""
    hashed = settled(
        rows, {"_hashed": F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("int"))}
    )
    places = F.transform(
        F.sequence(F.lit(0), F.lit(dims - 1)),
        lambda d: F.aggregate(
            F.filter("_hashed", lambda h: h % dims == d),
            F.lit(0.0),
            lambda s, h: s + F.when(F.floor(h / dims) % 2 == 0, 1.0).otherwise(-1.0),
        ),
    )
    raw = settled(hashed, {"_raw": places})
    return settled(raw, {name: unit(F.col("_raw"))}).drop("_hashed", "_raw")
