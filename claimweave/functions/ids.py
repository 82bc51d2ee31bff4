"""Ids derived from content, so that a second run produces the same ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]))


def hash16(c: Column) -> Column:
    """A number in 0..65535 spread by md5."""
    return F.conv(F.substring(F.md5(c), 1, 4), 16, 10).cast("int")
