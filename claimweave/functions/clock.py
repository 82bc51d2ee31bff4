"""HH:MM:SS offsets, and the checks on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave import fixed


def well_formed(c: Column) -> Column:
    return F.coalesce(c.rlike(fixed.CLOCK), F.lit(False))


def part(c: Column, i: int) -> Column:
    return F.substring(c, 3 * i + 1, 2).try_cast("int")


def problem(c: Column) -> Column:
    """First rule the value breaks, NULL when it breaks none."""
    return (
        F.when(~well_formed(c), F.concat(F.lit("Invalid timestamp format: "), c, F.lit(". Expected HH:MM:SS")))
        .when(part(c, 0) > 23, F.concat(F.lit("Invalid hours in timestamp: "), part(c, 0).cast("string")))
        .when(part(c, 1) > 59, F.concat(F.lit("Invalid minutes in timestamp: "), part(c, 1).cast("string")))
        .when(part(c, 2) > 59, F.concat(F.lit("Invalid seconds in timestamp: "), part(c, 2).cast("string")))
    )


def seconds(c: Column) -> Column:
    """Seconds of an offset known to be valid."""
    return part(c, 0) * 3600 + part(c, 1) * 60 + part(c, 2)


def to_seconds(c: Column) -> Column:
    """Seconds of a valid offset, NULL otherwise."""
    return F.when(problem(c).isNull(), seconds(c))


def render(seconds: Column) -> Column:
    """HH:MM:SS of a number of seconds; hours may pass 23."""
    s = seconds.cast("bigint")
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(s / 3600).cast("bigint"),
        F.floor((s % 3600) / 60).cast("bigint"),
        s % 60,
    )
