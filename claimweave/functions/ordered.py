"""Running values along an order, without one task per key.

A window over ``partitionBy(key)`` puts all rows of a key into one task, which
is too much when a key holds a third of the table.  Here a key is cut into
chunks that follow the order.  Each chunk is scanned by itself, the chunks of a
key are summed up in one row each, and what earlier chunks contribute comes as a row
before the first of the chunk.  The result is that of the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from claimweave.session import durable

_AGG = {"sum": F.sum, "max": F.max, "min": F.min, "later_min": F.min}


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    chunk: Column,
    outputs: dict[str, tuple[str, Column]],
    inclusive: bool = True,
) -> DataFrame:
    """Add running sums, maxima or minima.

    ``chunk`` must never fall as the order rises.  ``outputs`` maps a new column
    to (``sum`` | ``max`` | ``min`` | ``later_min``, expression); the last is the least value
    of the rows that follow.
    """
    rows = df.withColumn("_chunk", chunk)
    part = [*keys, "_chunk"]

    def frames(kind: str) -> tuple[WindowSpec, WindowSpec]:
        def along(column: str) -> Column:
            return F.col(column).desc() if kind == "later_min" else F.col(column).asc()

        near = W.partitionBy(*part).orderBy("_own", *[along(o) for o in order])
        far = W.partitionBy(*keys).orderBy(along("_chunk"))
        return (
            near.rowsBetween(W.unboundedPreceding, 0 if inclusive else -1),
            far.rowsBetween(W.unboundedPreceding, -1),
        )

    totals = rows.groupBy(*part).agg(*[_AGG[kind](e).alias(f"_t_{name}") for name, (kind, e) in outputs.items()])
    carried = totals.select(
        *part, F.lit(False).alias("_own"), *[_AGG[kind](f"_t_{name}").over(frames(kind)[1]).alias(f"_e_{name}") for name, (kind, _) in outputs.items()]
    )
    own = rows.select("*", F.lit(True).alias("_own"), *[e.alias(f"_e_{name}") for name, (_, e) in outputs.items()])

    def scanned(name: str, kind: str) -> Column:
        value = _AGG[kind](f"_e_{name}").over(frames(kind)[0])
        return (F.coalesce(value, F.lit(0)) if kind == "sum" else value).alias(name)

    # in one shuffle with the rows, so these are not moved again to meet it
    both = own.unionByName(carried, allowMissingColumns=True)
    kept = [c for c in df.columns if c not in outputs]
    return both.select(*kept, "_own", *[scanned(name, kind) for name, (kind, _) in outputs.items()]).filter("_own").select(*kept, *outputs)


def numbered(df: DataFrame, keys: list[str], order: list[str], chunk: Column, name: str = "row_no") -> DataFrame:
    """Number the rows of each key from 1."""
    return running(df, keys, order, chunk, {name: ("sum", F.lit(1).cast("bigint"))})


def previous(df: DataFrame, keys: list[str], order: str, chunk: Column, fields: list[str], name: str = "prev") -> DataFrame:
    """Add a struct of ``fields`` of the row before; ``order`` must be unique per key."""
    return running(df, keys, [order], chunk, {name: ("max", F.struct(order, *[f for f in fields if f != order]))}, inclusive=False)


def blocks(c: Column | str, size: int = 4096) -> Column:
    """Chunks of a whole-number order."""
    return F.floor((F.col(c) if isinstance(c, str) else c) / size).cast("bigint")


def ranged(df: DataFrame, column: str, name: str = "_range") -> DataFrame:
    """Add chunks that are ranges of ``column`` with about as many rows each, whatever its values look like.

    The rows are kept, so that all readers see the same ranges.
    """
    return durable(df.repartitionByRange(column).withColumn(name, F.spark_partition_id()))


def id_prefix(c: Column | str, digits: int = 3) -> Column:
    """Chunks of an order by content id; ids are spread evenly over prefixes."""
    return F.substring(c, 1, digits)


def pages(
    df: DataFrame, keys: list[str], value: str, page_size: int, lists: dict[str, Column], chunk: Column | None = None
) -> DataFrame:
    """Lists per key in the order of ``value``, cut into pages of bounded length.

    A key with few rows gives one row; a key with very many gives many rows
    instead of one array that no task could hold.
    """
    ranked = numbered(df, keys, [value], id_prefix(value) if chunk is None else chunk, "_rn")
    paged = ranked.withColumn("page_no", F.floor((F.col("_rn") - 1) / page_size).cast("bigint"))
    collected = paged.groupBy(*keys, "page_no").agg(
        F.array_sort(F.collect_list(F.struct("_rn", *[e.alias(n) for n, e in lists.items()]))).alias("_items")
    )
    return collected.select(*keys, "page_no", *[F.col("_items")[n].alias(n) for n in lists])
