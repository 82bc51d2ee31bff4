"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, gone through again
once it is used up, ``repeats`` times at most.  A copy's virtual finish time is
the words its source has sent up to and with it, divided by the source's target.
All copies are taken in the order of finish times until the budget is spent; as
every source is served in proportion to its target, each ends close to it.

Neither a source nor the whole order is ever in one task: a source is cut into
4096 chunks of its shuffled order, whose totals are summed up in a small table;
the global cut is found from totals of fine slots of virtual time, and only the
one slot in which the budget runs out is put in exact order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave.llm.base import WORD, saved

WEIGHTS, SHARE, REPEATS = (3, 1, 2), 1.5, 2
SLOTS, LAST_SLOT = 4096, 1 << 24


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Sorts as the source by code point, NULL last; never NULL."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("t"))


def shuffle_key(doc_id: Column, text: Column) -> Column:
    """32 hex digits, the same on every run."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(_source, source_size, target) from (_source, source_size).

    Targets follow the weights until a source would pass ``repeats`` times its size;
    there it stops and the others share the excess.  Sources in the order of size per
    weight reach their stop one after the other, so the common level is that of the
    first source that does not reach it.  One row per source: the windows are small.
    """
    listed = F.array(*[F.lit(w) for w in weights])
    every = W.partitionBy(F.lit(0))
    ranked = sizes.select(
        "_source",
        "source_size",
        F.element_at(listed, (F.pmod(F.row_number().over(every.orderBy("_source")) - 1, F.lit(len(weights))) + 1).cast("int")).alias("_w"),
        (F.sum("source_size").over(every) * F.lit(float(share))).alias("_budget"),
    ).withColumn("_ratio", F.col("source_size") * repeats / F.col("_w"))
    order = every.orderBy("_ratio", "_source")
    stopped = F.coalesce(F.sum(F.col("source_size") * repeats).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("_w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    levels = ranked.select("*", ((F.col("_budget") - stopped) / left).alias("_level"), F.row_number().over(order).alias("_no"))
    free = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_no", "_level"))
    level = F.min(free).over(every)["_level"]
    return levels.select("_source", "source_size", F.least(F.col("source_size").cast("double") * repeats, level * F.col("_w")).alias("target"))


def fair_mix(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """Every row of ``rows`` with source_size, target, copies (how often the mix takes it) and finish (of its first copy).

    ``rows`` has _size (words, not NULL), _source and _key (see ``source_key`` and
    ``shuffle_key``) beside any other columns.  Copies are taken while their words fit
    into the budget, ``share`` times all words.  Rows that agree in key, size and source
    are interchangeable.  No rows: no rows; no words at all: every target is 0 and rows
    are taken once.
    """
    chunk = F.conv(F.substring("_key", 1, 3), 16, 10).cast("int")
    narrow = rows.select("_source", "_key", "_size", chunk.alias("_chunk"))
    totals = saved(narrow.groupBy("_source", "_chunk").agg(F.sum("_size").alias("_sum")), "mix-totals")
    goal = targets(totals.groupBy("_source").agg(F.sum("_sum").alias("source_size")), weights, share, repeats)
    before = W.partitionBy("_source").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = saved(
        totals.select("_source", "_chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")).join(goal, "_source"),
        "mix-offsets",
    )

    def timed(some: DataFrame) -> DataFrame:
        near = W.partitionBy("_source", "_chunk").orderBy("_key", "_size").rowsBetween(W.unboundedPreceding, 0)
        summed = some.withColumn("_sent", F.sum("_size").over(near)).join(offsets, ["_source", "_chunk"])
        return summed.withColumn("_sent", F.col("_sent") + F.col("_before")).withColumn("finish", finish(0))

    def finish(copy: int) -> Column:
        sent = F.col("_sent") + copy * F.col("source_size")
        return F.when(F.col("target") > 0, sent / F.col("target")).otherwise(F.lit(0.0))

    times = timed(narrow).select(
        "_source", "_key", "_size", F.posexplode(F.array(*[finish(c) for c in range(repeats)])).alias("_copy", "_at")
    )
    times = times.withColumn("_slot", F.least(F.floor(F.col("_at") * SLOTS), F.lit(LAST_SLOT)).cast("int"))
    slots = saved(times.groupBy("_slot").agg(F.sum("_size").alias("_sum")), "mix-slots")
    budget = min(share, float(repeats)) * (totals.agg(F.sum("_sum").alias("n")).first()["n"] or 0)
    cut = _cut(times, slots, budget) if budget else None
    if not budget:
        copies = F.lit(1)
    elif cut is None:
        copies = F.lit(repeats)
    else:
        last = F.struct(F.lit(cut["_at"]).alias("at"), F.lit(cut["_source"]).alias("source"), F.lit(cut["_key"]).alias("key"))
        copies = sum(
            (F.struct(finish(c).alias("at"), F.col("_source").alias("source"), F.col("_key").alias("key")) <= last).cast("int")
            for c in range(repeats)
        )
    return timed(rows.withColumn("_chunk", chunk)).select(*rows.columns, "source_size", "target", copies.alias("copies"), "finish")


def _cut(times: DataFrame, slots: DataFrame, budget: float):
    """Last copy that the budget pays for, in the order of (finish time, source, key); None if it pays for all."""
    total = W.partitionBy(F.lit(0)).orderBy("_slot").rowsBetween(W.unboundedPreceding, 0)
    reached = slots.select("_slot", "_sum", F.sum("_sum").over(total).alias("_to"))
    broken = reached.filter(F.col("_to") > budget).orderBy("_slot").first()
    if broken is None:
        return None
    within = W.partitionBy("_slot").orderBy("_at", "_source", "_key").rangeBetween(W.unboundedPreceding, 0)
    spent = broken["_to"] - broken["_sum"]
    inside = times.filter(F.col("_slot") == broken["_slot"]).withColumn("_to", F.sum("_size").over(within) + spent)
    last = inside.filter(F.col("_to") <= budget).orderBy(F.desc("_at"), F.desc("_source"), F.desc("_key")).first()
    # if not even the first fits, all copies of earlier slots are the mix
    return last or {"_at": broken["_slot"] / SLOTS, "_source": "", "_key": ""}


def mix_rows(docs: DataFrame, *kept: Column) -> DataFrame:
    """Size, source and shuffled order of documents, as ``fair_mix`` reads them, beside ``kept``."""
    return docs.select(
        *kept,
        words(F.col("text")).alias("_size"),
        source_key(F.col("source")).alias("_source"),
        shuffle_key(F.col("doc_id"), F.col("text")).alias("_key"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row per copy taken, ordered by finish time in range partitions."""
    taken = fair_mix(mix_rows(docs, F.struct("*").alias("_row"))).filter("copies > 0")
    each = taken.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    again = F.col("_copy") * F.col("source_size") / F.greatest("target", F.lit(1e-9))
    ordered = each.select("_row", (F.col("finish") + again).alias("_finish")).repartitionByRange("_finish")
    return ordered.sortWithinPartitions("_finish").select("_row.*")


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    rows = saved(mix_rows(docs, F.col("doc_id")), "mix-rows")
    return fair_mix(rows).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("source_size"),
        F.col("target"),
        (F.col("_size") * F.col("copies")).alias("taken"),
    )


# the same in one plain SQL statement: no chunks, no slots
REPORT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, 't') AS src, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS k
  FROM documents),
s AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::INT] AS w, sum(source_size) OVER () * 1.5::DOUBLE AS b FROM s),
r AS (SELECT *, source_size * 2 / w::DOUBLE AS ratio FROM w),
l AS (SELECT *, row_number() OVER (ORDER BY ratio, src) AS no,
             (b - coalesce(sum(source_size * 2) OVER (ORDER BY ratio, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY ratio, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level FROM r),
t AS (SELECT src, source_size, least(source_size * 2.0::DOUBLE, w * (SELECT arg_min(level, no) FROM l WHERE level <= ratio)) AS target FROM l),
q AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY src ORDER BY k, size ROWS UNBOUNDED PRECEDING)::BIGINT AS sent
      FROM d JOIN t USING (src)),
c AS (SELECT *, e, CASE WHEN target > 0 THEN (sent + e * source_size) / target::DOUBLE ELSE 0 END AS due FROM q, (VALUES (0), (1)) AS copy(e)),
o AS (SELECT *, sum(size) OVER (ORDER BY due, src, k) AS upto FROM c)
SELECT doc_id, size, source_size, target, sum(CASE WHEN upto <= (SELECT 1.5::DOUBLE * sum(source_size) FROM s) THEN size ELSE 0 END)::BIGINT AS taken
FROM o GROUP BY doc_id, k, sent, size, source_size, target
"""
