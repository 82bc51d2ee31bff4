"""Transitive grouping: connected components of accepted pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.session import durable


def components(pairs: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, group_id) for every id in ``pairs`` (columns a, b); the group is its smallest id.

    Alternates the large-star and small-star steps of Kiveris et al., "Connected
    Components in MapReduce and Beyond" (2014).  Each step is a minimum per node
    (combined before the shuffle) and a join back to the edges; a node with very
    many edges is a skewed join key that adaptive execution splits.  The number of
    edges never grows.  Each round is written to the checkpoint folder, so a lost
    executor costs at most one round.
    """
    edges = durable(
        pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    )
    state = _state(edges)
    for _ in range(max_rounds):
        edges = durable(_small_star(_large_star(edges)))
        new = _state(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"groups not settled after {max_rounds} rounds")
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("group_id"))
    centres = edges.select(F.col("v").alias("id"), F.col("v").alias("group_id")).distinct()
    return stars.unionByName(centres)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour to the smallest node around (itself included)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour, and the node itself, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).distinct()


def with_singletons(ids: DataFrame, key: str, groups: DataFrame) -> DataFrame:
    """Every id with its group; an id in no pair is a group of its own."""
    named = groups.select(F.col("id").alias(key), "group_id")
    return ids.join(named, key, "left").withColumn("group_id", F.coalesce("group_id", key))
