"""Clusters to a four-tier hierarchy, with lineage to the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave import fixed
from claimweave.functions.ordered import pages
from claimweave.functions.settle import settled
from claimweave.operators.similar import nearest_above
from claimweave.params import DEFAULT, Params
from claimweave.session import durable


def flag_counts(flagged: DataFrame) -> DataFrame:
    """True flags per cluster; ``flagged`` has cluster_id and extraction_flags per belief."""
    named = flagged.select("cluster_id", F.explode(F.map_entries("extraction_flags")).alias("e")).filter("e.value")
    return named.groupBy("cluster_id", F.col("e.key").alias("flag")).agg(F.count(F.lit(1)).alias("n"))


def _literal_map(pairs: dict[str, str | int]) -> Column:
    return F.create_map(*[F.lit(x) for item in pairs.items() for x in item])


def tiers(clusters: DataFrame, counts: DataFrame, rules: dict[str, list[str]] = fixed.TIERS) -> DataFrame:
    """Tier with the most true flags; ties to the higher tier; none at all gives the lowest."""
    order = list(rules)
    of_flag = _literal_map({flag: order.index(tier) for tier, flags in rules.items() for flag in flags})
    votes = (
        counts.withColumn("ord", F.try_element_at(of_flag, F.col("flag")))
        .filter(F.col("ord").isNotNull())
        .groupBy("cluster_id", "ord")
        .agg(F.sum("n").alias("n"))
        .groupBy("cluster_id")
        .agg(F.min(F.struct((-F.col("n")).alias("r"), "ord")).alias("best"), F.sum("n").alias("votes"))
    )
    joined = clusters.select("cluster_id").join(votes, "cluster_id", "left")
    ord_ = F.coalesce(F.col("best.ord"), F.lit(len(order) - 1))
    return joined.select(
        "cluster_id",
        ord_.alias("tier_ord"),
        F.element_at(F.array(*[F.lit(t) for t in order]), ord_ + 1).alias("ontology_level"),
        F.coalesce("votes", F.lit(0)).alias("votes"),
        F.col("votes").isNull().alias("is_default"),
    )


def distribution(tiered: DataFrame) -> DataFrame:
    return tiered.groupBy("ontology_level").agg(F.count(F.lit(1)).alias("clusters"))


def default_count(tiered: DataFrame) -> DataFrame:
    return tiered.agg(F.count_if("is_default").alias("default_tier_assignments"))


def parents(tiered: DataFrame, centres: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Closest cluster of the nearest non-empty tier above, if similar enough; else a root.

    The tiers that hold clusters are at most as many as there are tiers, so they
    travel as one scalar.  The tier is part of the join key.
    """
    rows = tiered.join(centres, "cluster_id")
    present = tiered.agg(F.collect_set("tier_ord").alias("p")).scalar()
    target = F.array_max(F.filter("_present", lambda o: o < F.col("tier_ord")))
    children = settled(rows, {"_present": present}).select("cluster_id", F.col("centroid").alias("embedding"), target.alias("tier")).filter("tier IS NOT NULL")
    above = rows.select(F.col("cluster_id").alias("parent_id"), F.col("centroid").alias("embedding"), F.col("tier_ord").alias("tier"))
    found = nearest_above(
        children, above, "cluster_id", "parent_id", params.parent_similarity, at_least=True, same="tier", params=params
    )
    return tiered.join(found, "cluster_id", "left").select(
        *tiered.columns, F.col("parent_id").alias("parent_cluster_id"), F.col("similarity").alias("parent_similarity")
    )


def tree(nodes: DataFrame) -> DataFrame:
    """Depth, path from the root and number of children.

    Climbs until every path has reached its root, however many tiers the rules have;
    a node that is its own ancestor is an error.  Each step up is kept, so it is
    one join.
    """
    up = nodes.select(F.col("cluster_id").alias("_id"), F.col("parent_cluster_id").alias("_up"))
    rows = nodes.select("cluster_id", "ontology_level", "parent_cluster_id", F.array("cluster_id").alias("path"))
    rows = rows.withColumn("_next", F.col("parent_cluster_id"))
    rows = durable(rows)
    while not rows.filter(F.col("_next").isNotNull()).isEmpty():
        if not rows.filter(F.array_contains("path", F.col("_next"))).isEmpty():
            raise ValueError("the hierarchy holds a cycle")
        rows = rows.join(up, F.col("_next") == F.col("_id"), "left").select(
            "cluster_id",
            "ontology_level",
            "parent_cluster_id",
            F.when(F.col("_next").isNotNull(), F.array_prepend("path", F.col("_next"))).otherwise(F.col("path")).alias("path"),
            F.col("_up").alias("_next"),
        )
        rows = durable(rows)
    children = nodes.filter(F.col("parent_cluster_id").isNotNull()).groupBy(
        F.col("parent_cluster_id").alias("cluster_id")
    ).agg(F.count(F.lit(1)).alias("children"))
    return rows.join(children, "cluster_id", "left").select(
        "cluster_id",
        "ontology_level",
        "parent_cluster_id",
        (F.size("path") - 1).alias("depth"),
        "path",
        F.coalesce("children", F.lit(0)).alias("children"),
    )


def trace(membership: DataFrame, mentions: DataFrame) -> DataFrame:
    """Every link from cluster to canonical, belief, utterance and episode."""
    return membership.join(mentions, "canonical_id").select(
        "cluster_id", "canonical_id", "belief_id", "utterance_id", "episode_id", "speaker", "original_quote"
    )


def rolled_up(nodes: DataFrame, traced: DataFrame) -> DataFrame:
    """(node_id, utterance_id): sources of each node and of all nodes below it, each once."""
    above = nodes.select("cluster_id", F.explode("path").alias("node_id"))
    return traced.select("cluster_id", "utterance_id").join(above, "cluster_id").select("node_id", "utterance_id").distinct()


def source_lists(sources: DataFrame, params: Params = DEFAULT) -> DataFrame:
    return pages(sources, ["node_id"], "utterance_id", params.page_size, {"source_utterance_ids": F.col("utterance_id")})
