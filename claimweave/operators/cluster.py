"""Canonical beliefs to clusters by cosine distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.ordered import pages
from claimweave.functions.vectors import dot, unit
from claimweave.operators.cells import matrix
from claimweave.operators.groups import components, with_singletons
from claimweave.operators.similar import directed, links_of, nearest_above, similar_pairs
from claimweave.params import DEFAULT, Params


def close_pairs(vectors: DataFrame, distance: float, params: Params = DEFAULT) -> DataFrame:
    """Pairs of distinct vectors nearer than ``distance``; see ``similar_pairs``."""
    pairs = similar_pairs(vectors, "canonical_id", 1 - distance, params)
    return pairs.withColumn("distance", 1 - F.col("similarity")).drop("similarity")


def link_clusters(vectors: DataFrame, distance: float, params: Params = DEFAULT) -> DataFrame:
    """(canonical_id, cluster_id): single linkage below ``distance``, over all vectors; a zero vector is a cluster of its own."""
    rows = directed(vectors, "canonical_id")
    groups = components(links_of(rows, 1 - distance, params))
    copies = rows.groupBy("k").agg(F.min("id").alias("vector_id"))
    named = with_singletons(copies, "vector_id", groups).withColumn("cluster_id", F.md5("group_id"))
    return rows.join(named.select("k", "cluster_id"), "k").select(F.col("id").alias("canonical_id"), "cluster_id")


def _folded(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(canonical_id, h1, h2) and (h1, h2, embedding): who has which vector, and each distinct vector once; NULL ones are left out."""
    marks = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    rows = vectors.filter(F.col("embedding").isNotNull()).select("canonical_id", "embedding", *marks)
    return rows.drop("embedding"), rows.groupBy("h1", "h2").agg(F.any_value("embedding").alias("embedding"))


def centroids(membership: DataFrame, vectors: DataFrame) -> DataFrame:
    """Mean of the member vectors, each at length 1.

    Members are counted per cluster and distinct vector, so copies of a vector travel as one
    row.  Sums are taken of each batch before the shuffle, and after it along the order of clusters.
    """
    who, each = _folded(vectors)
    counted = membership.join(who, "canonical_id").groupBy("cluster_id", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.join(each, ["h1", "h2"]).select("cluster_id", "n", unit(F.col("embedding")).alias("v"))

    def grouped(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        named = batch["cluster_id"].dictionary_encode(null_encoding="encode")
        own = named.indices.to_numpy(zero_copy_only=False)
        return named.dictionary, own, matrix(batch["v"])

    def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, own, v = grouped(batch)
                n = batch["n"].to_numpy()
                sums, count = np.zeros((len(ids), v.shape[1])), np.zeros(len(ids), np.int64)
                np.add.at(sums, own, v * n[:, None])
                np.add.at(count, own, n)
                yield pa.RecordBatch.from_arrays([ids, pa.array(count), pa.array(list(sums), pa.list_(pa.float64()))], names=["cluster_id", "n", "v"])

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the cluster that the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, own, v = grouped(batch)
            sums, count = np.zeros((len(ids), v.shape[1])), np.zeros(len(ids), np.int64)
            np.add.at(sums, own, v)
            np.add.at(count, own, batch["n"].to_numpy())
            ids = ids.to_pylist()
            if last and ids[0] == last[0]:
                sums[0] += last[2]
                count[0] += last[1]
            elif last:
                ids, sums, count = [last[0], *ids], np.concatenate(([last[2]], sums)), np.concatenate(([last[1]], count))
            last = ids[-1], count[-1], sums[-1]
            yield averaged(ids[:-1], count[:-1], sums[:-1])
        if last:
            yield averaged([last[0]], np.array([last[1]]), np.array([last[2]]))

    def averaged(ids: list, count: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(ids, pa.string()), pa.array(list(sums / count[:, None]), pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(columns, names=["cluster_id", "centroid"])

    partial = rows.mapInArrow(weighted, "cluster_id string, n bigint, v array<double>")
    return partial.repartition("cluster_id").sortWithinPartitions("cluster_id").mapInArrow(means, "cluster_id string, centroid array<double>")


def assign(vectors: DataFrame, centres: DataFrame, distance: float, params: Params = DEFAULT) -> DataFrame:
    """Nearest cluster of each vector when nearer than ``distance``."""
    base = centres.select("cluster_id", F.col("centroid").alias("embedding"))
    found = nearest_above(vectors, base, "canonical_id", "cluster_id", 1 - distance, params=params)
    return found.select("canonical_id", "cluster_id", (1 - F.col("similarity")).alias("distance"))


def sized(membership: DataFrame) -> DataFrame:
    """Add the cluster size: an aggregate joined back, since a window would hold a whole cluster."""
    sizes = membership.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    return membership.join(sizes, "cluster_id")


def flag_micro(membership: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Members of clusters below the least size lose the cluster and become outliers."""
    small = F.col("size") < params.min_cluster_size
    return sized(membership).select(
        "canonical_id", F.when(~small, F.col("cluster_id")).alias("cluster_id"), small.alias("is_outlier")
    )


def merge_micro(membership: DataFrame, vectors: DataFrame, distance: float, params: Params = DEFAULT) -> DataFrame:
    """Members of small clusters move to the nearest large one within ``distance``; else outliers."""
    rows = sized(membership)
    large = rows.filter(F.col("size") >= params.min_cluster_size).select("canonical_id", "cluster_id")
    small = rows.filter(F.col("size") < params.min_cluster_size).select("canonical_id")
    moved = assign(small.join(vectors, "canonical_id"), centroids(large, vectors), distance, params)
    settled = small.join(moved.select("canonical_id", "cluster_id"), "canonical_id", "left")
    return large.select("*", F.lit(False).alias("merged")).unionByName(
        settled.select("canonical_id", "cluster_id", F.col("cluster_id").isNotNull().alias("merged"))
    ).withColumn("is_outlier", F.col("cluster_id").isNull())


def update(
    membership: DataFrame, known: DataFrame, new: DataFrame, distance: float, params: Params = DEFAULT
) -> DataFrame:
    """Keep the stored clusters, add new canonicals to the nearest, group the leftovers."""
    near = assign(new, centroids(membership, known), distance, params).select("canonical_id", "cluster_id")
    left = new.join(near.select("canonical_id"), "canonical_id", "left_anti")
    fresh = link_clusters(left, distance, params)
    return (
        membership.select("canonical_id", "cluster_id", F.lit("kept").alias("origin"))
        .unionByName(near.withColumn("origin", F.lit("assigned")))
        .unionByName(fresh.withColumn("origin", F.lit("formed")))
    )


def assemble(membership: DataFrame, canonicals: DataFrame) -> DataFrame:
    """One bounded row per cluster: size, mentions, first and last episode."""
    return (
        membership.join(canonicals, "canonical_id")
        .groupBy("cluster_id")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.sum("mentions").alias("mentions"),
            F.min(F.struct("first_seq", "first_seen_episode")).alias("lo"),
            F.max(F.struct("last_seq", "last_seen_episode")).alias("hi"),
        )
        .select(
            "cluster_id",
            "size",
            "mentions",
            F.col("lo.first_seen_episode").alias("created_episode"),
            F.col("hi.last_seen_episode").alias("last_updated_episode"),
        )
    )


def member_lists(membership: DataFrame, members: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """source utterances and quotes per cluster in pages, by belief."""
    rows = membership.join(members, "canonical_id")
    return pages(
        rows,
        ["cluster_id"],
        "belief_id",
        params.page_size,
        {
            "canonical_ids": F.col("canonical_id"),
            "source_utterance_ids": F.col("utterance_id"),
            "example_quotes": F.col("original_quote"),
        },
    )


def names(membership: DataFrame, vectors: DataFrame, canonicals: DataFrame, centres: DataFrame) -> DataFrame:
    """Cluster name: text of the member nearest to the centroid, then of the smallest id."""
    who, each = _folded(vectors)
    near = F.round(dot(unit(F.col("embedding")), unit(F.col("centroid"))), 9)
    # copies of a vector are as near as each other, so the smallest id stands for them
    least = (
        membership.join(canonicals.select("canonical_id"), "canonical_id", "left_semi")
        .join(who, "canonical_id")
        .groupBy("cluster_id", "h1", "h2")
        .agg(F.min("canonical_id").alias("canonical_id"))
    )
    best = (
        least.join(each, ["h1", "h2"])
        .join(centres, "cluster_id")
        .groupBy("cluster_id")
        .agg(F.min(F.struct((-near).alias("far"), "canonical_id"))["canonical_id"].alias("canonical_id"))
    )
    return (
        best.join(canonicals.select("canonical_id", "canonical_text"), "canonical_id")
        .groupBy("cluster_id")
        .agg(F.min(F.struct("canonical_text"))["canonical_text"].alias("name"))
    )


def bisecting(vectors: DataFrame, k: int, params: Params = DEFAULT) -> DataFrame:
    """Top-down alternative: bisecting k-means on unit vectors, ``k`` leaves."""
    from pyspark.ml.clustering import BisectingKMeans
    from pyspark.ml.functions import array_to_vector

    rows = vectors.select("canonical_id", array_to_vector(unit(F.col("embedding"))).alias("features"))
    model = BisectingKMeans(k=k, seed=params.seed, distanceMeasure="cosine").fit(rows)
    return model.transform(rows).select("canonical_id", F.col("prediction").alias("leaf"))


def metrics(membership: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Clusters kept, their mean size, and the number of small ones."""
    small = F.col("size") < params.min_cluster_size
    sizes = membership.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(
        F.count_if(~small).alias("clusters_total"),
        F.avg(F.when(~small, F.col("size"))).alias("avg_cluster_size"),
        F.count_if(small).alias("micro_clusters_filtered"),
    )
