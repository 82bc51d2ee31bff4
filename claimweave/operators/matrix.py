"""Episode x canonical weights: sparse cells, lookups, dense blocks, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.ordered import id_prefix, numbered, pages
from claimweave.operators.registry import upsert
from claimweave.params import DEFAULT, Params


def weights(mentions: DataFrame) -> DataFrame:
    """Mean confidence, mentions and stability of each canonical in each episode it occurs in.

    Confidences lie in [0, 1], so their standard deviation is at most 0.5 and
    1 - 2*stddev lies in [0, 1].
    """
    return mentions.groupBy("episode_id", "canonical_id").agg(
        F.min("episode_seq").alias("episode_seq"),
        F.avg("confidence").alias("conviction_avg"),
        F.count(F.lit(1)).alias("frequency"),
        F.greatest(F.lit(0.0), 1 - 2 * F.stddev_pop("confidence")).alias("stability_score"),
        F.lit(True).alias("presence_flag"),
    )


def dimensions(cells: DataFrame, episodes: DataFrame) -> DataFrame:
    """All episodes count, those without a cell too."""
    beliefs = cells.agg(F.countDistinct("canonical_id").alias("n_beliefs"))
    many = episodes.agg(F.countDistinct("episode_id").alias("n_episodes"))
    return many.select("n_episodes", beliefs.scalar().alias("n_beliefs")).withColumn(
        "dimensions", F.format_string("%dx%d", "n_episodes", "n_beliefs")
    )


def lookup(requests: DataFrame, cells: DataFrame) -> DataFrame:
    """Cell of each requested (episode_id, canonical_id); NULL where absent."""
    return requests.join(cells.drop("episode_seq"), ["episode_id", "canonical_id"], "left")


def upsert_cells(cells: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    return upsert(cells, new, ["episode_id", "canonical_id"], seq)


def _columns(cells: DataFrame, params: Params) -> DataFrame:
    """(canonical_id, block_no): the block of columns that each canonical is in."""
    ids = cells.select("canonical_id").distinct()
    return numbered(ids, [], ["canonical_id"], id_prefix("canonical_id"), "_no").select(
        "canonical_id", F.floor((F.col("_no") - 1) / params.max_columns).cast("int").alias("block_no")
    )


def _column_ids(placed: DataFrame) -> DataFrame:
    return placed.groupBy("block_no").agg(F.array_sort(F.collect_list("canonical_id")).alias("canonical_ids"))


def dense_blocks(episodes: DataFrame, cells: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The full matrix, one row per episode and block of columns.

    Absent cells hold (0.0, 0, 0.0, false).  A row has at most ``max_columns``
    cells, so neither a task nor a row ever holds a whole matrix line.  The grid of
    episodes and blocks meets its cells before it gets the ids of its columns, so only
    narrow rows are shuffled; it is merged, never broadcast, since the planner takes it
    for as small as the table of episodes.  Only exports need this; everything else
    works on the sparse cells.
    """
    placed = _columns(cells, params)
    last = placed.agg(F.max("block_no").alias("m")).scalar()
    filled = (
        cells.join(placed, "canonical_id")
        .groupBy("episode_id", "block_no")
        .agg(
            F.map_from_entries(
                F.collect_list(
                    F.struct("canonical_id", F.struct("conviction_avg", "frequency", "stability_score", "presence_flag"))
                )
            ).alias("_cells")
        )
    )
    none = F.struct(
        F.lit(0.0).alias("conviction_avg"),
        F.lit(0).cast("bigint").alias("frequency"),
        F.lit(0.0).alias("stability_score"),
        F.lit(False).alias("presence_flag"),
    )
    return (
        episodes.select("episode_id", F.explode(F.sequence(F.lit(0), last)).alias("block_no"))
        .join(filled.hint("merge"), ["episode_id", "block_no"], "left")
        .join(_column_ids(placed).hint("merge"), "block_no")
        .select(
            "episode_id",
            "block_no",
            "canonical_ids",
            F.transform("canonical_ids", lambda c: F.coalesce(F.try_element_at("_cells", c), none)).alias("weights"),
        )
    )


def csv_lines(episodes: DataFrame, cells: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The whole matrix as lines of CSV files: (block_no, file_no, line_no, value).

    Every canonical is a column of one block, 0.0 where absent; a block has
    ``max_columns`` of them beside episode_id.  A file holds a part of the episodes
    of one block and starts with a header, line 0.
    """
    files = F.ceil(episodes.agg(F.countDistinct("episode_id").alias("n")).scalar() / params.csv_rows)
    file_no = F.pmod(F.xxhash64("episode_id"), files).cast("int").alias("file_no")
    numbers = F.transform("weights", lambda w: w["conviction_avg"].cast("string"))
    named = F.concat(F.to_csv(F.struct("episode_id")), F.lit(","), F.array_join(numbers, ","))
    rows = dense_blocks(episodes, cells, params).select("block_no", file_no, named.alias("value"))
    # every block has a file for each part of the episodes
    heads = _column_ids(_columns(cells, params)).crossJoin(episodes.select(file_no).distinct()).select(
        "block_no", "file_no", F.lit(0).alias("line_no"), F.concat(F.lit("episode_id,"), F.array_join("canonical_ids", ",")).alias("value")
    )
    return rows.select("block_no", "file_no", F.lit(1).alias("line_no"), "value").unionByName(heads)


def as_json(cells: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Nested weights per episode as JSON text, in pages."""
    weight = F.struct("conviction_avg", "frequency", "stability_score", "presence_flag")
    paged = pages(
        cells, ["episode_id"], "canonical_id", params.page_size, {"ids": F.col("canonical_id"), "cells": weight},
    )
    return paged.select(
        "episode_id", "page_no", F.to_json(F.map_from_arrays("ids", "cells")).alias("weights_json")
    )
