"""The dealt operators as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimweave.llm import chat, infill, itq, langid, mixing, neighbours, packing, partenum, projections, records, repair, ring, tokens
from claimweave.llm.base import limited, table
from claimweave.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op7_chat": chat.DIGEST_SQL, "op9_mixing": mixing.REPORT_SQL, "op11_infill": infill.DIGEST_SQL}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return f(limited(tune(spark)), folder)

    QUERIES[f.__name__] = run
    return run


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.predict_documents(table(spark, folder, "documents"))


@query
def op2_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.count_tokens(table(spark, folder, "documents"), word_bpe())


@query
def op3_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return itq.near_vectors(table(spark, folder, "embeddings"))


@query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return ring.shard_documents(table(spark, folder, "documents"))


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), word_bpe())


@query
def op6_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return partenum.jaccard_groups(table(spark, folder, "documents"))


@query
def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.chat_digests(chat.with_probe(table(spark, folder, "conversations")))


@query
def op8_records(spark: SparkSession, folder: str) -> DataFrame:
    return records.record_digests(table(spark, folder, "documents"), word_bpe())


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(table(spark, folder, "documents"))


@query
def op10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return projections.nearest(table(spark, folder, "embeddings"))


@query
def op11_infill(spark: SparkSession, folder: str) -> DataFrame:
    return infill.infill_digests(table(spark, folder, "documents"))


@query
def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair_report(table(spark, folder, "conversations"))


@query
def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))
