"""From raw documents to packed training sequences, stage by stage.

Each stage gets the documents its predecessor kept and returns those it keeps, with
the columns of ``documents``; the last returns pieces of sequences.

1. language: documents whose language cannot be told (no text, no letter) go.
2. near copies: of documents linked by 5-word shingles at 0.8 or more, directly or by
   way of others, the one with the smallest doc_id stays.
3. mix: sources are taken at weights 3, 1, 2 in turn, up to twice over; a document
   comes as often as it is taken.
4. packing: documents are tokenized, cut and packed into sequences of 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimweave.llm import langid, mixing, packing, partenum
from claimweave.llm.base import limited, saved, table
from claimweave.llm.queries import word_bpe
from claimweave.session import tune

# the workers of the last stage still hold memory of those before it: texts encoded at once, words remembered
BLOCK_BYTES, REMEMBERED = 1 << 20, 200_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    limited(tune(spark))
    return langid.with_language(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    limited(tune(spark))
    return partenum.without_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    limited(tune(spark))
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    limited(tune(spark))
    return packing.pack_documents(docs, word_bpe(), BLOCK_BYTES, REMEMBERED)


STAGES = [("language", language), ("near_copies", near_copies), ("mix", mix), ("sequences", sequences)]

# the language model is beyond SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
