"""The corpus pipeline: five stages over ``documents``, each a written table that the next one reads.

1. quality: documents that the weak-label scorer rejects go.
2. toxicity: documents that the toxicity model rejects go (it learns from ``labels`` outside the held-out third).
3. near_dedup: one document of each class of equal or nearly equal texts stays.
4. secrets: found secrets are replaced in the text by their kind in brackets; every document stays.
5. packing: the texts' token pieces and their places in training sequences (one row a piece).

All but the last return the columns of ``documents``. Stages learn from their own input, all of it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from edustar.llm import order_minhash, packing, quality, secret_scan, toxicity
from edustar.llm.store import importable_by_workers, stored


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable_by_workers(spark)
    return quality.drop_low_quality(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable_by_workers(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable_by_workers(spark)
    return order_minhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable_by_workers(spark)
    return secret_scan.redact_documents(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable_by_workers(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", drop_low_quality),
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; each stage's rows are written and read again."""
    importable_by_workers(spark)
    sf_dir = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages hold trained models and tokenizers, which SQL cannot express; tests/llm checks each stage.
ORACLE_SQL = None
