"""Corpus pipeline over ``documents``: toxic documents go, near duplicates keep
one document of each group, repeated passages and secrets are taken out, and
what is left is packed into token sequences.

Each stage reads what the one before it wrote. Stages that edit texts keep all
rows; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import jaccard, packing, repeats, secret_scan, toxicity
from ledgerlens.llm.common import documents, ship, table, written

# Segment search, suffix arrays and packing are beyond SQL; tests/llm holds the
# stages against brute force.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return repeats.remove(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return secret_scan.redact(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("secret scan", without_secrets),
    ("best-fit packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
