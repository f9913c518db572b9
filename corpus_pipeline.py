"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and returns a frame that is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import byte_language, latent_retrieval, pattern_packing, pigeonring, secret_cnn
from millrace.llm.common import load, materialize
from millrace.session import prepare


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is known; texts that are null, without letters or without a likely language go."""
    return byte_language.known(docs)


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: four-word shingles, at most four differing bits."""
    return pigeonring.one_of_each(docs, words=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return latent_retrieval.without_leaks(docs, load(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, every secret in their texts masked."""
    return secret_cnn.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in training sequences of 1024 tokens."""
    return pattern_packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_duplicates", simhash_near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Trained networks and singular vectors have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    spark = prepare(spark)
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
