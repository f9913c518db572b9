"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    byte_language, contour_whitening, latent_retrieval, maxent_lm, minimax_shards, page_difference, pattern_packing, pigeonring,
    pivot_index, secret_cnn, skip_chain, source_divergence, suffix_dedup)
from millrace.llm.common import load
from millrace.session import prepare

QUERIES = {}
ORACLES: dict[str, str] = {}


def register(build):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(prepare(spark), folder)

    QUERIES[build.__name__] = run
    return run


@register
def op1_page_difference(spark: SparkSession, folder: str) -> DataFrame:
    return page_difference.extract(load(spark, folder, "pages"))


@register
def op2_byte_language(spark: SparkSession, folder: str) -> DataFrame:
    return byte_language.identify(load(spark, folder, "documents"))


@register
def op3_pivot_index(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_index.near_duplicates(load(spark, folder, "embeddings"))


@register
def op4_secret_cnn(spark: SparkSession, folder: str) -> DataFrame:
    return secret_cnn.report(load(spark, folder, "documents"))


@register
def op5_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pattern_packing.pack(load(spark, folder, "documents"))


@register
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(load(spark, folder, "documents"))


@register
def op7_maxent_lm(spark: SparkSession, folder: str) -> DataFrame:
    return maxent_lm.score(load(spark, folder, "documents"))


@register
def op8_minimax_shards(spark: SparkSession, folder: str) -> DataFrame:
    return minimax_shards.shard_by_bytes(load(spark, folder, "documents"))


@register
def op9_latent_retrieval(spark: SparkSession, folder: str) -> DataFrame:
    return latent_retrieval.find_leaks(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


@register
def op10_pigeonring_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return pigeonring.near_duplicates(load(spark, folder, "documents"))


@register
def op11_skip_chain_crf(spark: SparkSession, folder: str) -> DataFrame:
    return skip_chain.report(load(spark, folder, "documents"))


@register
def op12_gustavson_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.audit(load(spark, folder, "documents"))


ORACLES["op12_gustavson_audit"] = source_divergence.SQL


@register
def op13_feast_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return contour_whitening.whiten(load(spark, folder, "embeddings"))
