"""The registered queries of the training-data operators, one for each.

Every query applies its operator to the whole table with production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prefmill.llm import (
    decontaminate,
    divergence,
    doc_fingerprints,
    fill_in_middle,
    jaccard_join,
    licenses,
    maxent_lm,
    mixing,
    quality,
    sharding,
    simhash_dedup,
    substring_dedup,
    token_counts,
)
from prefmill.llm.common import documents


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(documents(spark, sf_dir))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.report(documents(spark, sf_dir))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.report(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_doc_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_fingerprints.report(documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(documents(spark, sf_dir))


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir), keep=False)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.context_table(token_counts.histogram(token_counts.token_lengths(documents(spark, sf_dir))))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.report(documents(spark, sf_dir))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_lm_scoring,
        op3_simhash_dedup,
        op4_quality_classifier,
        op5_doc_fingerprints,
        op6_substring_dedup,
        op7_license_scans,
        op8_sharding,
        op9_decontamination,
        op10_token_counts,
        op11_fill_in_middle,
        op12_source_divergence,
        op13_jaccard_join,
    )
}

ORACLES: dict[str, str] = {
    "op7_license_scans": licenses.oracle_sql(),
    "op11_fill_in_middle": fill_in_middle.oracle_sql(),
    "op12_source_divergence": divergence.oracle_sql(),
}
