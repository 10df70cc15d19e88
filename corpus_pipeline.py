"""From raw documents to shards: quality, near-duplicates, decontamination, mixing, sharding.

Every stage is (spark, docs, sf_dir) -> DataFrame over what the stage before it kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prefmill.llm import decontaminate, mixing, quality, sharding, simhash_dedup
from prefmill.llm.common import remove, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The mixing stage keeps this share of the tokens left, each document at most once.
MIX_SHARE = 0.9


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts (score of at least 0.3)."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of texts whose 5-word shingles have a Jaccard coefficient of at least 0.8."""
    return simhash_dedup.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its error budget."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a mixture by the target weights of domain, language and source."""
    return mixing.keep_mixed(docs, MIX_SHARE)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return sharding.assign(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: SQL cannot express the classifier's compression; tests hold run() against plain Python instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written and read back for the next.

    A stage's table goes once the next one is written, the last but one when the driver ends.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            remove(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
