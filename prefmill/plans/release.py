"""Training plans, packages and releases made from the given tables, with flaws that follow from each row's key."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.operators import release
from prefmill.plans.registry import query, table

SETTINGS_SQL = {
    tier: "'{' || " + " || ',' || ".join(
        f"'\"{name}\":' || " + {
            "iterations": "iterations::VARCHAR", "stepsPerReport": "CASE WHEN iterations <= 10 THEN '1' ELSE '20' END", "stepsPerEval": "CASE WHEN iterations <= 10 THEN '5' ELSE '100' END",
            "stepsPerSave": "greatest(5, least(100, iterations))::VARCHAR",
        }.get(name, f"'{json.dumps({**release.COMMON, **own}.get(name))}'")
        for name in sorted({*release.COMMON, *own, "iterations", "stepsPerReport", "stepsPerEval", "stepsPerSave"})
    ) + " || '}'"
    for tier, own in release.TIERS.items()
}


@query(
    "training_plans",
    f"""
SELECT run, hyperparameters, cap, issues, CASE WHEN issues = '' THEN sha256(concat_ws(chr(10), tier, 'r' || run % 9, sha256('d' || run), '16031', hyperparameters)) END AS identity
FROM (SELECT c_custkey AS run, tier, CASE tier WHEN 'lite' THEN {SETTINGS_SQL["lite"]} WHEN 'pro' THEN {SETTINGS_SQL["pro"]} END AS hyperparameters, CASE tier WHEN 'lite' THEN 67108864 WHEN 'pro' THEN 1000000000 END AS cap,
    concat_ws(',', CASE WHEN tier = 'mega' THEN 'tier' END, CASE WHEN iterations <= 0 THEN 'iterations' END, CASE WHEN c_custkey % 9 = 4 THEN 'base-revision' END, CASE WHEN c_custkey % 7 = 5 OR c_custkey % 8 = 3 THEN 'dataset-status' END) AS issues
  FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 4 THEN 'mega' WHEN 3 THEN 'pro' WHEN 2 THEN 'pro' ELSE 'lite' END AS tier, c_custkey % 130 - 2 AS iterations FROM customer))
""",
)
def _plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    runs = table(spark, sf_dir, "customer").select(
        k.alias("run"), F.when(k % 5 == 4, "mega").when(k % 5 >= 2, "pro").otherwise("lite").alias("tier"), (k % 130 - 2).alias("iterations"), F.lit(16031).alias("seed"),
        F.concat(F.lit("r"), (k % 9).cast("string")).alias("revision"), F.when(k % 9 == 4, "other").otherwise(F.concat(F.lit("r"), (k % 9).cast("string"))).alias("pinned"),
        F.when(k % 7 == 5, "draft").when(k % 8 == 3, F.lit(None)).otherwise(release.READY).alias("dataset_status"), F.sha2(F.concat(F.lit("d"), k.cast("string")), 256).alias("dataset_sha256"),
    )
    plans = release.training_plans(runs)
    return plans.select("run", "hyperparameters", "cap", F.array_join("issues", ",").alias("issues"), "identity")


def _packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A package for each source, its documents being its files; those of every eighth document are weights."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("t"))
    k = F.col("doc_id")
    name = F.concat(F.when(k % 89 == 88, "../").otherwise(""), F.lit("f"), k.cast("string"), F.when((k % 8 == 0) & (F.col("source") != "src7"), ".gguf").otherwise(".json"))
    listed = docs.select(F.col("source").alias("package"), name.alias("path"), F.octet_length("t").cast("bigint").alias("bytes"), F.sha2("t", 256).alias("sha256"), "doc_id")
    there = listed.where("doc_id % 53 <> 1")
    there = there.withColumns({"bytes": F.when(k % 59 == 2, F.col("bytes") + 1).otherwise(F.col("bytes")), "sha256": F.when(k % 61 == 3, "x").otherwise(F.col("sha256"))})
    twice = listed.where("doc_id % 67 = 4")
    return release.packages(listed.unionByName(twice).drop("doc_id"), there.drop("doc_id"), cap=60_000)


FILE_SQL = """
(SELECT source, doc_id, CASE WHEN doc_id % 89 = 88 THEN '../' ELSE '' END || 'f' || doc_id || CASE WHEN doc_id % 8 = 0 AND source <> 'src7' THEN '.gguf' ELSE '.json' END AS path, strlen(coalesce(text, ''))::BIGINT AS bytes,
    CASE WHEN doc_id % 89 = 88 THEN 'unsafe' WHEN doc_id % 67 = 4 THEN 'duplicate' WHEN doc_id % 53 = 1 THEN 'missing' WHEN doc_id % 59 = 2 THEN 'size' WHEN doc_id % 61 = 3 THEN 'hash' END AS status,
    CASE WHEN doc_id % 67 = 4 THEN 2 ELSE 1 END AS times FROM documents)
"""
PACKAGE_SQL = f"""
(SELECT source AS package, sum(times)::BIGINT AS files, sum(bytes * times)::BIGINT AS bytes, coalesce(sum(times) FILTER (path LIKE '%.gguf'), 0)::BIGINT AS weights,
    concat_ws(',', string_agg('file-' || status || ':' || path, ',' ORDER BY 'file-' || status || ':' || path) FILTER (status IS NOT NULL),
        CASE WHEN count(*) FILTER (path LIKE '%.gguf') = 0 THEN 'no-weights' END, CASE WHEN max(bytes) FILTER (path LIKE '%.gguf') >= 60000 THEN 'weights-cap' END) AS issues FROM {FILE_SQL} GROUP BY source)
"""


@query("package_manifests", f"SELECT * FROM {PACKAGE_SQL}")
def _manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packages(spark, sf_dir).withColumn("issues", F.array_join("issues", ","))


PROTOCOLS = {"strict-v1": "strict", "schema-v1": "schema"}
REPORT_SQL = """
(SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN 'lite' ELSE 'pro' END || s_suppkey // 3 AS tier, CASE s_suppkey % 3 WHEN 0 THEN 'strict' WHEN 1 THEN 'schema' ELSE 'evaluation' END AS label, s_suppkey % 10 <> 7 AS passed FROM supplier)
"""


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comparison for each supplier."""
    k = F.col("s_suppkey")
    tier = F.concat(F.when(k % 4 == 0, "lite").otherwise("pro"), F.floor(k / 3).cast("string"))
    protocol = F.when(k % 3 == 0, "strict-v1").when(k % 3 == 1, "schema-v1").otherwise("other")
    report = F.concat(
        F.lit('{"status":"'), F.when(k % 10 == 7, "fail").otherwise("pass"), F.lit('","base":{"passCount":'), k.cast("string"), F.lit(',"secret":1,"peakMemoryGb":null},"adapter":{"tier":"'), tier, F.lit('","protocol":"'),
        protocol, F.lit('","passRate":0.5,"issueCount":'), (k % 6).cast("string"), F.lit("}}"),
    )
    return table(spark, sf_dir, "supplier").select(report.alias("report"))


@query(
    "release_comparisons",
    f"""
SELECT tier || '-' || label AS id, tier, '{{"passCount":' || k || '}}' AS base, '{{"issueCount":' || k % 6 || ',"passRate":0.5,"protocol":"' || CASE label WHEN 'strict' THEN 'strict-v1' WHEN 'schema' THEN 'schema-v1' ELSE 'other' END || '"}}' AS adapter,
    concat_ws(',', CASE WHEN NOT passed THEN 'failed' END, CASE WHEN count(*) OVER (PARTITION BY tier, label) > 1 THEN 'twice' END) AS issues FROM {REPORT_SQL}
""",
)
def _comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = release.comparisons(_reports(spark, sf_dir), PROTOCOLS)
    return rows.select("id", "tier", "base", "adapter", F.array_join("issues", ",").alias("issues"))


@query(
    "release_issues",
    f"""
SELECT 'package' AS kind, package AS id, unnest(string_split(issues, ',')) AS issue FROM {PACKAGE_SQL} WHERE issues <> ''
UNION ALL SELECT 'comparison', tier || '-' || label, 'failed' FROM {REPORT_SQL} WHERE NOT passed
UNION ALL SELECT 'dataset', 'dataset', 'dataset-status'
""",
)
def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.release(_packages(spark, sf_dir), release.comparisons(_reports(spark, sf_dir), PROTOCOLS), "draft")
