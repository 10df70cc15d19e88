"""Scoring of evaluation results: documents joined with labels stand for result rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.operators import evaluate as E
from prefmill.operators.admission import quarantine
from prefmill.plans.registry import query, table

#: The labelled documents as evaluation results.
RESULTS_SQL = """
SELECT d.doc_id AS id, d.lang AS category, d.source,
       CASE WHEN l.quality = 0 THEN 1 ELSE 0 END + CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END AS n_issues,
       l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, category, source, issues: a result row for each labelled document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels")
    issues = F.filter(
        F.array(
            F.when(F.col("quality") == 0, F.lit("low-quality")),
            F.when(F.col("toxic") == 1, F.lit("toxic")),
        ),
        lambda x: x.isNotNull(),
    )
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("category"), "source", issues.alias("issues")
    )


@query(
    "summarize_by_category",
    f"""
SELECT category, count(*) AS n, count(*) FILTER (n_issues = 0) AS pass_count,
       count(*) FILTER (n_issues = 0) / count(*)::DOUBLE AS pass_rate, sum(n_issues)::BIGINT AS issue_count
FROM ({RESULTS_SQL}) GROUP BY category
""",
)
def _by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.summarize_by_category(results(spark, sf_dir))


def _pass_sql(where: str = "TRUE") -> str:
    return f"""SELECT category, count(*) AS n, count(*) FILTER (n_issues = 0) AS pass_count,
       count(*) FILTER (n_issues = 0) / count(*)::DOUBLE AS pass_rate FROM ({RESULTS_SQL}) WHERE {where} GROUP BY category"""


#: Sources with an even number stand for the base run, odd ones for the candidate.
EVEN_SQL = "substr(source, 4)::INT % 2 = 0"


def runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = results(spark, sf_dir)
    even = F.substring("source", 4, 9).cast("int") % 2 == 0
    return r.where(even), r.where(~even)


@query(
    "summarize_overall",
    f"""
SELECT count(*) AS n, count(*) FILTER (n_issues = 0) AS pass_count,
       coalesce(count(*) FILTER (n_issues = 0) / nullif(count(*), 0)::DOUBLE, 0) AS pass_rate,
       coalesce(sum(n_issues), 0)::BIGINT AS issue_count FROM ({RESULTS_SQL})
""",
)
def _overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.summarize_overall(results(spark, sf_dir))


@query(
    "issue_histogram",
    f"""
SELECT issue, count(*) AS n FROM (
  SELECT 'low-quality' AS issue FROM ({RESULTS_SQL}) WHERE quality = 0
  UNION ALL SELECT 'toxic' FROM ({RESULTS_SQL}) WHERE toxic = 1) GROUP BY issue
""",
)
def _histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.issue_histogram(results(spark, sf_dir))


@query(
    "compare_categories",
    f"""
SELECT coalesce(a.category, b.category) AS category, coalesce(a.pass_rate, 0) AS base_rate, coalesce(b.pass_rate, 0) AS candidate_rate,
       coalesce(b.pass_rate, 0) < coalesce(a.pass_rate, 0) AS regressed
FROM ({_pass_sql(EVEN_SQL)}) a FULL OUTER JOIN ({_pass_sql(f"NOT ({EVEN_SQL})")}) b ON a.category = b.category
""",
)
def _compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.compare_categories(*runs(spark, sf_dir))


def _run_sql(where: str) -> str:
    return f"""SELECT count(*) AS n, count(*) FILTER (n_issues = 0) / count(*)::DOUBLE AS pass_rate, sum(n_issues)::BIGINT AS issue_count,
       count(*) FILTER (toxic = 1) AS kind, string_agg(id::VARCHAR, ',' ORDER BY id::VARCHAR) AS ids FROM ({RESULTS_SQL}) WHERE {where}"""


@query(
    "promotion_compare",
    f"""
WITH b AS ({_run_sql(EVEN_SQL)}), c AS ({_run_sql(f"NOT ({EVEN_SQL})")}),
lost AS (SELECT count(*) AS n FROM ({_pass_sql(EVEN_SQL)}) a FULL OUTER JOIN ({_pass_sql(f"NOT ({EVEN_SQL})")}) d ON a.category = d.category
         WHERE coalesce(d.pass_rate, 0) < coalesce(a.pass_rate, 0)),
x AS (SELECT b.ids = c.ids AND b.n = 32 AND c.n = 32 AS same_fixtures, c.pass_rate > b.pass_rate AS pass_rate_up,
             c.issue_count < b.issue_count AS issues_down, lost.n = 0 AS no_regression, c.kind <= b.kind AS kind_not_up,
             c.pass_rate - b.pass_rate AS pass_rate_delta, c.issue_count - b.issue_count AS issue_delta FROM b, c, lost)
SELECT *, CASE WHEN same_fixtures AND pass_rate_up AND issues_down AND no_regression AND kind_not_up THEN 'pass' ELSE 'fail' END AS status FROM x
""",
)
def _promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.promotion(*runs(spark, sf_dir), kind="toxic")


@query("admitted_by_category", f"SELECT category, count(*) AS n FROM ({RESULTS_SQL}) WHERE n_issues = 0 GROUP BY category")
def _admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = results(spark, sf_dir).where(F.size("issues") == 0)
    return good.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "admission_rate",
    """
SELECT count(*) AS requested, count(*) FILTER (quality = 1) AS admitted, count(*) FILTER (quality = 0) AS excluded,
       coalesce(count(*) FILTER (quality = 1) / nullif(count(*), 0)::DOUBLE, 0) AS rate FROM labels
""",
)
def _rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.admission_rate(table(spark, sf_dir, "labels"), F.col("quality") == 1)


@query(
    "quarantine",
    """
SELECT doc_id, 'oracle' AS stage FROM labels WHERE quality = 0
UNION ALL SELECT doc_id, 'critic' FROM labels WHERE quality = 1 AND toxic = 1
""",
)
def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    bad = labels.where("quality = 0").select("doc_id")
    return quarantine(bad, labels.where("quality = 1 AND toxic = 1").select("doc_id"))


@query(
    "quality_score",
    """
SELECT doc_id, CASE WHEN n = 0 THEN 1.0 WHEN quality = 0 AND toxic = 1 THEN 0.0 ELSE greatest(0.0, 1 - least(1.0, n / 12.0::DOUBLE)) END::DOUBLE AS score
FROM (SELECT *, (1 - quality) + toxic AS n FROM labels)
""",
)
def _score(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (1 - F.col("quality")) + F.col("toxic")
    fatal = (F.col("quality") == 0) & (F.col("toxic") == 1)
    return table(spark, sf_dir, "labels").select("doc_id", E.quality_score(n, fatal).alias("score"))


@query(
    "run_metrics",
    """
SELECT coalesce(avg(n_chars), 0)::DOUBLE AS mean_tokens, coalesce(avg(doc_id), 0)::DOUBLE AS mean_rate, coalesce(max(n_chars), 0)::DOUBLE AS peak_memory FROM documents
""",
)
def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.run_metrics(table(spark, sf_dir, "documents").select("n_chars", "doc_id"), "n_chars", "doc_id", "n_chars")
