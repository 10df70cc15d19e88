"""Attempt logs and JSON texts: the events table (user = task, events in time = attempts, error = failure)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.functions import json as J
from prefmill.operators import admission, evaluate
from prefmill.plans.registry import query, table

#: Three forms of each event's JSON: whole, with text after it, and inside a list.
TEXT_SQL = "CASE event_id % 4 WHEN 0 THEN props || ' and more' WHEN 1 THEN '[' || props || ']' WHEN 2 THEN 'so: ' || props || ' ok' ELSE props END"


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id") % 4
    made = (
        F.when(n == 0, F.concat("props", F.lit(" and more"))).when(n == 1, F.concat(F.lit("["), "props", F.lit("]")))
        .when(n == 2, F.concat(F.lit("so: "), "props", F.lit(" ok"))).otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select("event_id", "props", made.alias("text"))


@query(
    "json_parse_codes",
    f"SELECT event_id, CASE WHEN NOT json_valid(t) THEN 'invalid-json' WHEN json_type(t) <> 'OBJECT' THEN 'root-not-object' ELSE '' END AS code FROM (SELECT event_id, {TEXT_SQL} AS t FROM events)",
)
def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("event_id", F.array_join(J.parse_codes(F.col("text")), ",").alias("code"))


@query("extract_object", "SELECT event_id, CASE WHEN event_id % 4 = 1 THEN NULL ELSE props END AS found FROM events")
def _extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("event_id", J.extract_object(F.col("text")).alias("found"))


@query(
    "json_types",
    """
SELECT event_id, CASE WHEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') THEN 'integer' ELSE lower(json_type(props, '$.k')) END AS kind,
       coalesce(json_type(props, '$.none'), 'absent') AS missing FROM events
""",
)
def _types(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = J.value(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", J.kind(J.get(v, "$.k")).alias("kind"), F.coalesce(J.kind(J.get(v, "$.none")), F.lit("absent")).alias("missing"))


@query("exact_keys", "SELECT event_id, 'missing-key:a,missing-key:b,extra-key:k' AS codes FROM events")
def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = J.keys(J.value(F.col("props")))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(J.exact_keys(keys, ["b", "a"]), ",").alias("codes"))


#: A task's content hash in the log changes for every tenth document.
HASH_SQL = "sha256(doc_id::VARCHAR || ':' || CASE WHEN doc_id % 10 = 0 THEN 'old' ELSE lang END)"


def logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Prior rows (labelled documents, some with an outdated hash) and current tasks (all documents)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    digest = lambda c: F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit(":"), c), 256)
    old = docs.join(table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id", "quality", digest(F.when(F.col("doc_id") % 10 == 0, "old").otherwise(F.col("lang"))).alias("hash")
    )
    return old, docs.select("doc_id", digest(F.col("lang")).alias("hash"))


@query("resume_retained", "SELECT l.doc_id, l.quality FROM labels l JOIN documents d USING (doc_id) WHERE doc_id % 10 <> 0")
def _retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, now = logs(spark, sf_dir)
    return admission.retained(old, now, "doc_id").select("doc_id", "quality")


@query("resume_pending", "SELECT doc_id FROM documents WHERE doc_id % 10 = 0 OR doc_id NOT IN (SELECT doc_id FROM labels)")
def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, now = logs(spark, sf_dir)
    return admission.pending(now, admission.retained(old, now, "doc_id"), "doc_id").select("doc_id")


@query(
    "latest_evidence",
    "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", F.struct("ts", "event_id").alias("ord"), "event_id", "event_type")
    return admission.latest(rows, "user_id").select("user_id", "event_id", "event_type")


@query(
    "first_success",
    """
SELECT user_id, count(*) AS attempts, min(CASE WHEN event_type <> 'error' THEN attempt END) AS success_at, max(attempt) AS last_attempt FROM (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS attempt FROM events) WHERE attempt < 3 GROUP BY user_id
""",
)
def _first(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import window as W

    rank = F.row_number().over(W.Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    rows = table(spark, sf_dir, "events").select("user_id", (F.col("event_type") != "error").alias("ok"), rank.cast("bigint").alias("attempt"))
    return admission.first_success(rows, "user_id")


@query(
    "zip_strict",
    """
SELECT coalesce(a.doc_id, b.doc_id) AS ord, a.doc_id AS fixture_id, b.doc_id AS result_id, a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL AS ok
FROM documents a FULL OUTER JOIN labels b ON a.doc_id = b.doc_id
""",
)
def _zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = lambda t: table(spark, sf_dir, t).select(F.col("doc_id").alias("ord"), F.col("doc_id").alias("id"))
    return evaluate.zip_strict(side("documents"), side("labels"))
