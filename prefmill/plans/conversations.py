"""Message arrays: prompts, roles, lengths and generation settings, over the conversations table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.functions.text import chat_prompt
from prefmill.operators import admission, audit
from prefmill.plans.registry import query, table


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, messages: turns in order."""
    turns = table(spark, sf_dir, "conversations")
    one = F.struct("turn", "role", F.col("text").alias("content"))
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


@query(
    "length_percentiles",
    """
SELECT role, count(*) AS n, min(length(text))::BIGINT AS min_len, quantile_disc(length(text), 0.5)::BIGINT AS median_len,
       quantile_disc(length(text), 0.95)::BIGINT AS p95_len, max(length(text))::BIGINT AS max_len FROM conversations GROUP BY role
""",
)
def _percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("role", F.length("text").alias("len"))
    return audit.length_summary(rows, "len", "role")


PRICE_SHARES = {"p10": 0.1, "p50": 0.5, "p99": 0.99, "most": 0}


@query(
    "price_percentiles",
    """
WITH r AS (SELECT l_returnflag, l_extendedprice * (1 - l_discount) - 30000 AS v FROM lineitem),
o AS (SELECT l_returnflag, v, row_number() OVER (PARTITION BY l_returnflag ORDER BY v) AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM r)
SELECT l_returnflag, max(n) AS n, max(v) FILTER (i = ceil(0.1::DOUBLE * n)) AS p10, max(v) FILTER (i = ceil(0.5::DOUBLE * n)) AS p50, max(v) FILTER (i = ceil(0.99::DOUBLE * n)) AS p99, max(v) AS most
FROM o GROUP BY l_returnflag
""",
)
def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) - 30000
    return audit.ranks(table(spark, sf_dir, "lineitem").select("l_returnflag", net.alias("v")), "v", "l_returnflag", PRICE_SHARES)


@query("category_maxima", "SELECT role, max(length(text))::BIGINT AS max_len FROM conversations GROUP BY role")
def _maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.maxima(table(spark, sf_dir, "conversations").select("role", F.length("text").alias("len")), "len", "role")


@query(
    "chat_prompt",
    """
SELECT conv_id, string_agg('<|turn>' || CASE WHEN role = 'assistant' THEN 'model' ELSE role END || chr(10)
       || regexp_replace(text, '^\\s+|\\s+$', '', 'g') || '<turn|>' || chr(10), '' ORDER BY turn) || '<|turn>model' || chr(10) AS prompt
FROM conversations GROUP BY conv_id
""",
)
def _prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(spark, sf_dir).select("conv_id", chat_prompt(F.col("messages")).alias("prompt"))


@query(
    "shared_prompt",
    """
SELECT conv_id, n >= 2 AND last_role = 'assistant' AS shared FROM (
  SELECT conv_id, count(*) AS n, arg_max(role, turn) AS last_role FROM conversations GROUP BY conv_id)
""",
)
def _shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations(spark, sf_dir)
    # the rejected side: another last answer after the same turns
    other = F.struct(F.element_at("messages", -1)["role"].alias("role"), F.lit("no").alias("content"))
    rejected = F.concat(F.slice("messages", 1, F.size("messages") - 1), F.array(other))
    return rows.select("conv_id", audit.shared_prompt(F.col("messages"), rejected).alias("shared"))


@query(
    "role_check",
    "SELECT conv_id, bool_and(role IN ('system', 'user', 'assistant')) AS ok FROM conversations GROUP BY conv_id",
)
def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(spark, sf_dir).select("conv_id", audit.role_check(F.col("messages")).alias("ok"))


@query(
    "append_message",
    """
SELECT conv_id, count(*)::INT + 1 AS n, 'assistant' AS role, '{"answer":"n' || count(*) || '","turns":' || count(*) || '}' AS content
FROM conversations GROUP BY conv_id
""",
)
def _append(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.size("messages")
    answer = F.struct(F.concat(F.lit("n"), n.cast("string")).alias("answer"), n.alias("turns"))
    rows = conversations(spark, sf_dir).select("conv_id", admission.append_message(F.col("messages"), answer).alias("m"))
    last = F.element_at("m", -1)
    return rows.select("conv_id", F.size("m").alias("n"), last["role"].alias("role"), last["content"].alias("content"))


@query(
    "token_budget",
    """
SELECT conv_id, turn, CASE conv_id % 3 WHEN 0 THEN 1900 WHEN 1 THEN CASE WHEN turn = 0 THEN 400 ELSE 700 END ELSE 700 END AS budget FROM conversations
""",
)
def _budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("conv_id") % 3 == 0, "lesson-kernel-json-v1").when(F.col("conv_id") % 3 == 1, "schedule-json-v1").otherwise("tutor-json-v1")
    rows = table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", admission.token_budget(kind, F.col("turn")).alias("budget"))


@query(
    "position_seed",
    """
SELECT doc_id, pos, 16031 + pos * 7 + 1 AS generation, 24017 + pos + 100000 AS critic, 32003 + pos AS evaluation
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)
""",
)
def _seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = admission.positions(table(spark, sf_dir, "documents"), "doc_id")
    pos, one = F.col("pos"), F.lit(1)
    return rows.select(
        "doc_id", "pos", admission.generation_seed(pos, one).alias("generation"), admission.critic_seed(pos, one).alias("critic"),
        admission.evaluation_seed(pos).alias("evaluation"),
    )


LINE_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "line_positions",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, row_number() OVER (ORDER BY {', '.join(LINE_ORDER)}) - 1 AS pos FROM lineitem",
)
def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = admission.positions(table(spark, sf_dir, "lineitem"), LINE_ORDER)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "pos")


@query("head_limit", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 32")
def _head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.head(table(spark, sf_dir, "documents").select("doc_id", "lang"), 32, "doc_id")
