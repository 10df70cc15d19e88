"""The attempt log as a stream: what is there is read in micro-batches, written as Parquet and returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.plans.registry import query, table
from prefmill.sources.shared import folder
from prefmill.streaming import resume, retries, tee


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")


def _drained(stream: DataFrame) -> DataFrame:
    spark, top = stream.sparkSession, folder(stream.sparkSession, "stream")
    resume.write_new(stream, f"{top}/rows", f"{top}/state").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{top}/rows")


@query("stream_unseen", "SELECT DISTINCT user_id::VARCHAR AS id, sha256(event_type) AS hash FROM events")
def _unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select(F.col("user_id").cast("string").alias("id"), F.sha2("event_type", 256).alias("hash"))
    return _drained(resume.unseen(rows))


@query(
    "stream_windows",
    """
SELECT date_trunc('hour', ts)::VARCHAR AS start, event_type = 'error' AS category, count(*) AS attempts, count(*) FILTER (value > 50) AS failed FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOURS GROUP BY 1, 2
""",
)
def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = F.filter(F.array(F.when(F.col("value") > 50, "high")), lambda x: x.isNotNull())
    rows = _events(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("category"), issues.alias("issues"))
    closed = _drained(resume.issue_counts(rows))
    return closed.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "category", "attempts", "failed")


def drafting(messages: list[dict[str, str]], settings: dict) -> str:
    """A stand-in model that needs as many drafts as its task says, counting on from the draft that it is shown."""
    need = int(messages[0]["content"].split()[-1])
    done = int(messages[-2]["content"].split()[-1]) + 1 if len(messages) > 1 else 0
    return "final" if done == need else f"draft {done}"


def unfinished(text: str) -> list[str]:
    return [] if text == "final" else [f"unfinished:{text}"]


def _requests(rows: DataFrame) -> DataFrame:
    """Each event asks for an attempt at its user's task."""
    task = F.concat(F.lit("Drafts needed: "), (F.col("user_id") % 4).cast("string"))
    messages = F.array(F.struct(F.lit("user").alias("role"), task.alias("content")))
    return rows.select(F.col("user_id").alias("id"), messages.alias("messages"), (F.lit(16031) + F.col("user_id") * 7).alias("seed"))


@query(
    "stream_attempts",
    """
SELECT id, attempt::INTEGER AS attempt, CASE WHEN attempt = need THEN 'final' ELSE 'draft ' || attempt END AS text,
    CASE WHEN attempt = need THEN '' ELSE 'unfinished:draft ' || attempt END AS issues, 16031 + id * 7 + attempt AS seed
FROM (SELECT user_id AS id, user_id % 4 AS need, count(*) AS n FROM events GROUP BY user_id), range(3) r(attempt)
WHERE attempt < n AND attempt <= need
""",
)
def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log arrives in two parts; the query is stopped after the first and goes on from its state."""
    top = folder(spark, "attempts")
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    for part in (0, 1):
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{top}/events")
        asked = spark.readStream.schema(events.schema).parquet(f"{top}/events")
        retries.start(retries.retried(_requests(asked), drafting, unfinished), f"{top}/rows", f"{top}/state").awaitTermination()
    rows = retries.log(spark, f"{top}/rows")
    return rows.select("id", "attempt", "text", F.array_join("issues", ",").alias("issues"), F.get_json_object("settings", "$.seed").cast("bigint").alias("seed"))


@query(
    "stream_progress",
    """
SELECT event_id AS iteration, CASE WHEN event_id % 3 > 0 THEN value END AS train_loss, CASE WHEN event_id % 3 = 0 THEN value END AS valid_loss, CASE WHEN event_id % 3 = 1 THEN user_id::DOUBLE END AS tokens_per_second
FROM events WHERE event_type <> 'error'
""",
)
def _progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trainer's lines, a line for each event, in two parts; lines that name no iteration are kept in the log alone."""
    top, k = folder(spark, "trainer"), F.col("event_id")
    said = F.concat(
        F.lit("Iter "), k.cast("string"), F.when(k % 3 == 0, ": Val loss ").otherwise(": Train loss "), F.col("value").cast("string"),
        F.when(k % 3 == 1, F.concat(F.lit(", Tokens/sec "), F.col("user_id").cast("string"))).otherwise(""),
    )
    lines = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("warning: Iter "), k.cast("string"))).otherwise(said).alias("value"))
    for part in (0, 1):
        lines.where(k % 2 == part).select("value").write.mode("append").text(f"{top}/out")
        tee.tee(spark.readStream.text(f"{top}/out"), f"{top}/log", f"{top}/rows", f"{top}/state").awaitTermination()
    kept, told = spark.read.text(f"{top}/log").count(), lines.count()
    if kept != told:
        raise ValueError(f"the log has {kept} of {told} lines")
    return tee.told_so_far(spark, f"{top}/rows")
