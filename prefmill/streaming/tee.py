"""A trainer's output as it arrives: every line is kept as it is, and what lines say of the run becomes rows.

Both are written batch by batch, each batch to a folder of its own number that it replaces, so a batch that is run again after a
failure leaves nothing twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: What a line of progress says: column -> (pattern with one group, type).
PROGRESS = {
    "iteration": (r"^Iter (\d+):", "bigint"), "train_loss": (r"(?i)train loss (-?[0-9.]+(?:e-?\d+)?)", "double"), "valid_loss": (r"(?i)val loss (-?[0-9.]+(?:e-?\d+)?)", "double"),
    "tokens_per_second": (r"(?i)tokens/sec (-?[0-9.]+(?:e-?\d+)?)", "double"),
}


def progress(lines: DataFrame, told: Mapping[str, tuple[str, str]] = PROGRESS) -> DataFrame:
    """One row for each line that names an iteration: what it says, null where it says nothing of it."""
    found = {name: F.nullif(F.regexp_extract("value", pattern, 1), F.lit("")).try_cast(kind) for name, (pattern, kind) in told.items()}
    return lines.select(*[c.alias(n) for n, c in found.items()]).where(F.col(next(iter(told))).isNotNull())


def tee(lines: DataFrame, log: str, rows: str, checkpoint: str, told: Mapping[str, tuple[str, str]] = PROGRESS) -> StreamingQuery:
    """Write what is there now of a stream of lines (value) to log as text and to rows as Parquet, then stop."""

    def write(batch: DataFrame, number: int) -> None:
        lines = batch.select("value").persist()
        try:
            lines.write.mode("overwrite").text(f"{log}/batch={number}")
            progress(lines, told).write.mode("overwrite").parquet(f"{rows}/batch={number}")
        finally:
            lines.unpersist()

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def told_so_far(spark: SparkSession, rows: str) -> DataFrame:
    """The rows of all batches."""
    return spark.read.parquet(rows).drop("batch")
