"""Streaming forms of resumable work: an append log read as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def attempts(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """The attempt log below path as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def unseen(stream: DataFrame, key: str = "id", digest: str = "hash", at: str | None = None, delay: str = "1 day") -> DataFrame:
    """Each (key, digest) once; with an event time, state older than the delay is dropped."""
    if at is None:
        return stream.dropDuplicates([key, digest])
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key, digest])


def issue_counts(stream: DataFrame, at: str = "ts", window: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Attempts and failures in event-time windows, closed by the watermark."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, window), "category").agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(F.size("issues") > 0).alias("failed")
    )


def write_new(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now to path as Parquet, then stop."""
    return (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
