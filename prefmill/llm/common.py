"""Small helpers that the training-data operators share."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.functions.workers import importable

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


#: Bounds of what one Arrow batch of texts holds; without them thousands of long texts would meet in one.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """df, after lowering the session's bounds on Arrow batches to BATCH_ROWS and BATCH_BYTES.

    The bounds stay lowered: plans run after the operator has returned, and a smaller bound changes no result.
    """
    importable(df.sparkSession)
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = (conf.get(name, None) or "").removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            conf.set(name, str(most))
    return df


def text_digest(text: str = "text") -> Column:
    """SHA-256 of a text's UTF-8 bytes, 32 bytes."""
    return F.unhex(F.sha2(F.encode(text_or_empty(text), "UTF-8"), 256))


def boxed(docs: DataFrame) -> Column:
    """All columns of docs in one struct, so that columns added beside it cannot clash with them."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns])


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only, alike in every locale and engine."""
    return F.translate(col, UPPER, LOWER)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which driver and executors share.

    A local session without that setting (tests) gets one on this machine; a cluster without it is an error.
    """
    context = spark.sparkContext
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        held = context._jsc.sc().getCheckpointDir()
        if held.isDefined():
            top = held.get()
        elif re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            top = "file://" + tempfile.mkdtemp(prefix="prefmill-")
            context.setCheckpointDir(top)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{top}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished steps now, not when the driver happens to need memory.

    The first collection frees what Python still held on the JVM side, the second the plans behind it.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df below the shared folder and read it back: lineage ends, lost executors cost nothing.

    The table goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    fs, place = _place(spark, path)
    fs.deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def remove(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        fs, place = _place(df.sparkSession, path)
        fs.delete(place, True)
