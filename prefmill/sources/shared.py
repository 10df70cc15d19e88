"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir; a local session without that setting gets one on this machine."""
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


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back, so that what made it runs once; it goes when the driver ends."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)
