"""JSON lines and JSON documents: strict readers, and writers with sorted keys."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefmill.functions import json as J
from prefmill.functions.text import strip


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line) of all lines that are not blank."""
    text = spark.read.text(path).select(F.input_file_name().alias("path"), F.col("value").alias("line"))
    return text.where(F.length(strip(F.col("line"))) > 0)


def scan_strict(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, issue): issue is null where the line is one JSON object."""
    codes = J.parse_codes(F.col("line"))
    return lines(spark, path).withColumn("issue", F.get(codes, F.lit(0)))


def read(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Typed rows of JSON lines; a malformed line stops the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_splits(spark: SparkSession, files: dict[str, str], schema: str | T.StructType) -> DataFrame:
    """Rows of several files with the split each stands for."""
    out = None
    for split, path in files.items():
        rows = read(spark, path, schema).withColumn("split", F.lit(split))
        out = rows if out is None else out.unionByName(rows)
    return out


def document(spark: SparkSession, path: str) -> DataFrame:
    """(path, text, issue) of whole JSON documents."""
    text = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    return text.withColumn("issue", F.get(J.parse_codes(F.col("text")), F.lit(0)))


def sorted_json(rows: DataFrame) -> DataFrame:
    """(value): each row as JSON with its columns in order of their names."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("value"))


def write(rows: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines with sorted keys; append adds files to what is there."""
    sorted_json(rows).write.mode("append" if append else "overwrite").text(path)


def receipt(row: dict) -> str:
    """A report as indented JSON with sorted keys and a line end."""
    return json.dumps(row, indent=2, sort_keys=True) + "\n"
