"""File inventories: what lies in a folder, and whether it is what a manifest says."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.sources.records import file_records

#: Size limits of packages in bytes.
PACKAGE_MOST = 1_000_000_000
BROWSER_MOST = 64 * 1024 * 1024
BROWSER_SHARE_OF_BASE = 0.02


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, bytes, sha256) of every file below path, by its name relative to path.

    Files are hashed in chunks where they are read (``records``), whatever their size; a link, an empty file and one outside
    path stop it. A store that only Spark can open is read through its binary files, each whole in a row.
    """
    if re.match(r"(file|hdfs|s3|gs|abfss?):|[^:]*$", path):
        return file_records(spark, path, pattern).select("path", "bytes", "sha256")
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    root = path.rstrip("/").rsplit("/", 1)[-1]
    name = F.substring_index("path", f"/{root}/", -1)
    whole = F.when(F.col("length") > 0, F.col("length")).otherwise(F.raise_error(F.concat(F.lit("not a regular nonempty file: "), F.col("path"))))
    return files.select(name.alias("path"), whole.alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, status): ok, missing, size, hash, duplicate or unsafe for each path of a manifest."""
    have = actual.groupBy("path").agg(F.min("bytes").alias("b"), F.min("sha256").alias("s"))
    times = expected.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("bytes").alias("bytes"), F.min("sha256").alias("sha256"))
    unsafe = F.col("path").startswith("/") | F.array_contains(F.split("path", "/"), "..")
    status = (
        F.when(unsafe, "unsafe").when(F.col("n") > 1, "duplicate").when(F.col("b").isNull(), "missing")
        .when(F.col("b") != F.col("bytes"), "size").when(F.col("s") != F.col("sha256"), "hash").otherwise("ok")
    )
    return times.join(have, "path", "left").select("path", status.alias("status"))


def size_caps(files: DataFrame, caps: Mapping[str, int]) -> DataFrame:
    """(cap, total_bytes, ok): the sum of all sizes against each cap."""
    pairs = F.array(*[F.struct(F.lit(k).alias("cap"), F.lit(int(v)).cast("bigint").alias("most")) for k, v in caps.items()])
    total = files.agg(F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("total_bytes"))
    return total.select("total_bytes", F.inline(pairs)).select("cap", "total_bytes", (F.col("total_bytes") < F.col("most")).alias("ok"))


def pair_completeness(names: DataFrame, name: str = "name", sides: tuple[str, str] = ("lora_a", "lora_b")) -> DataFrame:
    """(stem, sides, complete): tensor names grouped by what stands before the side."""
    pattern = rf"^(.*)\.({'|'.join(sides)})$"
    parts = names.select(F.regexp_extract(name, pattern, 1).alias("stem"), F.regexp_extract(name, pattern, 2).alias("side")).where("side <> ''")
    found = parts.groupBy("stem").agg(F.array_join(F.array_sort(F.collect_set("side")), ",").alias("sides"))
    return found.withColumn("complete", F.col("sides") == ",".join(sorted(sides)))
