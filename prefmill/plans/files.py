"""Files, manifests and registries."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.functions import json as J
from prefmill.functions.workers import importable
from prefmill.operators import corpus
from prefmill.plans.registry import query, table
from prefmill.sources import archives, files, gguf, records, registry, seeds
from prefmill.sources.shared import folder


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file list: one entry a source, with the bytes of its texts."""
    docs = table(spark, sf_dir, "documents").select("source", F.octet_length("text").alias("n"))
    rows = docs.groupBy(F.col("source").alias("path")).agg(F.sum("n").cast("bigint").alias("bytes"))
    return rows.withColumn("sha256", F.sha2(F.concat_ws(":", "path", F.col("bytes").cast("string")), 256))


LIST_SQL = "(SELECT source AS path, sum(strlen(text))::BIGINT AS bytes FROM documents GROUP BY source)"


@query("scan_json_strict", "SELECT event_id, event_id % 5 = 0 AS bad FROM events")
def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.when(F.col("event_id") % 5 == 0, F.concat("props", F.lit(","))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", (F.size(J.parse_codes(line)) > 0).alias("bad"))


#: The tables at the scale at which SQL is compared; a test reads another folder instead.
TABLES = "/root/testdata/sf0.01"


@query(
    "file_inventory",
    f"SELECT parse_filename(filename) AS path, octet_length(content) AS bytes, sha256(content) AS sha256 FROM read_blob('{TABLES}/*.parquet')",
)
def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.inventory(spark, sf_dir, "*.parquet")


@query(
    "archive_members",
    f"""
SELECT (row_number() OVER (ORDER BY parse_filename(filename)) - 1)::INTEGER AS seq, 'tables/' || parse_filename(filename) AS path, octet_length(content) AS bytes, sha256(content) AS sha256, true AS plain
FROM read_blob('{TABLES}/*.parquet')
""",
)
def _archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables' files in a tar.gz, read back."""
    names = sorted(r["path"] for r in files.inventory(spark, sf_dir, "*.parquet").collect())
    out = f"{folder(spark, 'release')}/tables.tar.gz"
    archives.write(spark, sf_dir, names, out, "tables")
    return archives.members(spark, out)


#: The split of a document in written datasets.
DEALT = "CASE doc_id % 7 WHEN 0 THEN 'valid' WHEN 3 THEN 'test' ELSE 'train' END"
LINE_SQL = "'{\"id\": ' || doc_id || ', \"sha256\": \"' || sha256(coalesce(text, '')) || '\"}'"


@query(
    "dataset_files",
    f"""
SELECT split, CASE split WHEN 'valid' THEN 'validation' ELSE split END || '.jsonl' AS path, sum(strlen(line) + 1)::BIGINT AS bytes,
    sha256(string_agg(line || chr(10), '' ORDER BY doc_id)) AS sha256, count(*) AS rows
FROM (SELECT doc_id, {DEALT} AS split, {LINE_SQL} AS line FROM documents) GROUP BY split
""",
)
def _dataset_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The splits of a dataset written as lines in the order of their ids, several part files each, and their bytes' identity."""
    docs = table(spark, sf_dir, "documents")
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    line = F.concat(F.lit('{"id": '), F.col("doc_id").cast("string"), F.lit(', "sha256": "'), text, F.lit('"}'))
    rows = docs.select("doc_id", F.expr(DEALT).alias("split"), line.alias("value"))
    top = folder(spark, "dataset")
    for split, name in corpus.SPLIT_FILE.items():
        part = rows.where(F.col("split") == split).repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id")
        part.select("value").write.text(f"{top}/{name}")
    return records.split_records(spark, top, corpus.SPLIT_FILE)


@query(
    "manifest_verify",
    f"SELECT path, CASE WHEN path = 'src1' THEN 'size' WHEN path = 'src2' THEN 'hash' WHEN path = 'src3' THEN 'missing' ELSE 'ok' END AS status FROM {LIST_SQL}",
)
def _verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = listed(spark, sf_dir)
    actual = expected.where("path <> 'src3'").withColumns(
        {"bytes": F.when(F.col("path") == "src1", 0).otherwise(F.col("bytes")), "sha256": F.when(F.col("path") == "src2", "").otherwise(F.col("sha256"))}
    )
    return files.verify(expected, actual)


@query(
    "size_caps",
    f"SELECT cap, total_bytes, total_bytes < most AS ok FROM (SELECT sum(bytes)::BIGINT AS total_bytes FROM {LIST_SQL}), (VALUES ('package', 1000000000), ('browser', 67108864), ('tiny', 1000)) c(cap, most)",
)
def _caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.size_caps(listed(spark, sf_dir), {"package": files.PACKAGE_MOST, "browser": files.BROWSER_MOST, "tiny": 1000})


@query(
    "pair_completeness",
    """
SELECT source || '.' || lang AS stem, string_agg(DISTINCT side, ',' ORDER BY side) AS sides, count(DISTINCT side) = 2 AS complete
FROM (SELECT source, lang, CASE WHEN doc_id % 7 < 3 THEN 'lora_a' ELSE 'lora_b' END AS side FROM documents) GROUP BY 1
""",
)
def _complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("doc_id") % 7 < 3, "lora_a").otherwise("lora_b")
    return files.pair_completeness(table(spark, sf_dir, "documents").select(F.concat_ws(".", "source", "lang", side).alias("name")))


@query(
    "registry_lookup",
    """
SELECT s_suppkey, name, role, bytes FROM (SELECT s_suppkey, CASE s_nationkey % 3 WHEN 0 THEN 'lite' WHEN 1 THEN 'pro' ELSE 'none' END AS tier, s_suppkey % 2 = 0 AS runs FROM supplier)
LEFT JOIN (VALUES ('lite', false, 'lite-train', 'student-lite-training-base', NULL::BIGINT), ('lite', true, 'lite-runtime', 'student-lite-runtime-base', 3349514112),
    ('pro', false, 'pro-train', 'student-pro-training-base', NULL), ('pro', true, 'pro-runtime', 'student-pro-runtime-base', 6975878912)) v(tier, runs, name, role, bytes) USING (tier, runs)
""",
)
def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.get(F.array(*map(F.lit, ("Lite", "PRO", "none"))), (F.col("s_nationkey") % 3).cast("int"))
    asked = table(spark, sf_dir, "supplier").select("s_suppkey", tier.alias("tier"), (F.col("s_suppkey") % 2 == 0).alias("runtime"))
    return registry.students(asked).select("s_suppkey", "pin.name", "pin.role", "pin.bytes")


@query(
    "seed_files",
    """
SELECT path, split, n AS rows, true AS whole
FROM (SELECT split, CASE split WHEN 'preference-test' THEN 'preference_test' ELSE split END || '.jsonl' AS path, count(*) * 8 AS n
    FROM (SELECT CASE doc_id % 8 WHEN 5 THEN 'validation' WHEN 6 THEN 'preference-test' WHEN 7 THEN 'heldout' ELSE 'train' END AS split FROM documents) GROUP BY split)
""",
)
def _seed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed tasks of every document in files by split; whole: each file's bytes are what the manifest records."""
    top = folder(spark, "seeds")
    manifest = seeds.write(spark, top, seeds.plan_of(table(spark, sf_dir, "documents"), "doc_id"), parts=3)
    told = spark.createDataFrame([(f["path"], f["bytes"], f["sha256"], f["rows"]) for f in manifest["files"]], "path string, bytes bigint, sha256 string, rows bigint")
    split = spark.createDataFrame([(v, k) for k, v in seeds.SPLIT_FILES.items()], "path string, split string")
    found = records.file_records(spark, top, names=[f["path"] for f in manifest["files"]], parts=True).select("path", F.col("bytes").alias("b"), F.col("sha256").alias("s"))
    return told.join(found, "path").join(split, "path").select("path", "split", "rows", ((F.col("b") == F.col("bytes")) & (F.col("s") == F.col("sha256"))).alias("whole"))


#: What differs in the adapter of a supplier, by its number: (modulus, remainder).
FLAWS = {"version": (7, 3), "architecture": (6, 1), "type": (4, 3), "adapter": (9, 4), "alpha": (8, 5), "missing": (3, 2), "foreign": (11, 6), "float": (10, 7), "cut": (13, 8)}


def adapter_bytes(number: int) -> bytes:
    """A small adapter file with the flaws of its number."""
    has = {name: number % m == r for name, (m, r) in FLAWS.items()}
    keys = [("general.architecture", gguf.TEXT, "other" if has["architecture"] else "student"), ("general.type", gguf.TEXT, "model" if has["type"] else "adapter")]
    keys += [] if has["adapter"] else [("adapter.type", gguf.TEXT, "lora")]
    keys += [("adapter.lora.alpha", 6, 8.0 if has["alpha"] else 16.0), ("notes", gguf.LIST, (4, list(range(number % 200))))]
    names = ["a.weight" if has["foreign"] else "a.lora_a", "a.lora_b", "b.lora_a", *([] if has["missing"] else ["b.lora_b"])]
    data = gguf.encoded(2 if has["version"] else 3, keys, [(n, [8, number + 1], 0 if has["float"] and n == "b.lora_a" else 1) for n in names])
    return data[:-30] if has["cut"] else data + bytes(500)


def _flaw(name: str) -> str:
    return f"s_suppkey % {FLAWS[name][0]} = {FLAWS[name][1]}"


@query(
    "gguf_audit",
    f"""
SELECT s_suppkey || '.gguf' AS path, CASE WHEN {_flaw("cut")} THEN 'broken:no GGUF header: it ends too early' ELSE concat_ws(',', CASE WHEN {_flaw("version")} THEN 'version' END,
    CASE WHEN {_flaw("missing")} THEN 'tensor-count' END, CASE WHEN {_flaw("architecture")} THEN 'architecture' END, CASE WHEN {_flaw("type")} THEN 'type' END,
    CASE WHEN {_flaw("adapter")} THEN 'adapter-type' END, CASE WHEN {_flaw("alpha")} THEN 'alpha' END, CASE WHEN {_flaw("missing")} OR {_flaw("foreign")} THEN 'complete-pairs' END,
    CASE WHEN {_flaw("foreign")} THEN 'foreign-tensor:a.weight' END, CASE WHEN {_flaw("float")} THEN 'tensor-type:b.lora_a' END) END AS issues
FROM supplier
""",
)
def _gguf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An adapter file for each supplier, written by the executors, its header read back and checked."""
    top = folder(spark, "adapters")
    root = records.local_root(top)
    importable(spark)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(root, exist_ok=True)
        for frame in frames:
            for number in frame["s_suppkey"]:
                with open(f"{root}/{number}.gguf", "wb") as file:
                    file.write(adapter_bytes(number))
            yield frame

    names = [f"{r[0]}.gguf" for r in table(spark, sf_dir, "supplier").select("s_suppkey").mapInPandas(write, "s_suppkey bigint").collect()]
    found = gguf.adapter_issues(gguf.headers(spark, top, names), 4, 16.0, "student")
    return found.select("path", F.array_join("issues", ",").alias("issues"))
