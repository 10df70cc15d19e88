"""GGUF files as tables: the header's key-value block and tensor table, read on the executors.

Only the header is read, in chunks, however large the file is. Its layout is that of version 2 and 3: magic, version, number of
tensors, number of keys; keys with typed values; tensors with name, dimensions, type and offset; all little-endian.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.functions.workers import importable
from prefmill.sources.files import pair_completeness
from prefmill.sources.records import place

#: Value types of the format, by number, as struct codes; text and lists have forms of their own.
SCALARS = {0: "B", 1: "b", 2: "H", 3: "h", 4: "I", 5: "i", 6: "f", 7: "?", 10: "Q", 11: "q", 12: "d"}
TEXT, LIST = 8, 9
#: Names of tensor types that adapters and their bases use.
TENSOR_TYPES = {0: "F32", 1: "F16", 2: "Q4_0", 3: "Q4_1", 6: "Q5_0", 7: "Q5_1", 8: "Q8_0", 12: "Q4_K", 13: "Q5_K", 14: "Q6_K", 28: "F64", 30: "BF16"}
#: A list longer than this is told by its length alone, a text or a number of entries beyond it is no header.
SHOWN, MOST = 64, 1 << 30
SCHEMA = "path string, section string, nth bigint, name string, type string, value string, offset bigint"


class _Header:
    def __init__(self, file: BinaryIO) -> None:
        self.file = file

    def take(self, n: int) -> bytes:
        if n > MOST:
            raise ValueError("no GGUF header: an entry is too large")
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("no GGUF header: it ends too early")
        return data

    def number(self, code: str):
        return struct.unpack("<" + code, self.take(struct.calcsize("<" + code)))[0]

    def text(self) -> str:
        return self.take(self.number("Q")).decode("utf-8", "replace")

    def value(self, kind: int):
        if kind in SCALARS:
            return self.number(SCALARS[kind])
        if kind == TEXT:
            return self.text()
        if kind != LIST:
            raise ValueError(f"no GGUF header: value type {kind}")
        inner, count = self.number("I"), self.number("Q")
        if count > MOST:
            raise ValueError("no GGUF header: an entry is too large")
        if inner in SCALARS and count > SHOWN:
            left = count * struct.calcsize("<" + SCALARS[inner])
            while left:
                left -= len(self.take(min(left, 1 << 20)))
            return {"count": count}
        shown = [x for i in range(count) if (x := self.value(inner), i < SHOWN)[1]]
        return shown if count <= SHOWN else {"count": count}


def header(file: BinaryIO) -> Iterator[tuple[str, int, str, str, str, int | None]]:
    """(section, nth, name, type, value as JSON, offset) of a header's parts: file, key, tensor."""
    h = _Header(file)
    if h.take(4) != b"GGUF":
        raise ValueError("no GGUF header: another magic")
    version = h.number("I")
    if version not in (2, 3):
        raise ValueError(f"no GGUF header: version {version}")
    tensors, keys = h.number("Q"), h.number("Q")
    yield "file", 0, "version", "number", json.dumps(version), None
    yield "file", 1, "tensor_count", "number", json.dumps(tensors), None
    for k in range(keys):
        name = h.text()
        kind = h.number("I")
        value = h.value(kind)
        yield "key", k, name, "text" if kind == TEXT else "list" if kind == LIST else "number", json.dumps(value), None
    for k in range(tensors):
        name = h.text()
        dims = [h.number("Q") for _ in range(h.number("I"))]
        kind = h.number("I")
        yield "tensor", k, name, TENSOR_TYPES.get(kind, f"type-{kind}"), json.dumps(dims), h.number("Q")


def headers(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """(path, section, nth, name, type, value, offset) of the headers of the files below root; section ``broken`` tells why a header ends."""
    importable(spark)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = place(root)
        for frame in frames:
            for path in frame["path"]:
                _, issue = store.look(path)
                rows: list[tuple] = []
                if issue:
                    rows.append((path, "broken", 0, issue, None, None, None))
                else:
                    with store.open(path) as file:
                        try:
                            for part in header(file):
                                rows.append((path, *part))
                                if len(rows) == 10_000:
                                    yield _frame(rows)
                                    rows = []
                        except (ValueError, struct.error) as e:
                            rows.append((path, "broken", 0, str(e), None, None, None))
                yield _frame(rows)

    files = spark.createDataFrame([(n,) for n in names], "path string").repartition(min(max(1, len(names)), 4 * spark.sparkContext.defaultParallelism))
    return files.mapInPandas(read, SCHEMA)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["path", "section", "nth", "name", "type", "value", "offset"]).astype({"offset": "Int64"})


def adapter_issues(parts: DataFrame, tensors: int, alpha: float, architecture: str) -> DataFrame:
    """(path, issues) of each file of ``headers``: what keeps it from being a whole adapter.

    Seven checks, named where they fail: version, tensor-count (as expected, as told and as listed), architecture, type, adapter-type,
    alpha, complete-pairs. Besides, foreign-tensor:name for a tensor that is no side of a pair, and tensor-type:name for one that is not F16.
    """
    key = lambda section, name: F.max(F.when((F.col("section") == section) & (F.col("name") == name), F.col("value")))
    told = parts.groupBy("path").agg(
        key("file", "version").alias("version"), key("file", "tensor_count").alias("count"), F.count_if(F.col("section") == "tensor").alias("listed"),
        key("key", "general.architecture").alias("architecture"), key("key", "general.type").alias("kind"), key("key", "adapter.type").alias("adapter"),
        key("key", "adapter.lora.alpha").alias("alpha"), F.max(F.when(F.col("section") == "broken", F.col("name"))).alias("broken"),
    )
    listed = parts.where("section = 'tensor'")
    lora = F.col("name").rlike(r"\.lora_[ab]$")
    wrong = listed.select("path", F.when(~lora, F.concat(F.lit("foreign-tensor:"), "name")).when(F.col("type") != "F16", F.concat(F.lit("tensor-type:"), "name")).alias("issue")).where("issue IS NOT NULL")
    wrong = wrong.groupBy("path").agg(F.array_sort(F.collect_set("issue")).alias("wrong"))
    # a stem and the file it stands in: names of two files never make a pair
    stems = pair_completeness(listed.where(lora).select(F.concat(F.col("path"), F.lit("\x00"), F.col("name")).alias("name")))
    odd = stems.where(~F.col("complete")).select(F.substring_index("stem", "\x00", 1).alias("path")).distinct().withColumn("odd", F.lit(True))
    number = F.col("alpha").cast("double")
    rules = [
        ("version", F.col("version") == "3"),
        ("tensor-count", (F.col("count").cast("bigint") == tensors) & (F.col("listed") == tensors)),
        ("architecture", F.col("architecture") == json.dumps(architecture)),
        ("type", F.col("kind") == '"adapter"'),
        ("adapter-type", F.col("adapter") == '"lora"'),
        ("alpha", number == alpha),
        ("complete-pairs", F.col("odd").isNull()),
    ]
    none = F.array().cast("array<string>")
    codes = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules]), lambda x: x.isNotNull())
    found = F.when(F.col("broken").isNotNull(), F.array(F.concat(F.lit("broken:"), "broken"))).otherwise(F.concat(codes, F.coalesce("wrong", none)))
    return told.join(wrong, "path", "left").join(odd, "path", "left").select("path", found.alias("issues"))


def encoded(version: int, keys: list[tuple[str, int, object]], tensors: list[tuple[str, list[int], int]], told: int | None = None) -> bytes:
    """A header: what ``header`` reads, from keys (name, type, value) and tensors (name, dimensions, type)."""

    def text(s: str) -> bytes:
        raw = s.encode()
        return struct.pack("<Q", len(raw)) + raw

    def value(kind: int, x) -> bytes:
        if kind == TEXT:
            return text(x)
        if kind == LIST:
            inner, items = x
            return struct.pack("<IQ", inner, len(items)) + b"".join(value(inner, i) for i in items)
        return struct.pack("<" + SCALARS[kind], x)

    out = b"GGUF" + struct.pack("<IQQ", version, len(tensors) if told is None else told, len(keys))
    out += b"".join(text(n) + struct.pack("<I", k) + value(k, x) for n, k, x in keys)
    offset = 0
    for name, dims, kind in tensors:
        out += text(name) + struct.pack("<I", len(dims)) + b"".join(struct.pack("<Q", d) for d in dims) + struct.pack("<IQ", kind, offset)
        offset += 32 * (1 + sum(dims))
    return out
