"""Tables over blocks of fingerprints, dealt out so that no bucket overfills a task.

Two fingerprints that differ in at most r bits agree on at least b - r of b blocks. A
table holds every fingerprint under the value of one choice of b - r blocks; rows with
equal keys form a bucket. A bucket of more than ``most`` rows is dealt into chunks and
each pair of chunks becomes a task of its own, so every pair is still compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.llm.common import written

MOST = 2048
TASK = ["tab", "key", "ci", "cj"]


def blocks_of(bits: int, blocks: int) -> list[tuple[int, int]]:
    """(first bit, width) of each block."""
    cuts = [bits * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def choices(blocks: int, radius: int) -> list[tuple[int, ...]]:
    return list(combinations(range(blocks), blocks - radius))


def blocks_for(n: int, bits: int, radius: int, bucket: int = 4096) -> int:
    """The fewest blocks for which n spread-out fingerprints fill a bucket with ``bucket`` rows at most."""
    b = radius + 1
    while b < radius + 4 and n / 2 ** (bits * (b - radius) / b) > bucket:
        b += 1
    return b


def bit_field(words: list[Column], start: int, width: int) -> Column:
    """Bits start .. start + width - 1 (width under 64) of a fingerprint held in 64-bit words, lowest first."""
    at, off = divmod(start, 64)
    low = F.shiftrightunsigned(words[at], off)
    if off + width > 64:
        low = low.bitwiseOR(F.shiftleft(words[at + 1], 64 - off))
    return low.bitwiseAND(F.lit((1 << width) - 1))


def bucket_tasks(fps: DataFrame, words: list[str], blocks: int, radius: int, most: int = MOST) -> DataFrame:
    """fps once for each table and task: with tab, key, ci, cj and side (0: lanes, 1: queries; both in tasks with ci = cj)."""
    parts = blocks_of(64 * len(words), blocks)
    cols = [F.col(w) for w in words]
    tables = []
    for t, choice in enumerate(choices(blocks, radius)):
        fields = [bit_field(cols, *parts[i]) for i in choice]
        key = fields[0] if len(fields) == 1 else F.xxhash64(*fields)
        tables.append(F.struct(F.lit(t).alias("tab"), key.alias("key")))
    rows = fps.select("*", F.explode(F.array(*tables)).alias("_t")).select("*", "_t.tab", "_t.key").drop("_t")
    full = written(rows.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most), "full-buckets")
    rows = rows.join(full, ["tab", "key"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    return deal(rows, F.xxhash64(*cols, F.lit(5)), most).repartition(*TASK).sortWithinPartitions(*TASK, "side", *words)


def deal(rows: DataFrame, spread: Column, most: int) -> DataFrame:
    """rows (with the size n of their bucket) once for each pair of chunks that their chunk is in: with ci, cj and side."""
    chunks = F.ceil(F.col("n") / F.lit(float(most))).cast("int")
    rows = rows.withColumn("_c", chunks).withColumn("_m", F.pmod(spread, chunks).cast("int"))
    # chunk m meets every chunk: as lanes those from m on, as queries those before
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)))
    return (
        rows.withColumn("ci", F.least("_m", "_o"))
        .withColumn("cj", F.greatest("_m", "_o"))
        .withColumn("side", F.when(F.col("_m") <= F.col("_o"), 0).otherwise(1))
        .drop("_c", "_m", "_o", "n")
    )


def whole_tasks(frames: Iterator[pd.DataFrame], least: int = 8192) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames that end where a task ends, each with the first row of every task in it."""
    held: list[pd.DataFrame] = []
    rows = 0

    def cut(f: pd.DataFrame) -> np.ndarray:
        k = f[TASK].to_numpy()
        return np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)])

    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        rows += len(frame)
        if rows < least:
            continue
        f = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
        starts = cut(f)
        last = int(starts[-1])
        if last:
            for a, b in zip(range(0, len(starts) - 1, 4096), [*range(4096, len(starts) - 1, 4096), len(starts) - 1]):
                yield f.iloc[starts[a] : starts[b]].reset_index(drop=True), starts[a:b] - starts[a]
        held = [f.iloc[last:].reset_index(drop=True)]
        rows = len(held[0])
    if rows:
        f = pd.concat(held, ignore_index=True)
        yield f, cut(f)


def star_links(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes 0 .. n-1 as a-b do: one from each node to its component's first."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]
