"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on texts labelled good and one on texts
labelled bad. A text is cut into blocks of 512 bytes, each compressed with either
dictionary; the difference of the total sizes, divided by the bytes of the text, says
which kind it resembles. Short texts say little, so each counts as if SHRINK more bytes
of an average good text stood in it. Isotonic regression over labelled texts that trained no
dictionary turns that difference into a probability of label 1.

Fitting reads a bounded sample of labelled rows (``per_class`` rows of each label for
the dictionaries, as many again for the calibration, chosen by a hash of the key);
class weights come from all labelled rows. Every block of those texts enters a dictionary's training, in the order of their hashes: the
trainer takes something from each stretch of its samples, and neighbours of one long text would fill many. Calibration and
scoring use whole texts, compressed on the executors. Rows whose
crc32(key as text) mod 5 is 0 are held out: their labels are never used.

Defined cases: a null text is empty, and an empty text scores as an average good one; rows without
a label are scored like others; a null label or key trains nothing; repeated label rows
count once for each; without labels of both kinds every score is the share of label 1
(0.5 without labels); an empty table gives an empty result; input columns named like a
result column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.llm.common import bounded_batches, text_or_empty

BLOCK = 512
DICTIONARY = 65_536
PER_CLASS = 1500
THRESHOLD = 0.3
LEVEL = 1
SHRINK = 64
FOLDS = 5


def blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def train_dictionary(texts: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; where the samples are too few to train one, their plain content."""
    import zstandard

    parts = sorted((b for t in texts for b in blocks(t)), key=lambda b: (zlib.crc32(b), b))
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(parts)[-size:] or b"\0" * 8


class Differ:
    """How many bytes more a text takes under the bad dictionary than under the good one."""

    def __init__(self, bad: bytes, good: bytes) -> None:
        import zstandard

        def compress(d: bytes):
            kind = zstandard.DICT_TYPE_AUTO  # content that has no dictionary header counts as raw
            held = zstandard.ZstdCompressionDict(d, dict_type=kind)
            c = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False, write_checksum=False
            )
            return c.compress

        self.bad, self.good = compress(bad), compress(good)

    def __call__(self, text: str) -> tuple[int, int]:
        """(difference, bytes of the text)."""
        data = text.encode("utf-8", "surrogatepass")
        parts = blocks(data)
        return sum(len(self.bad(b)) for b in parts) - sum(len(self.good(b)) for b in parts), len(data)


def normalised(difference: np.ndarray, size: np.ndarray, rate: float) -> np.ndarray:
    """The difference a byte, drawn towards ``rate`` by SHRINK bytes."""
    return (np.asarray(difference) + rate * SHRINK) / (np.asarray(size) + SHRINK)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[list[float], list[float]]:
    """Knots of the non-decreasing function closest to y: flat over each pooled range of x, linear in the gaps between."""
    at, index = np.unique(x, return_inverse=True)
    w = np.bincount(index, weights=weight)
    wy = np.bincount(index, weights=weight * y)
    level: list[list[float]] = []  # first x, last x, sum of w*y, sum of w
    for i in range(len(at)):
        level.append([at[i], at[i], wy[i], w[i]])
        while len(level) > 1 and level[-2][2] * level[-1][3] >= level[-1][2] * level[-2][3]:
            last = level.pop()
            level[-1] = [level[-1][0], last[1], level[-1][2] + last[2], level[-1][3] + last[3]]
    knots = [(float(v), min(1.0, max(0.0, b / c))) for lo, hi, b, c in level for v in (lo, hi)]
    return [k for k, _ in knots], [v for _, v in knots]


@dataclass(frozen=True)
class Model:
    """bad and good: dictionaries; rate: the median difference a byte of good texts; at and score: the calibration's knots.

    Without dictionaries the score is a constant.
    """

    bad: bytes
    good: bytes
    rate: float
    at: tuple[float, ...]
    score: tuple[float, ...]

    def column(self, text: str = "text", out: str = "score") -> Column:
        at, score = np.array(self.at), np.array(self.score)
        if not self.bad:
            return F.lit(float(score[0])).alias(out)
        bad, good, rate = self.bad, self.good, self.rate

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            differ = Differ(bad, good)
            for texts in batches:
                got = np.array([differ(t) for t in texts], dtype=float).reshape(-1, 2)
                yield pd.Series(np.interp(normalised(got[:, 0], got[:, 1], rate), at, score), dtype="float64")

        return run(text_or_empty(text)).alias(out)


def held_out(key: str, folds: int = FOLDS) -> Column:
    """crc32(key as text) mod folds = 0; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")), F.lit(folds)) == 0


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Learn from docs with labels (key, label 0 or 1)."""
    bounded_batches(docs)
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key))
    usable = usable.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = [counts.get(0, 0), counts.get(1, 0)]
    if not (n[0] and n[1]):
        return Model(b"", b"", 0.0, (0.0,), (n[1] / sum(n) if sum(n) else 0.5,))
    picks = []
    for y in (0, 1):
        take = min(2 * per_class, n[y])
        first = usable.where(F.col("y") == y).orderBy(F.xxhash64("k", F.lit(3)), "k").limit(take)
        # an even hash of the key trains the dictionary, an odd one calibrates
        picks.append(first.select("k", "y", F.pmod(F.xxhash64("k", F.lit(17)), F.lit(2)).alias("role")))
    chosen = F.broadcast(picks[0].unionByName(picks[1]))  # at most 4 * per_class rows
    rows = docs.select(F.col(key).alias("k"), text_or_empty(text).alias("t")).join(chosen, "k")
    texts: list[list[bytes]] = [[], []]
    for r in rows.where("role = 0").select("y", "k", F.encode("t", "UTF-8").alias("t")).collect():
        texts[r["y"]].append((r["k"], bytes(r["t"])))
    texts = [[t for _, t in sorted(x)] for x in texts]
    bad, good = train_dictionary(texts[0]), train_dictionary(texts[1])

    @F.pandas_udf("double")
    def differences(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        differ = Differ(bad, good)
        for b in batches:
            yield pd.Series([differ(t)[0] for t in b], dtype="float64")

    held = rows.where("role = 1").select("y", differences("t").alias("d"), F.octet_length("t").alias("n"))
    got = np.array(sorted((r["d"], r["n"], r["y"]) for r in held.collect()), dtype=float).reshape(-1, 3)
    y = got[:, 2]
    seen = [max(1, int((y == 0).sum())), max(1, int((y == 1).sum()))]
    if len(set(y)) < 2:  # too few labels to calibrate: the sign decides
        got, y, seen = np.array([[-2.0, 100.0, 0.0], [2.0, 100.0, 1.0]]), np.array([0.0, 1.0]), [1, 1]
    rate = float(np.median(got[y == 1, 0] / np.maximum(got[y == 1, 1], 1)))
    weight = np.where(y == 1, n[1] / seen[1], n[0] / seen[0])
    at, score = isotonic(normalised(got[:, 0], got[:, 1], rate), y, weight)
    return Model(bad, good, rate, tuple(at), tuple(score))


def report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted): a row for each row of docs."""
    model = fit(docs, labels, key, text, label)
    scored = docs.select(F.col(key), held_out(key).alias("held_out"), model.column(text))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier accepts."""
    model = fit(docs, labels, key, text, label)
    return docs.where(model.column(text) >= threshold)
