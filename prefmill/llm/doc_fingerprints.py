"""Document fingerprints: SimHash over weighted terms, and a search by permuted block tables.

Terms are pairs of neighbouring words (ASCII white space divides; A-Z lowered; a text
of one word is its own term). A term's 256 hash bits vote with +weight or -weight, its
weight being the number of bytes of its two words up to 16 (long words say more about a
document than function words); a bit is set where the sum is positive. The likeness of
two fingerprints is cos(pi * differing bits / 256), not below 0: SimHash's estimate of
the cosine between the weighted term vectors. It is 1 for equal fingerprints.

``edited`` pairs every document with a copy whose second half comes from its successor
in key order. The rows are range-partitioned and sorted once; a task handles
neighbours within its partition, and only each partition's first and last row cross.

``neighbours`` counts the documents within a Hamming radius: the fingerprint's blocks are
permuted to the front one after another, each permutation sorted as a table, and only
rows that agree on the leading block are compared, each pair in the first such table.

Defined cases: a null text is empty; texts without words have fingerprint zero; equal
keys are ordered by a hash of the text; null keys come last; the last document's successor is the
first, its own if it is alone; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefmill.llm.common import bounded_batches, text_or_empty, written
from prefmill.llm.hamming import bucket_tasks, whole_tasks

BITS = 256
WORDS = BITS // 64
WEIGHT_MOST = 16
RADIUS = 8


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Word hashes with a bounded memory of words seen."""

    def __init__(self, most: int = 200_000) -> None:
        self.most, self.seen = most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh3_64_intdigest as digest

        seen = self.seen
        if len(seen) > self.most:
            seen.clear()
        for w in set(words).difference(seen):
            seen[w] = digest(w)
        return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def fingerprint(text: str, hasher: Hasher | None = None) -> bytes:
    """BITS / 8 bytes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return bytes(BITS // 8)
    h = (hasher or Hasher())(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    if len(words) > 1:
        h = _mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
        size = size[:-1] + size[1:]
    weight = np.minimum(size, WEIGHT_MOST)
    votes = np.zeros(BITS, np.int64)
    # terms of one weight vote together: set bits are counted, then weighed
    order = np.argsort(weight, kind="stable")
    h, weight = h[order], weight[order]
    wide = np.stack([_mix(h + np.uint64(0x632BE59BD9B4E019 * k % 2**64)) for k in range(1, WORDS + 1)], axis=1)
    bits = wide.astype("<u8").view(np.uint8).reshape(-1, BITS // 8)
    cuts = np.flatnonzero(np.r_[True, weight[1:] != weight[:-1]])
    for a, b in zip(cuts, np.r_[cuts[1:], len(h)]):
        w = int(weight[a])
        for k in range(a, b, 8192):
            part = np.unpackbits(bits[k : min(k + 8192, b)], axis=1, bitorder="little")
            votes += w * part.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * votes > int(weight.sum()), bitorder="little").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """cos(pi * share of differing bits), at least 0."""
    apart = (int.from_bytes(a, "little") ^ int.from_bytes(b, "little")).bit_count()
    return max(0.0, math.cos(math.pi * apart / (8 * len(a))))


def edit(text: str, follower: str) -> str:
    """The last floor(n / 2) code points of text replaced by the follower's first as many, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


@F.pandas_udf(T.BinaryType())
def _packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Texts as they travel: compressed."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    for texts in batches:
        yield pd.Series([pack(t.encode("utf-8", "surrogatepass")) for t in texts], dtype=object)


RESULT = (
    "id {0}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
RESULT_NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _row(key: object, text: str, fp: bytes, follower: str, next_fp: bytes, hasher: Hasher) -> tuple:
    changed = edit(text, follower)
    e = fp if changed == text else fingerprint(changed, hasher)
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return key, len(text), sha, fp.hex(), e.hex(), likeness(fp, e), likeness(fp, next_fp)


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of docs: id and the columns of RESULT."""
    kind = dict(docs.dtypes)[key]
    # the range partitioner samples these columns on the driver: keep texts out of them
    order = [F.col("id").asc_nulls_last(), F.col("tie")]
    bounded_batches(docs)
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text_or_empty(text)).alias("tie"), _packed(text_or_empty(text)).alias("z"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "z", F.spark_partition_id().alias("part"))
    result = RESULT.format(kind)

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of finished documents (place null); the partition's first (place 0) and last (place 1) with their texts."""
        import zstandard

        plain = zstandard.ZstdDecompressor().decompress
        hasher = Hasher()
        held, part = None, None
        names = [*RESULT_NAMES, "part", "place", "t"]
        for frame in frames:
            out = []
            for k, z, p in zip(frame["id"].astype(object), frame["z"], frame["part"]):
                t = plain(z).decode("utf-8", "surrogatepass")
                k = None if pd.isna(k) else k
                fp = fingerprint(t, hasher)
                if held is None:
                    part = int(p)
                    out.append((k, len(t), None, fp.hex(), None, None, None, part, 0, t))
                else:
                    out.append((*_row(*held, t, fp, hasher), part, None, None))
                held = (k, t, fp)
            frame = pd.DataFrame(out, columns=names)
            yield frame.astype({"place": "Int32"})
        if held is not None:
            k, t, fp = held
            yield pd.DataFrame([(k, len(t), None, fp.hex(), None, None, None, part, 1, t)], columns=names).astype({"place": "Int32"})

    done = written(rows.mapInPandas(walk, f"{result}, part int, place int, t string"), "edited")
    inner = done.where(F.col("place").isNull()).select(*RESULT_NAMES)
    # one number for each partition with rows; bounded by the number of partitions
    parts = [r[0] for r in done.where("place = 0").select("part").sort("part").collect()]
    if not parts:
        return inner
    after = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    last = done.where("place = 1").select("id", "t", "fingerprint", "part").join(after, "part")
    first = done.where("place = 0").select(F.col("part").alias("next"), F.col("t").alias("n"), F.col("fingerprint").alias("nfp"))

    def close(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for f in frames:
            ids = [None if pd.isna(k) else k for k in f["id"].astype(object)]
            out = [
                _row(k, t, bytes.fromhex(fp), n, bytes.fromhex(nfp), hasher)
                for k, t, fp, n, nfp in zip(ids, f["t"], f["fingerprint"], f["n"], f["nfp"])
            ]
            yield pd.DataFrame(out, columns=RESULT_NAMES)

    seam = last.join(first, "next").select("id", "t", "fingerprint", "n", "nfp").mapInPandas(close, result)
    return inner.unionByName(seam)


def neighbours(prints: DataFrame, radius: int = RADIUS, column: str = "fingerprint") -> DataFrame:
    """(fingerprint, n_same, n_near): rows with this very fingerprint, and rows with another within the radius.

    A pair of fingerprints is compared in the first table in which both stand under one
    key, so each counts once; copies are counted by weight, not expanded.
    """
    names = [f"w{k}" for k in range(WORDS)]
    words = [F.conv(F.substring(column, 16 * k + 1, 16), 16, -10).cast("bigint").alias(w) for k, w in enumerate(names)]
    distinct = written(prints.select(*words).groupBy(*names).agg(F.count(F.lit(1)).alias("n_same")), "prints")
    blocks = radius + 1
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    masks = []
    for a, b in zip(cuts, cuts[1:]):
        m = ((1 << (b - a)) - 1) << a
        masks.append([np.uint64(m >> 64 * k & (2**64 - 1)) for k in range(WORDS)])

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_tasks(frames):
            own_words = [frame[c].to_numpy().view(np.uint64) for c in names]
            side, same = frame["side"].to_numpy(), frame["n_same"].to_numpy()
            found = np.zeros(len(frame), np.int64)
            for a, b in zip(starts, np.r_[starts[1:], len(frame)]):
                if b - a < 2:
                    continue
                own = frame["ci"].iat[a] == frame["cj"].iat[a]
                lanes = np.arange(a, b) if own else np.flatnonzero(side[a:b] == 0) + a
                asks = np.arange(a, b) if own else np.flatnonzero(side[a:b] == 1) + a
                tab = int(frame["tab"].iat[a])
                for k in range(0, len(asks), 256):
                    q = asks[k : k + 256]
                    x = [w[q][:, None] ^ w[lanes][None, :] for w in own_words]
                    near = sum(np.bitwise_count(y).astype(np.int16) for y in x) <= radius
                    near &= q[:, None] != lanes[None, :]
                    i, j = np.nonzero(near)
                    new = np.ones(len(i), bool)
                    for mask in masks[:tab]:
                        new &= np.any([(y[i, j] & m) != 0 for y, m in zip(x, mask)], axis=0)
                    i, j = i[new], j[new]
                    np.add.at(found, q[i], same[lanes[j]])
                    if not own:
                        np.add.at(found, lanes[j], same[q[i]])
            at = np.flatnonzero(found)
            yield frame[names].iloc[at].assign(n=found[at])

    tasks = bucket_tasks(distinct, names, blocks, radius)
    ddl = ", ".join(f"{n} bigint" for n in [*names, "n"])
    found = tasks.mapInPandas(search, ddl).groupBy(*names).agg(F.sum("n").alias("n_near"))
    both = distinct.join(found, names, "left")
    digits = F.concat(*[F.lower(F.lpad(F.hex(n), 16, "0")) for n in names])
    return both.select(digits.alias(column), "n_same", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """The columns of RESULT, with the key under its own name, n_same and n_near."""
    rows = edited(docs, key, text)
    near = written(neighbours(rows, radius), "neighbours")
    return rows.join(near, "fingerprint").select(F.col("id").alias(key), *RESULT_NAMES[1:], "n_same", "n_near")
