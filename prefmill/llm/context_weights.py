"""Context weights of the language model that grow with the corpus: a feature for each hashed (previous word, word).

A word w of the vocabulary has, besides its share u(w) within its class, one feature for each previous
word it follows in the training texts: P(w | class, previous) = u(w) exp(t) / Z, where t is the weight of (previous, w),
0 where they never met, and Z = 1 + sum over the met words of u (exp(t) - 1), so every distribution still sums to 1.
The sum runs over one group: the words of one class that follow one previous word. A group meets at
most the words of its class, whatever the corpus, and no other group shares its weights.

Keys have 64 bits: the previous word's hash (``context_bits``, chosen from the number of
distinct words so that few share one), its bucket (8), and the word's rank by class (17). Groups are dealt to parts by
hash; the number of parts grows with the tokens. A part's counts are trained where its weights are used, by gradient
updates over all its groups at once: every update moves each weight by the gradient of its group's penalised
likelihood over its curvature. The counts are discounted by the share that counts of one and two
give, which leaves the words not met after a previous word their mass. Parts whose tokens exceed
``PART_TOKENS`` are worked by several tasks, each for a share of the texts. The parts are worked in
SWEEPS steps, each with its own shuffle, which is freed before the next: a third of the keys lies on disk twice.

Keys travel sorted, as zstandard-compressed gaps. Nothing of this reaches the driver but one number for each part.
Without keys there is nothing to add; very long texts come in slices, and a slice's keys are dealt as any other's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.llm.common import release, written

RANK_BITS, BUCKET_BITS = 17, 8
LOW_BITS = RANK_BITS + BUCKET_BITS
PART_TOKENS = 1 << 21
MOST_PARTS = 1 << 14
FLUSH_KEYS = 1 << 20
SLICE_KEYS = 1 << 17
SWEEPS = 3
ROUNDS = 12
RIDGE = 0.01
MIX = np.uint64(0x9E3779B97F4A7C15)


def context_bits(distinct: int) -> int:
    """Bits of a previous word's hash: sixteen slots for each distinct word."""
    return min(64 - LOW_BITS, max(12, math.ceil(math.log2(distinct + 1)) + 4))


def part_count(tokens: int) -> int:
    """Parts of about PART_TOKENS tokens; MOST_PARTS at most, beyond which a part's distinct keys hardly grow."""
    return min(MOST_PARTS, max(1, -(-tokens // PART_TOKENS)))


def groups_of(keys: np.ndarray, rank_class: np.ndarray) -> np.ndarray:
    """(previous word, class) of each key, as one number in the keys' order."""
    low = (keys & np.uint64((1 << RANK_BITS) - 1)).astype(np.int64)
    return (keys >> np.uint64(RANK_BITS) << np.uint64(8)) | rank_class[low].astype(np.uint64)


def parts_of(groups: np.ndarray, parts: int) -> np.ndarray:
    return ((groups * MIX >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def pack(keys: np.ndarray, *others: np.ndarray) -> tuple[bytes, ...]:
    """Sorted keys as compressed gaps, byte planes apart; other arrays compressed as they are."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1).compress
    gaps = np.diff(keys, prepend=np.uint64(0))
    planes = np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return (squeeze(planes.tobytes()), *(squeeze(x.tobytes()) for x in others))


def pack_docs(docs: np.ndarray) -> bytes:
    """Numbers below 65536, low bytes before high ones, compressed."""
    import zstandard

    planes = np.ascontiguousarray(docs.astype("<u2").view(np.uint8).reshape(-1, 2).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_docs(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack(data), np.uint8).reshape(2, -1)
    return np.ascontiguousarray(planes.T).view("<u2").ravel()


def unpack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def unpack_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def split(keys: np.ndarray, rank_class: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, positions in the sorted keys, in order) for each part that has some."""
    part = np.empty(len(keys), np.uint16)  # MOST_PARTS at most
    for i in range(0, len(keys), SLICE_KEYS):
        part[i : i + SLICE_KEYS] = parts_of(groups_of(keys[i : i + SLICE_KEYS], rank_class), parts)
    order = np.argsort(part, kind="stable")
    dealt = part[order]
    edges = np.flatnonzero(np.r_[True, dealt[1:] != dealt[:-1]]) if len(keys) else order
    for a, b in zip(edges, np.r_[edges[1:], len(order)]):
        yield int(part[order[a]]), order[a:b]


def merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, c = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(k)
    k, c = k[order], c[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


class Counting:
    """Counts keys within a task; gives rows (part, tokens, keys, counts) of at most FLUSH_KEYS keys at a time."""

    def __init__(self, rank_class: np.ndarray, parts: int) -> None:
        self.rank_class, self.parts = rank_class, parts
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> Iterator[tuple]:
        self.waiting.append(keys)
        self.size += len(keys)
        if self.size >= FLUSH_KEYS:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        keys = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint64)
        self.waiting, self.size = [], 0
        keys.sort()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        counts = np.diff(first, append=len(keys)).astype("<u4")
        keys = keys[first]
        del first
        for part, at in split(keys, self.rank_class, self.parts):
            yield (part, int(counts[at].sum()), *pack(keys[at], counts[at]))


COUNTED = "part int, tokens bigint, keys binary, counts binary"


def discount(counts: np.ndarray) -> float:
    """What is taken off each count, by the counts of one and two."""
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once else 0.0


def train(share: np.ndarray, counts: np.ndarray, start: np.ndarray, off: float, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of whole groups' keys and log Z of the groups.

    share: u of each key; start: the first key of each group. Each round updates all weights by gradient over curvature.
    """
    size = np.diff(np.r_[start, len(counts)])
    total = np.repeat(np.add.reduceat(counts, start), size).astype(float)
    target = counts - off
    t = np.zeros(len(counts))

    def log_z() -> np.ndarray:
        rest = np.maximum(1.0 - np.add.reduceat(share, start), 0.0)  # rounding may leave a little less than nothing
        return np.log(rest + np.add.reduceat(share * np.exp(t), start))

    for _ in range(rounds):
        p = share * np.exp(t - np.repeat(log_z(), size))
        np.clip(p, 0.0, 1.0, out=p)
        step = (target - total * p - RIDGE * t) / (total * p * (1 - p) + RIDGE)
        t += np.clip(step, -1.0, 1.0)
    return t, log_z()


class Part:
    """A part's trained weights and the answers they give."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, share, rank_class: np.ndarray) -> None:
        """share: keys -> u of their words."""
        self.keys, self.rank_class = keys, rank_class
        groups = groups_of(keys, rank_class)
        start = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.groups = groups[start]
        del groups
        off = discount(counts)
        self.t, self.z = np.zeros(len(keys), np.float32), np.zeros(len(start), np.float32)
        # groups share nothing, so they are trained a slice at a time; a group is no larger than its class
        end, g = np.r_[start, len(keys)], 0
        while g < len(start):
            h = max(g + 1, int(np.searchsorted(end, end[g] + SLICE_KEYS, "right")) - 1)
            at = slice(end[g], end[h])
            self.t[at], self.z[g:h] = train(share(keys[at]), counts[at], start[g:h] - end[g], off)
            g = h

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """What each key adds to the log10 probability of its word within its class."""
        out = np.zeros(len(keys))
        if not len(self.keys):
            return out
        groups = groups_of(keys, self.rank_class)
        g = np.minimum(np.searchsorted(self.groups, groups), len(self.groups) - 1)
        k = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        out -= np.where(self.groups[g] == groups, self.z[g], 0.0)
        out += np.where(self.keys[k] == keys, self.t[k], 0.0)
        return out / math.log(10)


ANSWER = "carrier bigint, docs binary, adds binary"


def answers(counted: DataFrame, asked: DataFrame, parts: int, shared) -> DataFrame:
    """(row, adds): what the context weights add to each asked document's score.

    counted: rows of COUNTED. asked: (carrier, part, keys, docs), docs holding how many rows before the carrier a key's document stands.
    shared: broadcast of an object with ``rank_class`` and ``share``.
    """
    sizes = {r["part"]: r["n"] for r in counted.groupBy("part").agg(F.sum("tokens").alias("n")).collect()}  # MOST_PARTS rows at most
    most = max(PART_TOKENS, sum(sizes.values()) // parts)
    lots = {p: -(-n // most) for p, n in sizes.items() if n > 2 * most}

    def lot_count() -> Column:
        if not lots:
            return F.lit(1).cast("bigint")
        table = F.create_map(*[F.lit(x) for kv in sorted(lots.items()) for x in kv])
        return F.coalesce(F.element_at(table, F.col("part")), F.lit(1)).cast("bigint")

    zero, own = F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")
    left = counted.withColumn("lot", F.explode(F.sequence(zero, lot_count() - 1)))
    left = left.select("part", "lot", own.alias("carrier"), "keys", F.col("counts").alias("x"))
    right = asked.select("part", F.pmod(F.xxhash64("carrier"), lot_count()).alias("lot"), "carrier", "keys", F.col("docs").alias("x"))
    both = left.unionByName(right)
    tasks = max(8, -(-(parts + sum(lots.values())) // SWEEPS))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        at, keys, counts, held, part = None, [], [], 0, None
        classes = shared.value.rank_class
        for f in frames:
            out = []
            for p, lot, carrier, k, x in zip(f["part"], f["lot"], f["carrier"], f["keys"], f["x"]):
                if (p, lot) != at:
                    at, keys, counts, held, part = (p, lot), [], [], 0, None
                ks = unpack_keys(k)
                if carrier < 0:
                    keys.append(ks)
                    counts.append(np.frombuffer(unpack(x), "<u4"))
                    held += len(ks)
                    if held >= 2 * FLUSH_KEYS and held >= 2 * len(keys[0]):
                        k2, c2 = merge(keys, counts)
                        keys, counts, held = [k2], [c2], len(k2)
                    continue
                if part is None:
                    part = Part(*merge(keys, counts), shared.value.share, classes)
                    keys, counts = [], []
                docs = unpack_docs(x)
                adds = np.bincount(docs, weights=part(ks))
                some = np.flatnonzero(adds)
                if len(some):
                    out.append((carrier, squeeze(some.astype("<u2").tobytes()), squeeze(adds[some].astype("<f4").tobytes())))
            if out:
                yield pd.DataFrame(out, columns=["carrier", "docs", "adds"])

    def total(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, sums = None, np.zeros(1 << 16)

        def done() -> pd.DataFrame:
            some = np.flatnonzero(sums)
            return pd.DataFrame({"row": at - some, "adds": sums[some]})

        for f in frames:
            for carrier, docs, adds in zip(f["carrier"], f["docs"], f["adds"]):
                if carrier != at:
                    if at is not None:
                        yield done()
                    at = carrier
                    sums[:] = 0
                sums[np.frombuffer(unpack(docs), "<u2")] += np.frombuffer(unpack(adds), "<f4")
        if at is not None:
            yield done()

    answered = None
    for sweep in range(SWEEPS):
        own_parts = both.where(F.pmod("part", F.lit(SWEEPS)) == sweep)
        found = own_parts.repartition(tasks, "part", "lot").sortWithinPartitions("part", "lot", "carrier").mapInPandas(run, ANSWER)
        found = written(found, "context-answers")
        release(counted.sparkSession)
        answered = found if answered is None else answered.unionByName(found)
    return answered.repartition("carrier").sortWithinPartitions("carrier", "docs", "adds").mapInPandas(total, "row bigint, adds double")
