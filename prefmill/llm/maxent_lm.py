"""A hashed maximum-entropy language model with a class-factored softmax.

Tokens are words between ASCII white space, A-Z lowered, and one end after each text.
The probability of a token factors into that of its class and that of the token within
it: P(w | h) = P(class(w) | h) * P(w | class(w), h).

Classes: the end; 32 bands of the most frequent words; 63 classes of other frequent
words and 32 of all remaining ones, both by a hash of the word's last three bytes.
The class softmax has hashed features of the history h: the previous word (bigram), the
word before it (skip), the pair of both (trigram) and a bias, words being hashed to 256
buckets. Within a band the softmax over its words has bigram features and a bias;
within the other classes its one feature is the word, whose optimum is the closed form
(count + 0.1) / sum. Known are the most frequent words, ``KNOWN`` at most, met at least twice; a
word of the remaining classes is unseen with a share that Good-Turing's estimate sets
from singletons; all unseen words are one event. The probabilities of all events sum to 1 for every history.

Training: one pass counts words; another counts (history, class) and (history, word)
cells over all training texts, summed by blocks of histories. Distributed gradient
updates follow: in each round every block computes the gradient and the curvature of
its histories' penalised likelihood, updates the weights that only it uses and returns
those of shared weights, which the driver sums. This part of the model has a fixed size: 256 x 256
histories, 128 classes, 2048 words in bands, KNOWN words with counts.

A word of the bands and of the classes of other frequent words has a weight for each previous word it
follows in training, trained and kept by hashed blocks (``context_weights``); their number grows with
the distinct pairs of the corpus, and the distributions above are their starting shares.

Scoring reads each whole text once, in numpy batches; class distributions are computed
for the histories that occur. Words outside KNOWN meet their counts in a join.

Defined cases: a null text is empty and has one token, its end; repeated rows are scored
alike; a null key counts as the empty text for the split; without training tokens both
scores are 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefmill.llm import context_weights as context
from prefmill.llm.common import bounded_batches, release, remove, text_or_empty, written
from prefmill.llm.quality import held_out

FOLDS = 10
KNOWN = 1 << 17
BANDS, BAND = 32, 64
HEAD = BANDS * BAND
TAILS, RARES = 63, 32
CLASSES = 1 + BANDS + TAILS + RARES
TAIL0, RARE0 = 1 + BANDS, 1 + BANDS + TAILS
BUCKETS = 256
OWN = 192
PAIRS = 32
BLOCKS = 64
ROUNDS = 8
RIDGE = 2.0
STEP = 0.5
SLICE = 1 << 21
FLUSH = 1 << 18
TASK_TOKENS = 1 << 22


def suffix_hash(word: bytes) -> int:
    """The hash that classes and buckets of less frequent words go by."""
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word[-3:], 42)


def whole_hash(word: bytes) -> int:
    """The hash that a word goes by as the previous one in context weights."""
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word, 42)


class Index(dict):
    """Word to number; -1 for others. Lookups of known words stay in C."""

    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass
class Vocabulary:
    """The KNOWN most frequent words in order, their counts, and sums over all training tokens."""

    words: list[bytes]
    counts: np.ndarray
    total: int  # N
    distinct: int  # V
    ends: int
    rare_mass: np.ndarray  # over each rare class: sum of count + 0.1
    unseen: float  # share of unseen words among tokens outside ``words``
    index: Index = field(default_factory=Index)

    def prepare(self) -> "Vocabulary":
        """Lookup tables; made once in each worker."""
        n = len(self.words)
        self.index = Index(zip(self.words, range(n)))
        self.index[None] = n  # the end
        h = np.array([suffix_hash(w) for w in self.words], dtype=np.uint64)
        ids = np.arange(n)
        cls = np.where(ids < HEAD, 1 + ids // BAND, TAIL0 + (h % np.uint64(TAILS)).astype(np.int64) if n else 0)
        bucket = np.where(ids < OWN, 1 + ids, 1 + OWN + (h % np.uint64(BUCKETS - 1 - OWN)).astype(np.int64) if n else 0)
        # the end comes after the words: class 0, bucket 0
        self.cls = np.r_[cls, 0].astype(np.int64)
        self.bucket = np.r_[bucket, 0].astype(np.int64)
        smooth = self.counts + 0.1
        mass = np.bincount(cls, weights=smooth, minlength=CLASSES) if n else np.zeros(CLASSES)
        mass[RARE0:] = self.rare_mass
        self.mass = np.maximum(mass, 0.1)
        self.within = np.zeros(n + 1)
        if n:
            self.within[:n] = np.where(ids < HEAD, 0.0, np.log10(smooth) - np.log10(self.mass[cls]))
        self.base = np.log10((np.r_[self.counts, self.ends] + 0.1) / (self.total + 0.1 * (self.distinct + 1)))
        self.suffix: dict[bytes, int] = {}
        self.whole = np.array([whole_hash(w) for w in self.words] + [0], dtype=np.uint64)  # the end: 0
        order = np.lexsort((ids, cls))
        self.rank = np.empty(n, np.int64)
        self.rank[order] = ids
        self.rank_class = np.zeros(1 << context.RANK_BITS, np.uint8)
        self.rank_class[:n] = cls[order]
        return self

    def hashed(self, word: bytes) -> int:
        s = word[-3:]
        h = self.suffix.get(s)
        if h is None:
            if len(self.suffix) > 500_000:
                self.suffix.clear()
            h = self.suffix[s] = suffix_hash(s)
        return h


def sequences(texts: list[bytes], v: Vocabulary) -> Iterator[tuple]:
    """Slices of about SLICE bytes: (first document, n of each document, ids, history, class, positions and words outside v, hash of the previous word)."""
    at = 0
    while at < len(texts):
        docs, size, first = [], 0, at
        while at < len(texts) and (size < SLICE or not docs):
            docs.append(texts[at].lower().split())
            size += len(texts[at])
            at += 1
        lens = np.array([len(d) + 1 for d in docs])
        flat = [w for d in docs for w in (*d, None)]
        ids = np.fromiter(map(v.index.__getitem__, flat), np.int64, len(flat))
        end = np.cumsum(lens) - 1
        out = np.flatnonzero(ids < 0)
        words = [flat[i] for i in out.tolist()]
        h = np.fromiter(map(v.hashed, words), np.uint64, len(words))
        cls, bucket = v.cls[ids], v.bucket[ids]
        cls[out] = RARE0 + (h % np.uint64(RARES)).astype(np.int64)
        bucket[out] = 1 + OWN + (h % np.uint64(BUCKETS - 1 - OWN)).astype(np.int64)
        one = np.r_[0, bucket[:-1]]
        two = np.r_[0, 0, bucket[:-2]] if len(bucket) > 1 else np.zeros(len(bucket), np.int64)
        two[end[:-1] + 1] = 0  # nothing of the text before
        whole = v.whole[ids]
        whole[out] = np.fromiter(map(whole_hash, words), np.uint64, len(words))
        yield first, lens, ids, one * BUCKETS + two, cls, out, words, np.r_[v.whole[-1:], whole[:-1]]


def context_keys(v: Vocabulary, bits: int, ids: np.ndarray, history: np.ndarray, previous: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of vocabulary words, their keys of context weights)."""
    at = np.flatnonzero((ids >= 0) & (ids < len(v.words)))
    high = previous[at] >> np.uint64(64 - bits) << np.uint64(context.LOW_BITS)
    return at, high | (history[at] // BUCKETS << context.RANK_BITS | v.rank[ids[at]]).astype(np.uint64)


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter[bytes] = Counter()
    for f in frames:
        for t in f["t"]:
            held.update(t.encode("utf-8", "surrogatepass").lower().split())
            if len(held) >= FLUSH:
                yield pd.DataFrame({"w": list(held), "n": list(held.values())})
                held.clear()
    yield pd.DataFrame({"w": list(held), "n": np.array(list(held.values()), dtype=np.int64)})


def word_counts(train: DataFrame, text: str = "text") -> DataFrame:
    """(w binary, n): each word's occurrences, summed in the tasks before the shuffle."""
    return train.select(text_or_empty(text).alias("t")).mapInPandas(_count, "w binary, n bigint").groupBy("w").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """counts: word_counts of the training texts, ``ends`` of them."""
    n, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    # a word met once stands for what is yet to be met, so it is never among the known
    step = F.floor(F.log2("n") * 16)  # counts in sixteenths of octaves: some thousand values at most
    steps = sorted(((r["s"], r["v"]) for r in counts.where("n > 1").groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("v")).collect()), reverse=True)
    least, room = None, KNOWN
    for s, v in steps:
        room -= v
        if room < 0:
            break
        least = s
    is_known = (F.col("n") > 1) & (step >= F.lit(least)) if least is not None else F.lit(False)
    top = counts.where(is_known).select("w", "n").toArrow()  # at most KNOWN rows
    order = sorted(zip((-n for n in top.column("n").to_pylist()), top.column("w").to_pylist()))
    words, known = [w for _, w in order], np.array([-n for n, _ in order], dtype=np.int64)
    rare = np.zeros(RARES)
    out = counts.where(~is_known)
    tail = F.when(F.octet_length("w") < 3, F.col("w")).otherwise(F.substring("w", -3, 3))
    # the hash modulo a power of two: its lowest bits, whatever its sign
    cls = F.xxhash64(tail).bitwiseAND(F.lit(RARES - 1))
    sums = out.groupBy(cls.alias("k")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("n") == 1).alias("once"), F.max("n").alias("most")
    ).collect()
    for r in sums:
        rare[r["k"]] = r["n"] + 0.1 * r["v"]
    unseen = 0.5
    if sums:
        # Good-Turing: words met once give the mass of unseen ones, those met m + 1 times that of the rest met m times
        tokens, once, most = sum(r["n"] for r in sums), sum(r["once"] for r in sums), max(r["most"] for r in sums)
        above = counts.where(F.col("n") == most + 1).count()
        unseen = min(0.9, max(0.02, once / (tokens + (most + 1) * above)))
    return Vocabulary(words, known, int(n or 0) + ends, int(distinct) + (1 if ends else 0), ends, rare, unseen)


def pack_cells(cells: np.ndarray) -> tuple[bytes, bytes]:
    """The cells that count something, compressed: gaps between them, and their counts."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    at = np.flatnonzero(cells)
    gaps = np.diff(np.r_[-1, at]).astype("<u4")
    return pack(gaps.tobytes()), pack(cells[at].astype("<i8").tobytes())


CELLS, CONTEXT = 0, 1
COUNTED = "kind int, " + context.COUNTED


def _cells(v: Vocabulary, bits: int, parts: int):
    """Training texts -> packed counts: cells of (history, class) and (previous bucket, band word) by block, context keys by part."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v.prepare()
        names = ["kind", "part", "tokens", "keys", "counts"]
        contexts = context.Counting(v.rank_class, parts)
        n = len(v.words)
        wide = BUCKETS * BUCKETS * CLASSES
        cells = np.zeros(wide + BUCKETS * HEAD, np.uint32)
        one = cells.dtype.type(1)
        for f in frames:
            for _, _, ids, history, cls, _, _, previous in sequences([t.encode("utf-8", "surrogatepass") for t in f["t"]], v):
                np.add.at(cells, history * CLASSES + cls, one)
                band = (ids >= 0) & (ids < min(HEAD, n))
                np.add.at(cells, wide + history[band] // BUCKETS * HEAD + ids[band], one)
                found = [(CONTEXT, *x) for x in contexts.add(context_keys(v, bits, ids, history, previous)[1])]
                if found:
                    yield pd.DataFrame(found, columns=names)
        per, head = wide // BLOCKS, BUCKETS * HEAD // BLOCKS
        out = []
        for b in range(BLOCKS):
            part = np.concatenate([cells[b * per : (b + 1) * per], cells[wide + b * head : wide + (b + 1) * head]])
            if part.any():
                out.append((CELLS, b, 0, *pack_cells(part)))
        out += [(CONTEXT, *x) for x in contexts.flush()]
        yield pd.DataFrame(out, columns=names)

    return run


def _sum_cells(last: bool):
    """Packed counts sorted by block and lot -> their sums: packed again, or at last as plain cells of a block."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        plain = zstandard.ZstdDecompressor().decompress
        size = (BUCKETS * BUCKETS * CLASSES + BUCKETS * HEAD) // BLOCKS
        key, total = None, np.zeros(size, np.int64)

        def done() -> pd.DataFrame:
            if last:
                return pd.DataFrame({"block": [key[0]], "cells": [total.astype("<i8").tobytes()]})
            return pd.DataFrame([(key[0], *pack_cells(total))], columns=["block", "gaps", "counts"])

        for f in frames:
            for b, lot, gaps, counts in zip(f["block"], f["lot"], f["gaps"], f["counts"]):
                if (b, lot) != key:
                    if key is not None:
                        yield done()
                    key = (b, lot)
                    total[:] = 0
                at = np.cumsum(np.frombuffer(plain(gaps), "<u4").astype(np.int64)) - 1
                total[at] += np.frombuffer(plain(counts), "<i8")
        if key is not None:
            yield done()

    return run


def sum_blocks(packed: DataFrame, tokens: int) -> DataFrame:
    """(block, cells): all packed counts of a block added up, in two steps with about the root of their number in each."""
    lots = max(1, math.isqrt(tokens // TASK_TOKENS))
    lot = F.pmod(F.spark_partition_id(), F.lit(lots)).alias("lot")
    first = packed.select("block", lot, "gaps", "counts").repartition("block", "lot").sortWithinPartitions("block", "lot")
    part = first.mapInPandas(_sum_cells(False), "block int, gaps binary, counts binary")
    rest = part.select("block", F.lit(0).alias("lot"), "gaps", "counts").repartition(BLOCKS, "block").sortWithinPartitions("block")
    return rest.mapInPandas(_sum_cells(True), "block int, cells binary")


@dataclass
class Weights:
    """bias and skip weights are shared; bigram, pair and band weights belong to the block of their previous word."""

    bias: np.ndarray  # CLASSES
    skip: np.ndarray  # BUCKETS x CLASSES
    bigram: np.ndarray  # BUCKETS x CLASSES
    pair: np.ndarray  # BUCKETS x PAIRS x CLASSES
    band_bias: np.ndarray  # HEAD
    band: np.ndarray  # BUCKETS x HEAD


def pair_feature(two: np.ndarray) -> np.ndarray:
    """The hash of the word before the previous one within the previous one's pair features."""
    return (two * 0x9E37 >> 5) % PAIRS


def class_logits(w: Weights, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return w.bias + w.bigram[one] + w.skip[two] + w.pair[one, pair_feature(two)]


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def gradient(block: int, cells: np.ndarray, w: Weights) -> dict[str, np.ndarray]:
    """New weights of the block's own features; gradient and curvature of the shared ones; the log likelihood."""
    rows = BUCKETS // BLOCKS
    one = np.arange(block * rows, (block + 1) * rows)
    split = rows * BUCKETS * CLASSES
    seen = cells[:split].reshape(rows, BUCKETS, CLASSES).astype(float)
    words = cells[split:].reshape(rows, BANDS, BAND).astype(float)
    two = np.arange(BUCKETS)
    logp = log_softmax(class_logits(w, np.repeat(one, BUCKETS), np.tile(two, rows))).reshape(rows, BUCKETS, CLASSES)
    p = np.exp(logp)
    n = seen.sum(axis=2, keepdims=True)
    g = seen - n * p
    h = n * p * (1 - p)
    out = {"loss": np.array([(seen * logp).sum()]), "skip_g": g.sum(axis=0), "skip_h": h.sum(axis=0)}

    def step(old: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return old + STEP * np.clip((g - RIDGE * old) / (h + RIDGE), -2, 2)

    out["bigram"] = step(w.bigram[one], g.sum(axis=1), h.sum(axis=1))
    pg, ph = np.zeros((rows, PAIRS, CLASSES)), np.zeros((rows, PAIRS, CLASSES))
    np.add.at(pg, (slice(None), pair_feature(two)), g)
    np.add.at(ph, (slice(None), pair_feature(two)), h)
    out["pair"] = step(w.pair[one], pg, ph)
    q = np.exp(log_softmax((w.band_bias + w.band[one]).reshape(rows, BANDS, BAND)))
    m = words.sum(axis=2, keepdims=True)
    band = step(w.band[one].reshape(rows, BANDS, BAND), words - m * q, m * q * (1 - q))
    out["band"] = band.reshape(rows, HEAD)
    return {k: x.astype(np.float32) if k not in SHARED else x for k, x in out.items()}


SHARED = ("loss", "skip_g", "skip_h")


def train(blocks: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> tuple[Weights, list[float]]:
    """Weights after ``rounds`` of gradient updates over blocks (block, cells), and the log likelihood before each."""
    spark = blocks.sparkSession
    zero = np.zeros
    head = np.full(HEAD, -30.0)  # slots without a word
    k = min(HEAD, len(v.words))
    head[:k] = np.log(v.counts[:k] + 0.1)
    small = lambda *shape: zero(shape, np.float32)
    w = Weights(zero(CLASSES), zero((BUCKETS, CLASSES)), small(BUCKETS, CLASSES), small(BUCKETS, PAIRS, CLASSES), head, small(BUCKETS, HEAD))
    freq = np.bincount(v.cls[:-1], weights=v.counts, minlength=CLASSES) if len(v.words) else zero(CLASSES)
    freq[0] = v.ends
    freq[RARE0:] = v.rare_mass
    w.bias = np.log((freq + 0.5) / (freq + 0.5).sum())
    history = []
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(w)

        def update(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            names = ["block", "name", "x"]
            sums: dict[str, np.ndarray] = {}
            for f in frames:
                for b, cells in zip(f["block"], f["cells"]):
                    got = gradient(int(b), np.frombuffer(cells, "<i8"), sent.value)
                    for name in SHARED:  # summed in the task: one row each
                        sums[name] = sums.get(name, 0.0) + got.pop(name)
                    yield pd.DataFrame([(int(b), name, x.tobytes()) for name, x in got.items()], columns=names)
            if sums:
                yield pd.DataFrame([(-1, name, x.tobytes()) for name, x in sums.items()], columns=names)

        # BLOCKS x 3 rows of at most 66 KB, and 3 rows a task
        rows = blocks.mapInPandas(update, "block int, name string, x binary").toArrow().to_pylist()
        sent.unpersist()
        size = BUCKETS // BLOCKS
        shared = {n: 0.0 for n in SHARED}
        for r in sorted(rows, key=lambda r: (r["block"], r["name"], r["x"])):
            if r["name"] in SHARED:
                shared[r["name"]] = shared[r["name"]] + np.frombuffer(r["x"], "<f8")
            else:
                own = getattr(w, r["name"])
                own[r["block"] * size : (r["block"] + 1) * size] = np.frombuffer(r["x"], "<f4").reshape(size, *own.shape[1:])
        if not rows:
            break
        history.append(float(shared["loss"][0]))
        g, h = shared["skip_g"].reshape(BUCKETS, CLASSES), shared["skip_h"].reshape(BUCKETS, CLASSES)
        w.skip = w.skip + STEP * np.clip((g - RIDGE * w.skip) / (h + RIDGE), -2, 2)
        w.bias = w.bias + STEP / 2 * np.clip(g.sum(axis=0) / (h.sum(axis=0) + RIDGE), -2, 2)
    return w, history


@dataclass
class Model:
    vocabulary: Vocabulary
    weights: Weights
    likelihoods: list[float]
    bits: int  # of a previous word's hash in context keys
    parts: int


class Shares:
    """What the parts of the context weights start from: each word's share within its class, by rank and previous bucket."""

    def __init__(self, model: Model) -> None:
        v = model.vocabulary.prepare()
        n = len(v.words)
        self.rank_class = v.rank_class
        self.within = np.zeros(n)
        self.within[v.rank] = 10.0 ** v.within[:n]
        self.band = band_shares(model.weights)  # band words have their numbers as ranks
        v.index.clear()

    def share(self, keys: np.ndarray) -> np.ndarray:
        low = keys.astype(np.int64) & ((1 << context.LOW_BITS) - 1)
        rank, bucket = low & ((1 << context.RANK_BITS) - 1), low >> context.RANK_BITS
        u = self.within[rank]
        band = rank < HEAD
        u[band] = 10.0 ** self.band[bucket[band], rank[band]]
        return u


def band_shares(w: Weights) -> np.ndarray:
    """log10 of each band word's share within its band, by previous bucket."""
    bands = (w.band_bias + w.band).reshape(BUCKETS, BANDS, BAND)
    return (log_softmax(bands) / math.log(10)).reshape(BUCKETS, HEAD)


def fit(train_docs: DataFrame, text: str = "text") -> tuple[Model, DataFrame, DataFrame]:
    """The model, all word counts of train_docs and the counts of its context keys (both written to the shared folder)."""
    counts = written(word_counts(train_docs, text), "word-counts")
    v = vocabulary(counts, train_docs.count())
    v.prepare()
    sent = Vocabulary(v.words, v.counts, v.total, v.distinct, v.ends, v.rare_mass, v.unseen)
    shared = train_docs.sparkSession.sparkContext.broadcast(sent)
    bits, parts = context.context_bits(v.distinct), context.part_count(v.total)
    release(train_docs.sparkSession)

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _cells(shared.value, bits, parts)(frames)

    found = written(train_docs.select(text_or_empty(text).alias("t")).mapInPandas(cells, COUNTED), "counted")
    packed = found.where(F.col("kind") == CELLS).select(F.col("part").alias("block"), F.col("keys").alias("gaps"), "counts")
    blocks = sum_blocks(packed, v.total)
    weights, likelihoods = train(written(blocks, "cells").coalesce(8), v)
    v.index.clear()
    return Model(sent, weights, likelihoods, bits, parts), counts, found.where(F.col("kind") == CONTEXT).drop("kind")


class Scorer:
    """Scores batches of texts; class distributions are kept for the histories met so far."""

    def __init__(self, model: Model) -> None:
        self.model, self.v, self.w = model, model.vocabulary.prepare(), model.weights
        self.done = np.zeros(BUCKETS * BUCKETS, bool)
        self.table = np.zeros((BUCKETS * BUCKETS, CLASSES), np.float32)
        self.unseen = np.zeros(BUCKETS * BUCKETS)  # log10 of the probability of an unseen word
        self.band = band_shares(self.w)
        self.bits = model.bits
        # unseen words exist only where something is rare; else that mass stays with the rare classes
        self.seen_share = math.log10(1 - self.v.unseen)

    def histories(self, history: np.ndarray) -> None:
        new = np.unique(history)
        new = new[~self.done[new]]
        for k in range(0, len(new), 8192):
            part = new[k : k + 8192]
            logp = log_softmax(class_logits(self.w, part // BUCKETS, part % BUCKETS)) / math.log(10)
            self.table[part] = logp
            self.unseen[part] = np.log10(self.v.unseen * (10.0 ** logp[:, RARE0:]).sum(axis=1))
        self.done[new] = True

    def __call__(self, texts: list[bytes]) -> Iterator[tuple]:
        """(tokens, known, base, score) of each text without its words outside the vocabulary, and those: (text, word, class, times, if seen, if unseen); the keys of context weights and their texts."""
        v, n = self.v, len(self.v.words)
        for first, lens, ids, history, cls, out, words, previous in sequences(texts, v):
            self.histories(history)
            of = np.repeat(np.arange(len(lens)), lens)
            lp = self.table[history, cls].astype(float) + v.within[ids]
            band = (ids >= 0) & (ids < min(HEAD, n))
            lp[band] += self.band[history[band] // BUCKETS, ids[band]]
            base = v.base[ids]
            inside = ids >= 0
            seen, unseen = lp[out] - v.within[ids[out]] + self.seen_share, self.unseen[history[out]]
            lp[out] = base[out] = 0.0
            known = inside if v.ends else np.zeros(len(ids), bool)
            add = lambda x: np.bincount(of, weights=x, minlength=len(lens))
            held: dict[tuple[int, bytes], list] = {}
            for d, w, c, a, b in zip(of[out].tolist(), words, cls[out].tolist(), seen.tolist(), unseen.tolist()):
                x = held.get((d, w))
                if x is None:
                    held[d, w] = [c, 1, a, b]
                else:
                    x[1] += 1
                    x[2] += a
                    x[3] += b
            at, keys = context_keys(v, self.bits, ids, history, previous)
            yield first, lens, add(known).astype(np.int64), add(base), add(lp), held, keys, first + of[at]


RARE_TYPE = pa.struct([("w", pa.binary()), ("c", pa.int32()), ("m", pa.int64()), ("seen", pa.float64()), ("unseen", pa.float64())])


ASKED_TYPE = pa.struct([("part", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary())])


def asked(keys: list[np.ndarray], docs: list[np.ndarray], model: Model) -> Iterator[tuple[int, bytes, bytes]]:
    """Keys and the distance of their documents from the batch's last row, sorted and packed for each part."""
    k, d = np.concatenate(keys), np.concatenate(docs).astype("<u2")
    order = np.argsort(k)
    k, d = k[order], d[order]
    for part, at in context.split(k, model.vocabulary.rank_class, model.parts):
        yield (part, *context.pack(k[at]), context.pack_docs(d[at]))


def score(docs: DataFrame, model: Model, counts: DataFrame, contexts: DataFrame, key: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score): a row for each row of docs.

    The table behind ``contexts`` is deleted once its weights have scored all rows.
    """
    v = model.vocabulary
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column("t").to_pylist()]
            tokens, known, base, total = [], [], [], []
            fields: list[list] = [[], [], [], [], []]
            offsets = [0]
            keys, of, parts = [], [], []
            last = len(texts) - 1
            for _, lens, k, b, s, held, ck, cd in scorer(texts):
                keys.append(ck)
                of.append(last - cd)
                if sum(map(len, keys)) >= context.FLUSH_KEYS:
                    parts += asked(keys, of, scorer.model)
                    keys, of = [], []
                tokens += lens.tolist()
                known += k.tolist()
                base += b.tolist()
                total += s.tolist()
                times = np.zeros(len(lens), np.int64)
                for (d, w), (c, m, x, y) in held.items():  # in order of documents
                    times[d] += 1
                    for column, value in zip(fields, (w, c, m, x, y)):
                        column.append(value)
                offsets += (offsets[-1] + np.cumsum(times)).tolist()
            rare = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(fields, RARE_TYPE)], fields=list(RARE_TYPE))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rare)
            if keys:
                parts += asked(keys, of, scorer.model)
            packed = pa.StructArray.from_arrays([pa.array([x[i] for x in parts], f.type) for i, f in enumerate(ASKED_TYPE)], fields=list(ASKED_TYPE))
            # the batch's last row carries the keys of all its rows
            carried = pa.ListArray.from_arrays(pa.array([0] * len(texts) + [len(parts)], pa.int32()), packed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("held_out"), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(total, pa.float64()), lists, carried],
                ["k", "held_out", "n_tokens", "n_known", "base", "total", "rare", "asked"],
            )

    kind = dict(docs.dtypes)[key]
    ddl = (
        f"k {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, total double, "
        "rare array<struct<w binary, c int, m bigint, seen double, unseen double>>, asked array<struct<part int, keys binary, docs binary>>"
    )
    rows = docs.select(F.col(key).alias("k"), held_out(key, folds).alias("held_out"), text_or_empty(text).alias("t"))
    # the row numbers are fixed by writing them
    scored = written(rows.mapInArrow(run, ddl).withColumn("row", F.monotonically_increasing_id()), "scored")
    release(docs.sparkSession)
    shares = docs.sparkSession.sparkContext.broadcast(Shares(model))
    questions = scored.where(F.size("asked") > 0).select(F.col("row").alias("carrier"), F.explode("asked").alias("a")).select("carrier", "a.*")
    adds = written(context.answers(contexts, questions, model.parts, shares), "context-scores")
    remove(contexts)  # nothing reads the counts again
    release(docs.sparkSession)
    mass = F.array(*[F.lit(float(x)) for x in np.maximum(v.rare_mass, 0.1)])
    zero = F.log10(F.lit(0.1) / F.lit(v.total + 0.1 * (v.distinct + 1)))
    n = F.col("n") + 0.1
    hit = F.col("n").isNotNull()
    rare = (
        scored.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(counts, "w", "left")
        .select(
            "row",
            F.when(hit, F.col("m")).otherwise(0).alias("known"),
            (F.col("m") * F.when(hit, F.log10(n / F.lit(v.total + 0.1 * (v.distinct + 1)))).otherwise(zero)).alias("base2"),
            F.when(hit, F.col("seen") + F.col("m") * (F.log10(n) - F.log10(F.element_at(mass, F.col("c") - RARE0 + 1)))).otherwise(F.col("unseen")).alias("total2"),
        )
        .groupBy("row").agg(F.sum("known").alias("known"), F.sum("base2").alias("base2"), F.sum("total2").alias("total2"))
    )
    none = F.lit(0.0)
    both = scored.drop("rare", "asked").join(rare, "row", "left").join(adds, "row", "left")
    some = F.lit(v.total > 0)
    return both.select(
        F.col("k").alias(key), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("bigint").alias("n_known"), F.lit(v.total).cast("bigint").alias("train_tokens"),
        F.when(some, F.col("base") + F.coalesce("base2", none)).otherwise(none).alias("base_score"),
        F.when(some, F.col("total") + F.coalesce("total2", none) + F.coalesce("adds", none)).otherwise(none).alias("score"),
    )


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    """Learn from the rows that are not held out, score all."""
    bounded_batches(docs)
    model, counts, contexts = fit(docs.where(~held_out(key, folds)), text)
    return score(docs, model, counts, contexts, key, text, folds)
