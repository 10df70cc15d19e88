"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are normalised: lower case, every run of characters that are
neither letters nor digits becomes one space. An item of n characters has an error
budget of floor(n * rate) edits (insertions, deletions, substitutions) and is cut into
budget + 1 pieces of nearly equal length; a passage within the budget holds at least
one piece unchanged. One Aho-Corasick automaton over all pieces finds every exact piece
hit in a text; around each, Myers' bit-parallel algorithm computes the smallest edit
distance of the item to any substring, and the item is reported if that is within its
budget. The rate holds at every length; an item whose budget is 0 by it (under 13 characters) is one
piece that must occur as it stands, between word boundaries.

The test items are a stated query set: they are sent to the executors in blocks of
``block_bytes`` at most, one pass over the documents for each block, so that what a task
holds (some hundred bytes of automaton for each byte of a block) does not grow.

Defined cases: null and empty texts match nothing, nor do null items and items without
letters and digits; repeated rows and repeated items are each reported; of equally good
matches the first counts; a very long text is searched whole, its normalised copy being
what a task holds of it; an empty benchmark leaves everything clean, an empty table stays
empty; other columns are ignored by ``matches`` and kept, whatever their names, by
``keep_clean``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefmill.llm.common import bounded_batches, text_or_empty

RATE = 0.08
BLOCK_BYTES = 2 << 20
GAP = re.compile(r"[\W_]+")


def normalise(text: str) -> str:
    return GAP.sub(" ", text.lower()).strip()


def myers(masks: dict[str, int], n: int, text: str, budget: int) -> tuple[int, int] | None:
    """(distance, end) of the best match of an item of n characters in text, the first of equals; None beyond the budget."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best, end = budget + 1, -1
    get = masks.get
    for i, c in enumerate(text):
        eq = get(c, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        plus = down | (full & ~(diag | up))
        minus = up & diag
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        # a match may start anywhere: no carry into the lowest bit
        plus = plus << 1
        up = full & ((minus << 1) | ~(diag | plus))
        down = plus & diag & full
        if score < best:
            best, end = score, i + 1
            if not best:
                break
    return (best, end) if end >= 0 else None


class Matcher:
    """The pieces of a block of items, ready to search."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE) -> None:
        import ahocorasick

        self.items: list[tuple[int, str, int, dict[str, int], int]] = []
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, raw in items:
            text = normalise(raw)
            # without a budget an item is found as it stands, between word boundaries; without letters and digits it has no piece
            short = int(len(text) * rate) == 0
            body = f" {text} " if short else text
            n = len(body)
            if not text:
                continue
            budget = int(len(text) * rate)
            text = body
            masks: dict[str, int] = defaultdict(int)
            for i, c in enumerate(text):
                masks[c] |= 1 << i
            k = budget + 1
            for j in range(k):
                a, b = n * j // k, n * (j + 1) // k
                pieces[text[a:b]].append((len(self.items), a))
            self.items.append((number, text, budget, dict(masks), int(short)))
        self.find = None
        if pieces:
            self.find = ahocorasick.Automaton()
            for piece, where in pieces.items():
                self.find.add_word(piece, (len(piece), where))
            self.find.make_automaton()

    def __call__(self, raw: str) -> list[tuple[int, int, int, int]]:
        """(item number, distance, budget, end in the normalised text) of each item found, best match first of equals."""
        if self.find is None or not raw:
            return []
        text = f" {normalise(raw)} "
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (size, where) in self.find.iter(text):
            for item, offset in where:
                starts[item].add(end + 1 - size - offset)
        out = []
        for item, places in starts.items():
            number, body, budget, masks, pad = self.items[item]
            best: tuple[int, int] | None = None
            done = -1
            ordered = sorted(places)
            i = 0
            while i < len(ordered) and not (best and best[0] == 0):
                # hits whose windows touch are verified together
                j = i
                while j + 1 < len(ordered) and ordered[j + 1] - ordered[j] <= 2 * budget + len(body) // 2:
                    j += 1
                a = max(0, ordered[i] - budget)
                b = min(len(text), ordered[j] + len(body) + budget)
                if b > done:
                    got = myers(masks, len(body), text[a:b], budget if best is None else best[0] - 1)
                    if got:
                        best = (got[0], a + got[1])
                    done = b
                i = j + 1
            if best:
                # the text stands between two spaces that are not its own
                out.append((number, best[0], budget, min(max(best[1] - 1 - pad, 0), len(text) - 2)))
        return sorted(out)


def item_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items in lists of about block_bytes."""
    rows = benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield sorted(((r["i"], r["t"]) for r in part.collect()), key=lambda x: (x[0] is None, x))


HITS = T.ArrayType(
    T.StructType([T.StructField(c, T.LongType()) for c in ("at", "distance", "budget", "end")])
)


def hits(spark: SparkSession, items: list[tuple], rate: float = RATE, text: str = "text") -> Column:
    """An array of (at: position in items, distance, budget, end) for each text."""
    numbered = spark.sparkContext.broadcast([(k, t) for k, (_, t) in enumerate(items)])

    @F.pandas_udf(HITS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(numbered.value, rate)
        for texts in batches:
            yield pd.Series(
                [[dict(zip(("at", "distance", "budget", "end"), h)) for h in matcher(t)] for t in texts], dtype=object
            )

    return run(text_or_empty(text))


def matches(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    rate: float = RATE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(key, item, distance, budget, end): each test item that a document holds within its error budget.

    end: where the best match ends in the normalised text.
    """
    spark = bounded_batches(docs).sparkSession
    kind = dict(benchmark.dtypes)[item]
    out = None
    for items in item_blocks(benchmark, item, item_text, block_bytes):
        names = F.broadcast(spark.createDataFrame([(k, i) for k, (i, _) in enumerate(items)], f"at bigint, item {kind}"))
        found = docs.select(F.col(key).alias("k"), F.explode(hits(spark, items, rate, text)).alias("h"))
        found = found.select("k", "h.*").join(names, "at")
        found = found.select(
            F.col("k").alias(key), F.col("item").alias(item), F.col("distance").cast("int"), F.col("budget").cast("int"), "end"
        )
        out = found if out is None else out.unionByName(found)
    return out


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    rate: float = RATE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of docs that hold no test item."""
    bounded_batches(docs)
    for items in item_blocks(benchmark, item, item_text, block_bytes):
        docs = docs.where(F.size(hits(docs.sparkSession, items, rate, text)) == 0)
    return docs
