"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Documents with equal texts form a group, and groups are what is placed. Each text is read
once, for a light table of some 70 bytes a row. The groups' sizes are sums over it, and at
most ``5 * units`` units a shard are made of them, whatever the input:

* a group of at least 1/(shards * units) of all bytes is a unit of its own; only one above a
  shard's fair share of the bytes, tokens or rows, which no shard can take whole, is cut
  into pieces of 1/units of that share, its rows being dealt by their number;
* all smaller groups are hashed into shards * units bundles whose expected sizes grow
  linearly from almost nothing, so that the last ones placed level what is left. A
  bundle holds whole groups.

The units' (bytes, tokens, rows) go to the driver, a bounded list, and are placed in
descending order, each into the shard where the dot product of its size with the
residual capacity is highest among those with room for it in every dimension. Swaps
between the fullest and the emptiest shard then level the bytes, as far as they leave
tokens and rows no further apart than SLACK of a shard's share or than they were. The
assignment, again bounded, is broadcast to the light rows. Slots come from counts per
(shard, bucket of row numbers) and a ranking within those.

Law: ``bytes``. Defined cases: a null text has no bytes and equals the empty text; rows
with equal keys and texts are told apart by their row number, so that they spread like
others where their group is cut, and get different slots; units of equal size are placed in
the order of their group's digest; a text longer than a shard's share is a shard's
largest unit; an empty table gives an empty result; columns named like a result column are
replaced, all others are kept whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from prefmill.llm.common import boxed, text_digest, text_or_empty, written

SHARDS = 40
UNITS = 256
OVERHEAD = 16
SLOT_BUCKETS = 256
SLACK = 0.01
RESULT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def place(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unit; sizes: (units, dimensions), any order."""
    total = sizes.sum(axis=0)
    scale = np.where(total > 0, total, 1.0)
    need = sizes / scale * shards  # a shard's fair share is 1 in each dimension
    residual = np.ones((shards, sizes.shape[1]))
    out = np.zeros(len(sizes), dtype=np.int64)
    # by the largest dimension, ties by position: the same order on every run
    for i in np.lexsort((np.arange(len(sizes)), -need.max(axis=1))):
        room = (residual >= need[i] - 1e-12).all(axis=1)
        score = residual @ need[i]
        # where none has room in every dimension, the one with the most bytes left
        k = int(np.argmax(np.where(room, score, -np.inf))) if room.any() else int(np.argmax(residual[:, 0]))
        out[i] = k
        residual[k] -= need[i]
    return level(need, out, shards)


def level(need: np.ndarray, at: np.ndarray, shards: int, rounds: int = 2000) -> np.ndarray:
    """Swap units between the fullest and the emptiest shard while that narrows the gap in bytes (dimension 0).

    need: sizes as shares of a shard. A swap may leave another dimension of the two
    shards off their share by SLACK, or by what it was off before.
    """
    at = at.copy()
    load = np.stack([np.bincount(at, weights=x, minlength=shards) for x in need.T], axis=1)
    for _ in range(rounds if len(need) else 0):
        hi, lo = int(np.argmax(load[:, 0])), int(np.argmin(load[:, 0]))
        gap = load[hi, 0] - load[lo, 0]
        a, b = np.flatnonzero(at == hi), np.flatnonzero(at == lo)
        b = b[np.argsort(need[b, 0], kind="stable")]
        give = np.concatenate([np.zeros((1, need.shape[1])), need[b]])  # giving nothing back counts too
        j = np.searchsorted(give[:, 0], need[a, 0] - gap / 2)
        off = np.maximum(np.abs(load[[hi, lo], 1:] - 1).max(axis=0), SLACK)
        best = (gap * (1 - 1e-9), -1, -1)
        for d in range(-4, 4):  # those whose bytes differ by about half the gap
            k = np.clip(j + d, 0, len(give) - 1)
            moved = need[a] - give[k]
            left = np.abs(gap - 2 * moved[:, 0])
            fits = ((np.abs(load[hi, 1:] - moved[:, 1:] - 1) <= off) & (np.abs(load[lo, 1:] + moved[:, 1:] - 1) <= off)).all(axis=1)
            left = np.where(fits, left, np.inf)
            if len(left) and left.min() < best[0]:
                m = int(left.argmin())
                best = (float(left[m]), m, int(k[m]))
        if best[1] < 0:
            break
        moved = need[a[best[1]]] - give[best[2]]
        at[a[best[1]]] = lo
        if best[2]:
            at[b[best[2] - 1]] = hi
        load[hi] -= moved
        load[lo] += moved
    return at


def _placed(light: DataFrame, shards: int, units: int) -> DataFrame:
    """light (row, size, tokens, g) with its shard."""
    spark = light.sparkSession
    groups = light.groupBy("g").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    groups = written(groups, "shard-groups")
    dims = ("bytes", "tokens", "rows")
    sums = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in dims]).first()
    n_bundles = shards * units
    least = max(1, -(-sums["bytes"] // n_bundles))
    heavy = groups.where(F.col("bytes") >= least).collect()  # at most shards * units rows
    fair = lambda r: max(r[c] * shards / sums[c] for c in dims)
    pieces = [(bytes(r["g"]), min(math.ceil(fair(r) * units), r["rows"]) if fair(r) > 1 else 1, r) for r in sorted(heavy, key=lambda r: bytes(r["g"]))]
    # a bundle's share grows with its number: sqrt of a uniform hash
    u = F.pmod(F.xxhash64("g"), F.lit(1 << 20)).cast("double") / (1 << 20)
    bundle = F.least(F.floor(F.sqrt(u) * n_bundles), F.lit(n_bundles - 1)).cast("bigint")
    bundles = groups.where(F.col("bytes") < least).groupBy(bundle.alias("unit")).agg(*[F.sum(c).alias(c) for c in dims])
    sizes = sorted(tuple(r) for r in bundles.collect())  # at most shards * units rows
    # a heavy group's units are below zero: its number, and the piece's
    first = lambda i: -(i << 32) - 1
    sizes += [(first(i), *(r[c] for c in dims)) for i, (_, p, r) in enumerate(pieces) if p == 1]
    table = F.broadcast(spark.createDataFrame([(g, p, first(i)) for i, (g, p, _) in enumerate(pieces)], "g binary, pieces int, first bigint"))
    rows = light.join(table, "g", "left")
    piece = F.col("first") - F.pmod(F.xxhash64("row", F.lit(7)), F.col("pieces"))
    rows = rows.withColumn("unit", F.when(F.col("first").isNull(), bundle).otherwise(piece))
    if any(p > 1 for _, p, _ in pieces):  # pieces at their real sizes: at most 3 * shards * units rows and a row more for each group
        parts = rows.where("pieces > 1").groupBy("unit").agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1)))
        sizes += sorted(tuple(r) for r in parts.collect())
    at = place(np.array([s[1:] for s in sizes], dtype=float).reshape(-1, 3), shards)
    plan = spark.createDataFrame([(int(s[0]), int(k)) for s, k in zip(sizes, at)], "unit bigint, shard int")
    return rows.join(F.broadcast(plan), "unit")


def _numbered(placed: DataFrame) -> DataFrame:
    """placed (row, shard ...) with slot: gapless from 0 in each shard."""
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("row", F.lit(11)), F.lit(SLOT_BUCKETS)).cast("int"))
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))  # at most shards * SLOT_BUCKETS rows
    prior = W.Window.partitionBy("shard").orderBy("bucket").rowsBetween(W.Window.unboundedPreceding, -1)
    start = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(prior), F.lit(0)).alias("start"))
    rank = F.row_number().over(W.Window.partitionBy("shard", "bucket").orderBy("row"))
    ranked = placed.withColumn("rank", rank).join(F.broadcast(start), ["shard", "bucket"])
    return ranked.withColumn("slot", (F.col("start") + F.col("rank") - 1).cast("bigint"))


def assign(docs: DataFrame, shards: int = SHARDS, units: int = UNITS, key: str = "doc_id", text: str = "text", keep: bool = True) -> DataFrame:
    """docs with size, text_crc32, law, shard, slot and grown_shard.

    size: UTF-8 bytes of the text plus 16. keep=False returns only the key and those.
    """
    body = text_or_empty(text)
    tokens = (F.length(body) - F.length(F.translate(body, " \n\t\r", "")) + 1).cast("bigint").alias("tokens")
    size = (F.octet_length(body) + F.lit(OVERHEAD)).cast("bigint").alias("size")
    crc = F.crc32(F.encode(body, "UTF-8")).alias("text_crc32")
    number = F.monotonically_increasing_id().alias("row")  # fixed by writing it
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    if not keep:
        light = written(docs.select(number, F.col(key).alias("id"), size, crc, tokens, text_digest(text).alias("g")), "shard-rows")
        out = _numbered(_placed(light, shards, units))
        return out.select(F.col("id").alias(key), "size", "text_crc32", law, "shard", "slot", grown)
    names = [c for c in docs.columns if c not in RESULT]
    whole = written(docs.select(number, boxed(docs.select(*[f"`{c}`" for c in names])).alias("d"), size, crc, tokens, text_digest(text).alias("g")), "shard-rows")
    out = _numbered(_placed(whole.drop("d", "text_crc32"), shards, units)).select("row", "shard", "slot")
    return whole.join(out, "row").select("d.*", "size", "text_crc32", law, "shard", "slot", grown)
