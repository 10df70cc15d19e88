"""Mixing sources to target weights over a domain - language - source tree.

Weights run down the tree: a node's share of its parent's budget is its weight over the
weights of its siblings that have data. A node cannot give more than ``epochs`` times
the tokens it holds; what it falls short of goes to its siblings by weight, and only
when a whole family is short does the rest reach the family's own siblings, one level up
at a time. Budgets are whole tokens and sum to the target, or to all that nodes of positive weight hold.

A leaf's budget is then read off seeded epochs: every epoch is the leaf's documents in
the order of a hash of seed, epoch and key, whole epochs are taken first, and the last
one gives the prefix of tokens still missing; the document on its edge gives only part.

The budgets need one row for each leaf on the driver: the tree whose weights a caller
names, not something that grows with the documents. The prefix is found in two steps:
token sums over 1024 hash ranges of each leaf name the range with the edge, and only
rows in that range are ordered, so a leaf with a third of all rows is no hot spot.

Defined cases: a null text has no tokens and stays with 0 copies and 0 tokens of part;
null levels count as "(none)"; a source that no domain claims is in "other"; rows with
equal keys are ordered by their text's checksum, repeated rows among themselves in any
order; a very long text on the edge gives part of its tokens; an empty table gives an
empty result; other columns are ignored by ``select`` and kept, whatever their names, by
``keep_mixed``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from prefmill.llm.common import boxed, text_or_empty, written

SEED = 20
EPOCHS = 4
SHARE = 0.5
RANGES = 1024
BROADCAST_LEAVES = 20_000
#: Which sources belong to which domain.
DOMAINS = {
    "web": ("src0", "src1", "src2", "src3", "src4", "src5", "src6", "src7"),
    "reference": ("src8", "src9", "src10", "src11"),
    "books": ("src12", "src13", "src14", "src15"),
    "forum": ("src16", "src17", "src18"),
}
#: Target weights by path; a path that is not named weighs 1.
WEIGHTS: dict[tuple[str, ...], float] = {
    ("web",): 4.0,
    ("reference",): 3.0,
    ("books",): 2.0,
    ("forum",): 1.0,
    ("other",): 0.5,
    ("web", "en"): 3.0,
    ("reference", "en"): 3.0,
    ("books", "en"): 2.0,
    ("web", "en", "src0"): 2.0,
}


def word_count(text: str = "text") -> Column:
    """Words between ASCII white space."""
    flat = F.trim(F.translate(text_or_empty(text), "\t\n\x0b\x0c\r", "     "))
    return F.when(flat == "", F.lit(0)).otherwise(F.size(F.split(flat, " +"))).cast("bigint")


def domain_of(source: str = "source", domains: Mapping[str, Sequence[str]] = DOMAINS) -> Column:
    out = F.lit("other")
    for name, sources in domains.items():
        out = F.when(F.col(source).isin(*sources), name).otherwise(out)
    return out


def fill(budget: int, capacity: Mapping[str, int], weight: Mapping[str, float]) -> dict[str, int]:
    """Split budget by weight, none above its capacity; whole numbers that sum to min(budget, all capacities)."""
    out = {k: 0 for k in capacity}
    open_ = {k for k in capacity if capacity[k] > 0 and weight[k] > 0}
    left = min(budget, sum(capacity[k] for k in open_))
    while left and open_:
        total = sum(weight[k] for k in open_)
        full = {k for k in open_ if left * weight[k] / total >= capacity[k]}
        if full:  # these give all they have; the others share what that leaves
            for k in full:
                out[k] = capacity[k]
            left -= sum(capacity[k] for k in full)
            open_ -= full
            continue
        exact = {k: left * weight[k] / total for k in open_}
        for k in open_:
            out[k] = int(exact[k])
        rest = left - sum(out[k] for k in open_)
        for k in sorted(open_, key=lambda k: (out[k] - exact[k], k))[:rest]:
            out[k] += 1
        left = 0
    return out


def budgets(tokens: Mapping[tuple[str, ...], int], target: int, weights: Mapping[tuple[str, ...], float] = WEIGHTS, epochs: int = EPOCHS) -> dict[tuple[str, ...], int]:
    """Each leaf's tokens of the target. tokens: what each leaf (a path of equal length) holds.

    A node can give what its children of positive weight can, so what weighs nothing is no family's capacity.
    """
    capacity: dict[tuple[str, ...], int] = {}
    children: dict[tuple[str, ...], set[tuple[str, ...]]] = {}
    level = {leaf: n * epochs for leaf, n in tokens.items()}
    while level:  # from the leaves up
        capacity |= level
        above: dict[tuple[str, ...], int] = {}
        for node, most in level.items():
            if node:
                children.setdefault(node[:-1], set()).add(node)
                above[node[:-1]] = above.get(node[:-1], 0) + (most if weights.get(node, 1.0) > 0 else 0)
        level = above
    out: dict[tuple[str, ...], int] = {}
    todo = [((), min(target, capacity.get((), 0)))]
    while todo:
        node, budget = todo.pop()
        if node not in children:
            if node:
                out[node] = budget
            continue
        kids = sorted(children[node])
        share = fill(budget, {k: capacity[k] for k in kids}, {k: weights.get(k, 1.0) for k in kids})
        todo += [(k, share[k]) for k in kids]
    return out


def _select(
    docs: DataFrame, levels: Mapping[str, Column], key: str = "doc_id", text: str = "text", weights: Mapping[tuple[str, ...], float] = WEIGHTS,
    target: int | None = None, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED, tokens: Column | None = None,
) -> DataFrame:
    """(_k, _crc, _l0 ... for the levels, n_tokens, copies, part_tokens, budget): a row for each row of docs."""
    spark = docs.sparkSession
    names = list(levels)
    n = tokens if tokens is not None else word_count(text)
    light = docs.select(
        F.col(key).alias("_k"), F.crc32(F.encode(text_or_empty(text), "UTF-8")).alias("_crc"),
        *[F.coalesce(c.cast("string"), F.lit("(none)")).alias(f"_l{i}") for i, c in enumerate(levels.values())], n.alias("n_tokens"),
    )
    # some 50 bytes a document, read several times; the row numbers are fixed by writing them
    light = written(light.withColumn("_row", F.monotonically_increasing_id()), "mixing")
    # repeated rows would have one place in the order: their row numbers spread them
    again = light.groupBy(F.col("_k").alias("_k2"), F.col("_crc").alias("_crc2")).agg(F.count(F.lit(1)).alias("_n"))
    again = written(again.where("_n > 1"), "repeated")
    if again.isEmpty():
        light = light.withColumn("_row", F.lit(0).cast("bigint"))
    else:
        light = light.join(again, F.col("_k").eqNullSafe(F.col("_k2")) & (F.col("_crc") == F.col("_crc2")), "left")
        light = light.withColumn("_row", F.when(F.col("_n").isNull(), 0).otherwise(F.col("_row") + 1)).drop("_k2", "_crc2", "_n")
    path = [f"_l{i}" for i in range(len(names))]
    held = {tuple(r[:-1]): r[-1] or 0 for r in light.groupBy(*path).agg(F.sum("n_tokens")).collect()}
    goal = target if target is not None else int(sum(held.values()) * share)
    plan = budgets(held, goal, weights, epochs)
    rows = [(*leaf, b, b // held[leaf] if held[leaf] else 0, b % held[leaf] if held[leaf] else 0) for leaf, b in sorted(plan.items())]
    kind = T.StructType([T.StructField(p, T.StringType()) for p in path] + [T.StructField(c, T.LongType()) for c in ("budget", "copies", "rest")])
    leaves = spark.createDataFrame(rows, kind)
    hint = F.broadcast if len(rows) <= BROADCAST_LEAVES else (lambda x: x)
    at = light.join(hint(leaves), path).withColumn("_h", F.xxhash64(F.lit(seed), "copies", "_k", "_crc", "_row"))
    at = at.withColumn("_r", F.shiftrightunsigned("_h", 54).cast("int"))
    sums = at.where("rest > 0").groupBy(*path, "rest", "_r").agg(F.sum("n_tokens").alias("t"))  # leaves * RANGES rows
    running = W.Window.partitionBy(*path).orderBy("_r").rowsBetween(W.Window.unboundedPreceding, -1)
    edge = sums.withColumn("_before", F.coalesce(F.sum("t").over(running), F.lit(0)))
    edge = edge.where((F.col("_before") < F.col("rest")) & (F.col("_before") + F.col("t") >= F.col("rest")))
    edge = edge.select(*path, F.col("_r").alias("_edge"), "_before")  # a row for each leaf
    at = at.join(hint(edge), path, "left")
    inside = F.when(F.col("_edge").isNotNull() & (F.col("_r") < F.col("_edge")), F.col("n_tokens")).otherwise(F.lit(0).cast("bigint"))
    on_edge = F.col("_edge").isNotNull() & (F.col("_r") == F.col("_edge"))
    out = ["_k", "_crc", *path, "n_tokens", "copies"]
    clear = at.where(~on_edge).select(*out, inside.alias("part_tokens"), "budget")
    order = W.Window.partitionBy(*path).orderBy("_h", "_k", "_crc", "_row")
    past = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0)) + F.col("_before")
    part = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("n_tokens"), F.col("rest") - F.col("_p")))
    cut = at.where(on_edge).withColumn("_p", past).select(*out, part.alias("part_tokens"), "budget")
    return clear.unionByName(cut)


def select(
    docs: DataFrame, levels: Mapping[str, Column], key: str = "doc_id", text: str = "text", weights: Mapping[tuple[str, ...], float] = WEIGHTS,
    target: int | None = None, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED, tokens: Column | None = None,
) -> DataFrame:
    """(key, levels ..., n_tokens, copies, part_tokens, budget): a row for each row of docs.

    copies: whole epochs that hold the document; part_tokens: its tokens in the last,
    partial one. target: tokens in all, by default ``share`` of what docs holds.
    """
    rows = _select(docs, levels, key, text, weights, target, share, epochs, seed, tokens)
    named = [F.col(f"_l{i}").alias(x) for i, x in enumerate(levels)]
    return rows.select(F.col("_k").alias(key), *named, "n_tokens", "copies", "part_tokens", "budget")


def tree(domains: Mapping[str, Sequence[str]] = DOMAINS) -> dict[str, Column]:
    """The levels of documents: domain, lang, source."""
    return {"domain": domain_of("source", domains), "lang": F.col("lang"), "source": F.col("source")}


def report(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    return select(docs, tree(), key)


def keep_mixed(docs: DataFrame, share: float = 0.9, key: str = "doc_id", text: str = "text", weights: Mapping[tuple[str, ...], float] = WEIGHTS) -> DataFrame:
    """The rows of docs that stand whole in a mixture of ``share`` of all tokens, each at most once.

    Rows without tokens add nothing to any budget and are kept. Repeated rows go
    together: all of them if one does not stand whole.
    """
    chosen = written(_select(docs, tree(), key, text, weights, share=share, epochs=1), "mixture")
    drop = chosen.where((F.col("n_tokens") > 0) & (F.col("copies") == 0) & (F.col("part_tokens") < F.col("n_tokens")))
    drop = drop.select("_k", "_crc").distinct()
    held = docs.select(boxed(docs).alias("row"), F.col(key).alias("k"), F.crc32(F.encode(text_or_empty(text), "UTF-8")).alias("c"))
    return held.join(drop, F.col("k").eqNullSafe(F.col("_k")) & (F.col("c") == F.col("_crc")), "left_anti").select("row.*")
