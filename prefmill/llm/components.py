"""Connected components over links, by alternating large-star and small-star steps.

Each step is an aggregation and a join over the links alone; both its parts are written
to the shared folder, so lineage stays short and hot nodes (a centre with very many
neighbours) reach the join through plain exchanges that skew handling can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefmill.llm.common import written

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: distinct (u, v) with u > v. Large: hang every larger neighbour on the smallest; small: every smaller one."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star")
    hung = both.where(F.col("v") > F.col("u")) if large else both
    moved = hung.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return written(moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for each node that is in a link.

    Nodes are any ordered type; null ends and loops are dropped.
    """
    x, y = F.col(a), F.col(b)
    edges = links.where(x.isNotNull() & y.isNotNull() & (x != y))
    edges = written(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "links")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    now = mark(edges)
    for _ in range(MAX_ROUNDS):
        if not now[0]:
            break
        edges = _star(_star(edges, True), False)
        last, now = now, mark(edges)
        if last == now:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
