"""Length audits of preference pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from prefmill.sources.shared import kept


#: Bits of the order that one pass tells apart, and rows of a range that are few enough to be sorted.
BITS, SORTED = 16, 1 << 18


def order_key(value: Column, kind: str) -> Column:
    """A bigint that orders as the numbers do: -0.0 before 0.0, NaN last."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return value.cast("bigint")
    if kind in ("float", "double"):
        bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(value.cast("double"), F.lit(0.0))).cast("bigint")
        return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1)))
    raise ValueError(f"no ranks over {kind}")


def ranks(rows: DataFrame, value: str, by: str, shares: Mapping[str, float]) -> DataFrame:
    """(by, n, name ...): nearest ranks, the ceil(share * n)-th smallest value of each group; nulls do not count.

    Exact, and no task holds a group's values. A first pass finds each group's range in an integer order; each further one
    counts how many values lie in 65536 parts of the range that still holds a rank, and keeps the part with the rank.
    Once such a part has at most ``SORTED`` values they are sorted: for numbers that spread, the second pass over the rows is the last. A share of 0
    means the maximum, as in the data's own reports.
    """
    kind = dict(rows.dtypes)[value]
    taken = [F.col(by).alias("_by"), F.col(value).alias("_v"), order_key(F.col(value), kind).alias("_k")]
    numbers = rows.select(*taken).where("_v IS NOT NULL")
    groups = numbers.groupBy("_by").agg(F.count(F.lit(1)).alias("n"), F.min("_k").alias("lo"), F.max("_k").alias("hi"))
    groups = kept(groups, "rank-groups")
    # a rank is 1-based; the least share that any group of a long count can mean is its first value
    need = lambda s: F.greatest(F.lit(1), F.ceil(F.lit(s) * F.col("n"))).cast("bigint")
    asked = F.array(*[F.struct(F.lit(name).alias("name"), (need(s) if s > 0 else F.col("n")).alias("need")) for name, s in shares.items()])
    state = groups.select("_by", F.explode(asked).alias("a"), "lo", "hi", F.col("n").alias("held")).select("_by", "a.*", "lo", "hi", "held")
    state = kept(state, "ranks-asked")
    done = None

    def inside(of: DataFrame) -> DataFrame:
        """Each number beside the ranges of its group that it lies in."""
        ends = of.withColumnRenamed("_by", "_g")
        return numbers.join(ends, F.col("_by").eqNullSafe(F.col("_g")) & F.col("_k").between(F.col("lo"), F.col("hi")))

    while True:
        few = state.where((F.col("held") <= SORTED) | (F.col("lo") == F.col("hi")))
        each = inside(few).groupBy("_g", "name", "need", "_k").agg(F.count(F.lit(1)).alias("c"), F.min("_v").alias("_v"))
        upto = F.sum("c").over(W.Window.partitionBy("_g", "name").orderBy("_k"))
        hit = each.withColumn("upto", upto).where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("c") < F.col("need")))
        hit = kept(hit.select(F.col("_g").alias("_by"), "name", "_v"), "ranks-found")
        done = hit if done is None else done.unionByName(hit)
        state = state.where((F.col("held") > SORTED) & (F.col("lo") < F.col("hi")))
        if state.isEmpty():
            break
        # the span of keys may be over 63 bits: as a decimal, it is cut into parts of a power of two
        span = (F.col("hi").cast("decimal(20,0)") - F.col("lo").cast("decimal(20,0)")).cast("decimal(20,0)")
        width = F.greatest(F.lit(0), F.ceil(F.log2(span.cast("double") + 1)).cast("int") - BITS)
        step = F.pow(F.lit(2.0), width).cast("decimal(20,0)")
        at = F.call_function("div", (F.col("_k").cast("decimal(20,0)") - F.col("lo").cast("decimal(20,0)")).cast("decimal(21,0)"), F.col("step"))
        counts = inside(state.withColumn("step", step)).groupBy("_g", "name", "need", at.alias("part")).agg(F.count(F.lit(1)).alias("held"), F.min("_k").alias("lo"), F.max("_k").alias("hi"))
        before = F.sum("held").over(W.Window.partitionBy("_g", "name").orderBy("part")) - F.col("held")
        next_ = counts.withColumn("before", before).where((F.col("before") < F.col("need")) & (F.col("before") + F.col("held") >= F.col("need")))
        state = kept(next_.select(F.col("_g").alias("_by"), "name", (F.col("need") - F.col("before")).alias("need"), "lo", "hi", "held"), "ranks-left")
    named = done.groupBy("_by").agg(*[F.max(F.when(F.col("name") == n, F.col("_v"))).alias(n) for n in shares])
    left = groups.select(F.col("_by").alias("_g"), "n")
    return left.join(named, F.col("_g").eqNullSafe(F.col("_by"))).select(F.col("_g").alias(by), "n", *shares)


def length_summary(rows: DataFrame, value: str, by: str) -> DataFrame:
    """min, median, p95, max of ``value`` for each ``by``; nearest ranks."""
    found = ranks(rows, value, by, {"median_len": 0.5, "p95_len": 0.95})
    ends = rows.groupBy(F.col(by).alias("_by")).agg(F.count(F.lit(1)).alias("n"), F.min(value).cast("bigint").alias("min_len"), F.max(value).cast("bigint").alias("max_len"))
    found = found.select(F.col(by).alias("_g"), F.col("median_len").cast("bigint"), F.col("p95_len").cast("bigint"))
    out = ends.join(found, F.col("_by").eqNullSafe(F.col("_g")), "left")
    return out.select(F.col("_by").alias(by), "n", "min_len", "median_len", "p95_len", "max_len")


def maxima(rows: DataFrame, value: str, by: str) -> DataFrame:
    return rows.groupBy(by).agg(F.max(value).cast("bigint").alias("max_len"))


def shared_prompt(chosen: Column, rejected: Column) -> Column:
    """Whether two message arrays agree up to a last assistant turn each."""
    n, m = F.size(chosen), F.size(rejected)
    same = F.slice(chosen, 1, F.greatest(n - 1, F.lit(0))) == F.slice(rejected, 1, F.greatest(m - 1, F.lit(0)))
    ends = (F.element_at(chosen, -1)["role"] == "assistant") & (F.element_at(rejected, -1)["role"] == "assistant")
    return F.coalesce(F.when((n >= 2) & (n == m), same & ends), F.lit(False))


def role_check(messages: Column) -> Column:
    """Whether there are messages and all have a known role."""
    known = F.forall(messages, lambda m: F.coalesce(m["role"].isin("system", "user", "assistant"), F.lit(False)))
    return F.coalesce((F.size(messages) > 0) & known, F.lit(False))


def token_counter(count: Callable[[str], int]) -> Callable[[Column], Column]:
    """A column function that applies an injected tokenizer's count to texts, batch by batch."""

    @F.pandas_udf(T.LongType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.fillna("").map(count).astype("int64")

    return run


def over_limit(rows: DataFrame, tokens: str, limit: int) -> DataFrame:
    """Candidates that do not fit the sequence length."""
    return rows.where(F.col(tokens) > limit)
