"""Token counts: an exact histogram of encoded lengths and what follows from it.

Every document is encoded once; documents are then aggregated by encoded length, and
prefix and suffix sums over that histogram answer totals, quantiles and truncated
totals for any context limit without another look at the texts. The sums run in two
levels (lengths within a bucket of about sqrt(length), then the buckets), so no task
sees the whole histogram.

Defined cases: a null or empty text has length 0; repeated rows count each time, null and
equal keys too; documents of equal length share a row; a very long text is encoded whole,
its tokens being what a task holds of it; an empty table gives only the limits asked for,
with zeros and a null quantile; other columns are ignored, and ``token_lengths`` replaces
one named like its result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from prefmill.llm.common import bounded_batches, text_or_empty, written

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how this vocabulary splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LIMITS = (512, 1024, 2048, 4096, 8192, 16384, 32768, 65536, 131072)


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """docs with the number of tokens of each whole text as ``out`` (replaced if docs has such a column).

    The vocabulary file (under 1 MB) is read on the driver and sent to the executors once.
    """
    bounded_batches(docs)
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("bigint")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        pairs = (line.split() for line in ranks.value.splitlines() if line)
        table = {base64.b64decode(a): int(b) for a, b in pairs}
        encode = tiktoken.Encoding("counting", pat_str=SPLIT, mergeable_ranks=table, special_tokens={}).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(x)) for x in texts], dtype="int64")

    return docs.withColumn(out, lengths(text_or_empty(text)))


def histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """(n_tokens, docs): how many documents have each length."""
    return lengths.groupBy(F.coalesce(F.col(length), F.lit(0)).cast("bigint").alias("n_tokens")).agg(
        F.count(F.lit(1)).alias("docs")
    )


def context_table(hist: DataFrame, limits: Sequence[int] = LIMITS) -> DataFrame:
    """A row for each length that occurs and each of ``limits``, as context limit L.

    docs_at, docs_within, docs_over: documents with exactly, at most, over L tokens;
    tokens_within, tokens_over: their tokens; truncated_total: tokens left when each
    document is cut at L; lost_tokens: tokens that the cut drops; quantile: the share of
    documents that fit.
    """
    spark = hist.sparkSession
    asked = spark.createDataFrame([(int(x), 0) for x in limits], "n_tokens bigint, docs bigint")
    # a row for each length, written: the two levels below read it without encoding any text again
    hist = written(hist, "lengths")
    # asked lengths join the histogram as rows of zero documents
    h = hist.unionByName(asked).groupBy("n_tokens").agg(F.sum("docs").alias("docs"))
    h = h.withColumn("bucket", F.floor(F.sqrt(F.col("n_tokens").cast("double"))))
    h = h.withColumn("tokens", F.col("docs") * F.col("n_tokens"))
    # at most sqrt(longest text) rows
    per = h.groupBy("bucket").agg(F.sum("docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    up = W.Window.orderBy("bucket")
    before, after = up.rowsBetween(W.Window.unboundedPreceding, -1), up.rowsBetween(1, W.Window.unboundedFollowing)
    zero = lambda c: F.coalesce(c, F.lit(0))
    per = per.select(
        "bucket",
        *[zero(F.sum(f"b_{x}").over(before)).alias(f"{x}_before") for x in ("docs", "tokens")],
        *[zero(F.sum(f"b_{x}").over(after)).alias(f"{x}_after") for x in ("docs", "tokens")],
    )
    within = W.Window.partitionBy("bucket").orderBy("n_tokens")
    to_here, from_here = (
        within.rowsBetween(W.Window.unboundedPreceding, 0),
        within.rowsBetween(1, W.Window.unboundedFollowing),
    )
    x = h.join(per, "bucket")
    x = x.select(
        F.col("n_tokens").alias("context_limit"),
        F.col("docs").alias("docs_at"),
        *[(F.sum(n).over(to_here) + F.col(f"{n}_before")).alias(f"{n}_within") for n in ("docs", "tokens")],
        *[(zero(F.sum(n).over(from_here)) + F.col(f"{n}_after")).alias(f"{n}_over") for n in ("docs", "tokens")],
    )
    kept = F.col("tokens_within") + F.col("context_limit") * F.col("docs_over")
    return x.withColumn("truncated_total", kept).withColumns(
        {
            "lost_tokens": F.col("tokens_over") - F.col("context_limit") * F.col("docs_over"),
            "quantile": F.try_divide(
                F.col("docs_within").cast("double"), (F.col("docs_within") + F.col("docs_over")).cast("double")
            ),
        }
    )


def quantile_lengths(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that occurs and that at least ``share`` of the documents do not exceed."""
    picks = [
        F.min(F.when((F.col("quantile") >= s) & (F.col("docs_at") > 0), F.col("context_limit"))).alias(f"q{i}")
        for i, s in enumerate(shares)
    ]
    pairs = [F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, s in enumerate(shares)]
    return table.agg(*picks).select(F.inline(F.array(*pairs)))
