"""Evaluation summaries over result rows (id, category, issues)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _counts() -> list:
    passed = F.count_if(F.size("issues") == 0)
    return [
        F.count(F.lit(1)).alias("n"),
        passed.alias("pass_count"),
        F.coalesce(F.try_divide(passed, F.count(F.lit(1))), F.lit(0.0)).alias("pass_rate"),
        F.coalesce(F.sum(F.size("issues")), F.lit(0)).cast("bigint").alias("issue_count"),
    ]


def summarize_by_category(results: DataFrame) -> DataFrame:
    """Counts and pass rate of each category; a row passes when it has no issue."""
    return results.groupBy("category").agg(*_counts())


def summarize_overall(results: DataFrame) -> DataFrame:
    """One row over everything; rates and sums are 0 on an empty input."""
    return results.agg(*_counts())


def issue_histogram(results: DataFrame) -> DataFrame:
    """How often each issue occurs."""
    return results.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


def compare_categories(base: DataFrame, candidate: DataFrame) -> DataFrame:
    """Pass rates of both runs by category, and whether the candidate's is lower; a missing category counts as 0."""
    pick = lambda d, name: summarize_by_category(d).select("category", F.col("pass_rate").alias(name))
    zero = F.lit(0.0)
    both = pick(base, "base").join(pick(candidate, "candidate"), "category", "full_outer").select(
        "category", F.coalesce("base", zero).alias("base_rate"), F.coalesce("candidate", zero).alias("candidate_rate")
    )
    return both.withColumn("regressed", F.col("candidate_rate") < F.col("base_rate"))


def promotion(base: DataFrame, candidate: DataFrame, kind: str = "hallucinated-citation", fixtures: int = 32) -> DataFrame:
    """One row of checks for replacing base by candidate; status is pass if all hold.

    Rows carry id, category and issues. same_fixtures wants the same ids on both sides, as many as ``fixtures``.
    """
    of_kind = F.coalesce(F.sum(F.size(F.filter("issues", lambda x: x == kind))), F.lit(0)).alias("kind")
    one = lambda d, p: d.agg(*_counts(), of_kind).select(*[F.col(c).alias(f"{p}_{c}") for c in ("n", "pass_rate", "issue_count", "kind")])
    lost = compare_categories(base, candidate).agg(F.count_if("regressed").alias("regressions"))
    # the same ids, as often on either side
    times = lambda d, name: d.groupBy("id").agg(F.count(F.lit(1)).alias(name))
    apart = times(base, "x").join(times(candidate, "y"), "id", "full_outer").agg(F.count_if(~F.col("x").eqNullSafe(F.col("y"))).alias("apart"))
    row = one(base, "b").join(one(candidate, "c")).join(lost).join(apart)  # four frames of one row each
    checks = {
        "same_fixtures": (F.col("apart") == 0) & (F.col("b_n") == fixtures) & (F.col("c_n") == fixtures),
        "pass_rate_up": F.col("c_pass_rate") > F.col("b_pass_rate"),
        "issues_down": F.col("c_issue_count") < F.col("b_issue_count"),
        "no_regression": F.col("regressions") == 0,
        "kind_not_up": F.col("c_kind") <= F.col("b_kind"),
    }
    every = F.lit(True)
    for c in checks.values():
        every = every & c
    return row.select(
        *[c.alias(n) for n, c in checks.items()], F.when(every, "pass").otherwise("fail").alias("status"),
        (F.col("c_pass_rate") - F.col("b_pass_rate")).alias("pass_rate_delta"), (F.col("c_issue_count") - F.col("b_issue_count")).alias("issue_delta"),
    )


def zip_strict(fixtures: DataFrame, results: DataFrame, order: str = "ord", key: str = "id") -> DataFrame:
    """Fixtures and results side by side by position, with ok where both are there and name the same row."""
    a = fixtures.select(order, F.col(key).alias("fixture_id"))
    b = results.select(order, F.col(key).alias("result_id"))
    return a.join(b, order, "full_outer").withColumn("ok", F.coalesce(F.col("fixture_id") == F.col("result_id"), F.lit(False)))


def run_metrics(runs: DataFrame, tokens: str, rate: str, memory: str) -> DataFrame:
    """Mean tokens, mean rate and highest memory; 0 on an empty input."""
    zero = F.lit(0.0)
    return runs.agg(
        F.coalesce(F.avg(tokens), zero).alias("mean_tokens"), F.coalesce(F.avg(rate), zero).alias("mean_rate"),
        F.coalesce(F.max(memory).cast("double"), zero).alias("peak_memory"),
    )


def quality_score(issues: "F.Column", fatal: "F.Column") -> "F.Column":
    """1 without issues, 0 if one is fatal, else 1 less a twelfth for each, not below 0."""
    n = issues.cast("double")
    return F.when(issues == 0, 1.0).when(fatal, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - F.least(F.lit(1.0), n / 12)))


def admission_rate(rows: DataFrame, admitted: "F.Column") -> DataFrame:
    """One row: requested, admitted, excluded and the rate, 0 on an empty input."""
    good = F.count_if(admitted)
    return rows.agg(
        F.count(F.lit(1)).alias("requested"), good.alias("admitted"), (F.count(F.lit(1)) - good).alias("excluded"),
        F.coalesce(F.try_divide(good, F.count(F.lit(1))), F.lit(0.0)).alias("rate"),
    )
