"""Answers to the seed tasks' puzzles, computed with joins and array functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.sources.shared import kept


def missing_prerequisites(edges: DataFrame, cases: DataFrame, by: list[str]) -> DataFrame:
    """(by, target, missing): direct prerequisites of the target that are not completed, in catalog order."""
    near = edges.withColumnRenamed("course", "target")
    direct = cases.join(near, [*by, "target"]).where(F.col("prereq").isNotNull() & ~F.array_contains("completed", F.col("prereq")))
    found = direct.groupBy(*by, "target").agg(F.array_sort(F.collect_list(F.struct("nth", "prereq"))).alias("m"))
    none = F.array().cast("array<string>")
    return cases.join(found, [*by, "target"], "left").select(*by, "target", F.coalesce(F.col("m.prereq"), none).alias("missing"))


def prerequisite_sequence(spark: SparkSession, edges: DataFrame, cases: DataFrame, by: list[str]) -> DataFrame:
    """(by, target, sequence): all open prerequisites of the target, deepest first, equal depths by code.

    Each round follows the edges one step and keeps a course once, so a round costs at most the
    open courses however many ways lead to them; the last round that reaches a course is its
    longest way from the target, so each course comes after everything it needs. A circle
    of prerequisites is an error.
    """
    near = kept(edges.where(F.col("prereq").isNotNull()).select(*by, "course", F.col("prereq").alias("need")), "edges")
    at = kept(cases.select(*by, "target", "completed", F.col("target").alias("course")), "courses")
    most = near.select(*by, "course").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    found = []
    for depth in range(1, most + 2):
        step = at.join(near, [*by, "course"]).where(~F.array_contains("completed", F.col("need")))
        at = kept(step.select(*by, "target", "completed", F.col("need").alias("course")).distinct(), "courses")
        if at.isEmpty():
            break
        if depth > most:
            raise ValueError("prerequisites form a circle")
        found.append(at.select(*by, "target", "course", F.lit(depth).alias("depth")))
    walked = at.select(*by, "target", "course", F.lit(0).alias("depth")).where(F.lit(False))
    for part in found:
        walked = walked.unionByName(part)
    walked = walked.groupBy(*by, "target", "course").agg(F.max("depth").alias("depth"))
    ordered = walked.groupBy(*by, "target").agg(F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("d"), "course"))).alias("s"))
    none = F.array().cast("array<string>")
    return cases.join(ordered, [*by, "target"], "left").select(*by, "target", F.coalesce(F.col("s.course"), none).alias("sequence"))


def degree_audit(cases: DataFrame, by: list[str]) -> DataFrame:
    """(by, grp, remaining, eligible): what each requirement group still needs, and its courses not yet taken."""
    rows = cases.select(*by, "completed", F.inline("policy"))
    taken = F.size(F.filter("courses", lambda c: F.array_contains("completed", c)))
    left = F.filter("courses", lambda c: ~F.array_contains("completed", c))
    return rows.select(*by, F.col("name").alias("grp"), F.greatest(F.lit(0), F.col("choose") - taken).alias("remaining"), left.alias("eligible"))


def apart(a: str, b: str) -> F.Column:
    """Whether two sections (columns a.day, a.start, a.end ...) do not overlap; ends that touch do not."""
    x, y = (lambda n: F.col(f"{a}.{n}")), (lambda n: F.col(f"{b}.{n}"))
    return (x("day") != y("day")) | (x("end") <= y("start")) | (y("end") <= x("start"))


def smallest_schedule(sections: DataFrame, by: list[str], courses: int = 3) -> DataFrame:
    """(by, feasible, section_ids, credits): one section a course without overlaps, the first in lexical order.

    Sections inside the blocked window go first; the courses are then joined one after
    another within each case, keeping only combinations without overlaps.
    """
    free = sections.where((F.col("day") != F.col("b_day")) | (F.col("end") <= F.col("b_start")) | (F.col("b_end") <= F.col("start")))
    part = lambda n: free.where(F.col("course_no") == n).select(*by, F.struct("day", "start", "end", "section", "credits").alias(f"s{n}"))
    combined = part(0)
    for n in range(1, courses):
        ok = F.lit(True)
        for m in range(n):
            ok = ok & apart(f"s{m}", f"s{n}")
        combined = combined.join(part(n), by).where(ok)
    ids = F.array(*[F.col(f"s{n}.section") for n in range(courses)])
    credits = sum((F.col(f"s{n}.credits") for n in range(1, courses)), F.col("s0.credits"))
    best = combined.groupBy(*by).agg(F.min(F.struct(ids.alias("ids"), credits.alias("credits"))).alias("b"))
    cases = sections.select(*by).distinct()
    return cases.join(best, by, "left").select(*by, F.col("b").isNotNull().alias("feasible"), F.col("b.ids").alias("section_ids"), F.col("b.credits").alias("credits"))
