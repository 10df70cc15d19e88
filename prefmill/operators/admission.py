"""Resumable generation and admission: which work is done, which answer counts, what enters the corpus."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from prefmill.functions import json as J
from prefmill.functions.hashing import blind_label
from prefmill.sources.shared import kept


def retained(prior: DataFrame, current: DataFrame, key: str = "id", digest: str = "hash", usable: Column | None = None) -> DataFrame:
    """Prior rows whose task still has the same content; ``usable`` restricts them further (failures that may be retried)."""
    prior = prior if usable is None else prior.where(usable)
    return prior.join(current.select(key, digest), [key, digest], "left_semi")


def pending(current: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Tasks without a retained row."""
    return current.join(done.select(key), key, "left_anti")


def latest(log: DataFrame, key: str = "id", order: str = "ord") -> DataFrame:
    """The last row of each key in an append-only log.

    max_by keeps one row a key and task before the shuffle, where a ranking would move all.
    """
    rest = [c for c in log.columns if c != key]
    best = log.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_last"))
    return best.select(key, *[F.col(f"_last.{c}").alias(c) for c in rest])


def first_success(log: DataFrame, key: str = "id", attempt: str = "attempt", ok: str = "ok", most: int = 3, issues: str | None = None) -> DataFrame:
    """(key, attempts, success_at, last_attempt): the first success among the first ``most`` attempts; null if none.

    issues: a column of the attempts' issues; adds ``last_issues``, those of the last attempt where none succeeded, else null.
    """
    success = F.min(F.when(F.col(ok), F.col(attempt)))
    more = [] if issues is None else [F.when(success.isNull(), F.max_by(issues, attempt)).alias("last_issues")]
    return log.where(F.col(attempt) < most).groupBy(key).agg(
        F.count(F.lit(1)).alias("attempts"), success.alias("success_at"), F.max(attempt).alias("last_attempt"), *more
    )


def stratified_limit(rows: DataFrame, limit: int, stratum: str = "category", order: str = "ord") -> DataFrame:
    """``limit`` rows, taken in rounds: one of each stratum (sorted) in row order, then the next of each.

    No stratum can give more than ``limit`` rows, so each is cut to that many by a top-k
    first and no task ranks a whole stratum.
    """
    w = W.Window.partitionBy(stratum).orderBy(order)
    return rows.withColumn("round", F.row_number().over(w)).where(F.col("round") <= limit).orderBy("round", stratum).limit(limit)


def head(rows: DataFrame, limit: int, order: str = "ord") -> DataFrame:
    return rows.orderBy(order).limit(limit)


def positions(rows: DataFrame, order: str | Sequence[str], name: str = "pos") -> DataFrame:
    """rows with their 0-based position in ``order``, without a global sort in one task.

    Rows are range-partitioned by the order and written once, each with its partition and its rank there;
    a position is that rank plus the rows of the partitions before, which come from the same table: were the
    partitioning computed for each use, its sampled bounds could differ between them. Rows that the order does not
    tell apart stand in any order; a hash of their other columns, then their place in the input, spread them over partitions.
    """
    order = [order] if isinstance(order, str) else list(order)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = set(rows.columns)
    fresh = lambda c: c if c not in taken else fresh(f"_{c}")
    tie, row, part, start = (fresh(c) for c in ("_tie", "_row", "_part", "_start"))
    told = [c for c, kind in rows.dtypes if c not in order and not re.search("map<|variant", kind)]
    ends = F.struct(F.xxhash64(F.lit(0), *[F.col(f"`{c}`") for c in told]), F.monotonically_increasing_id())
    by = [*[F.col(f"`{c}`") for c in order], F.col(tie)]
    dealt = rows.withColumn(tie, ends).repartitionByRange(n, *by).sortWithinPartitions(*by).drop(tie)
    # partition number above bit 33, row number below
    table = kept(dealt.withColumn(row, F.monotonically_increasing_id()), "positions")
    at = table.withColumn(part, F.shiftright(row, 33))
    before = W.Window.orderBy(part).rowsBetween(W.Window.unboundedPreceding, -1)
    sizes = at.groupBy(part).agg(F.count(F.lit(1)).alias(start))  # a row for each partition
    starts = sizes.select(part, F.coalesce(F.sum(start).over(before), F.lit(0)).alias(start))
    rank = F.col(row).bitwiseAND(F.lit((1 << 33) - 1))
    return at.join(F.broadcast(starts), part).withColumn(name, (F.col(start) + rank).cast("bigint")).drop(part, row, start)


def token_budget(contract: Column, attempt: Column | None = None, kernels: Sequence[str] = ("lesson-kernel-json-v1",)) -> Column:
    """Tokens that one generation may use: long for lessons, short for a first try at a schedule."""
    first = (contract == "schedule-json-v1") & (attempt == 0) if attempt is not None else F.lit(False)
    return F.when(contract.isin(*kernels), 1900).when(first, 400).otherwise(700)


def generation_seed(position: Column, attempt: Column) -> Column:
    return F.lit(16031) + position * 7 + attempt


def critic_seed(position: Column, attempt: Column) -> Column:
    return F.lit(24017) + position + F.lit(100_000) * attempt


def evaluation_seed(position: Column) -> Column:
    return F.lit(32003) + position


def judgment_shape(judgment: Column) -> Column:
    """Whether a judgment (JSON text) has the right fields and kinds."""
    v = J.value(judgment)
    field = lambda name: J.get(v, f"$.{name}")
    score = field("preferredScore")
    good = (
        (J.kind(v) == "object")
        & (J.kind(field("preferred")) == "string")
        & field("preferred").try_cast("string").isin("A", "B", "tie")
        & (J.kind(score) == "integer")
        & score.try_cast("bigint").between(1, 5)
        & (J.kind(field("groundingPass")) == "boolean")
        & (J.kind(field("pedagogyPass")) == "boolean")
        & J.strings(field("issues")).isNotNull()
    )
    return F.coalesce(good, F.lit(False))


def admitted(judgment: Column, chosen_label: Column) -> Column:
    """Whether a judgment prefers the chosen answer clearly, grounded and with sound pedagogy."""
    v = J.value(judgment)
    at = lambda name, kind: F.try_variant_get(v, f"$.{name}", kind)
    good = (
        judgment_shape(judgment)
        & (at("preferred", "string") == chosen_label)
        & (at("preferredScore", "bigint") >= 4)
        & at("groundingPass", "boolean")
        & at("pedagogyPass", "boolean")
    )
    return F.coalesce(good, F.lit(False))


#: What the critic is told.
RUBRIC = (
    "You are an independent education-data critic. Compare two blind candidates against the supplied "
    "task. Reward exact factual grounding, correct constraints, honest uncertainty, useful pedagogy, "
    "safe behavior, and exact JSON instructions. Penalize even one invented catalog fact or citation. "
    "For planning and tool tasks, pedagogyPass means task-appropriate clarity and usefulness; it does "
    "not require a tutoring lesson. "
    "Return JSON only with exactly these keys: preferred (A, B, or tie), preferredScore (integer 1-5), "
    "groundingPass (boolean), pedagogyPass (boolean), issues (array of short strings). Do not reveal "
    "chain-of-thought."
)


def judge_pairs(pairs: DataFrame) -> DataFrame:
    """(id, chosen_label, candidate_a, candidate_b, system, task, message) for the critic, blind to which answer was chosen.

    message: candidateA, candidateB (parsed), contract and taskMessages as compact JSON with sorted keys.
    """
    label = blind_label(F.col("id"))
    last = lambda c: F.element_at(c, -1)["content"]
    a = F.when(label == "A", last("chosen")).otherwise(last("rejected"))
    b = F.when(label == "A", last("rejected")).otherwise(last("chosen"))
    task = F.slice("chosen", 1, F.size("chosen") - 1)
    turns = F.transform(task, lambda m: F.struct(m["content"].alias("content"), m["role"].alias("role")))
    contract = F.col("contract") if "contract" in pairs.columns else F.lit(None).cast("string")
    parsed = F.struct(F.try_parse_json(a).alias("candidateA"), F.try_parse_json(b).alias("candidateB"), contract.alias("contract"), turns.alias("taskMessages"))
    return pairs.select(
        "id", label.alias("chosen_label"), a.alias("candidate_a"), b.alias("candidate_b"), F.lit(RUBRIC).alias("system"), task.alias("task"),
        F.to_json(parsed, {"ignoreNullFields": "false"}).alias("message"),
    )


def quarantine(excluded: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows kept out, with the stage that did so."""
    return excluded.withColumn("stage", F.lit("oracle")).unionByName(rejected.withColumn("stage", F.lit("critic")))


def preference_rows(rows: DataFrame) -> DataFrame:
    """The training projection: id, category, chosen, rejected, provenance."""
    return rows.select("id", "category", "chosen", "rejected", "provenance")


def append_message(messages: Column, response: Column) -> Column:
    """messages with an assistant turn whose content is the response (a struct with sorted fields) as compact JSON."""
    return F.array_append(messages, F.struct(F.lit("assistant").alias("role"), F.to_json(response).alias("content")))
