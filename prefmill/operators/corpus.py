"""Corpus manifest: provenance, split hygiene, holdout firewall and size gates."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Capability domain of each task category. Lesson kernels are known by their suffix.
CATEGORY_DOMAINS = {
    "prerequisite-reasoning": "course-planning",
    "schedule-constraints": "course-planning",
    "degree-audit": "academic-operations",
    "tool-use": "academic-operations",
    "tutoring": "education-pedagogy",
    "uncertainty-grounding": "responsible-guidance",
    "safe-education": "responsible-guidance",
}
#: Corpus split of each task split, and the file it is read from.
CORPUS_SPLIT = {"train": "train", "validation": "valid", "preference-test": "test"}
SPLIT_FILE = {"train": "train.jsonl", "valid": "validation.jsonl", "test": "test.jsonl"}
SPLITS = ("train", "valid", "test")


def lookup(table: Mapping[str, str], key: Column) -> Column:
    """A constant map's value, null where it has none."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def provenance(
    rows: DataFrame, prefix: str = "pref", category: str = "category", split: str = "split", key: str = "id",
    domains: Mapping[str, str] = CATEGORY_DOMAINS, groups: int = 4,
) -> DataFrame:
    """rows with domain, corpus_split and group_id = prefix-split-category-(ordinal mod groups); nulls where underivable."""
    ordinal = F.regexp_extract(key, r"-(\d+)$", 1)
    ordinal = F.when(ordinal != "", ordinal).cast("bigint")
    domain = F.when(F.col(category).endswith("-kernel"), "education-pedagogy").otherwise(lookup(domains, F.col(category)))
    to = lookup(CORPUS_SPLIT, F.col(split))
    group = F.concat_ws("-", F.lit(prefix), to, F.col(category), (ordinal % groups).cast("string"))
    whole = to.isNotNull() & domain.isNotNull() & ordinal.isNotNull()
    return rows.withColumns({"domain": domain, "corpus_split": to, "group_id": F.when(whole, group)})


def violations(rows: DataFrame, split: str, domain: str, group: str, evidence: str, kinds: tuple[str, ...]) -> DataFrame:
    """Rows whose provenance is incomplete, with the first thing wrong."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    wrong = (
        F.when(~F.coalesce(F.col(split).isin(*SPLITS), F.lit(False)), "split")
        .when(blank(domain), "domain")
        .when(blank(group), "group")
        .when(~F.coalesce(F.col(evidence).isin(*kinds), F.lit(False)), "evidence-kind")
    )
    return rows.withColumn("violation", wrong).where("violation IS NOT NULL")


def demand_none(rows: DataFrame, what: str) -> None:
    """Raise if rows has any."""
    if not rows.isEmpty():
        raise ValueError(f"{what}: {rows.first().asDict()}")


def domain_counts(rows: DataFrame, domain: str = "domain", group: str = "group_id") -> DataFrame:
    """Rows and distinct groups of each domain."""
    return rows.groupBy(F.col(domain).alias("domain")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(group).alias("groups"))


def split_counts(rows: DataFrame, split: str = "split", domain: str = "domain", group: str = "group_id") -> DataFrame:
    """Rows, distinct domains and distinct groups of each split."""
    return rows.groupBy(F.col(split).alias("split")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(domain).alias("domains"), F.count_distinct(group).alias("groups")
    )


def leakage(rows: DataFrame, split: str = "split", group: str = "group_id") -> DataFrame:
    """(left_split, right_split, group_id): a group that occurs in two splits, once for each pair of splits.

    Distinct (split, group) pairs are gathered by group, so a hot group meets at most as
    many rows as there are splits.
    """
    rank = {s: i for i, s in enumerate(SPLITS)}
    order = lookup({k: str(v) for k, v in rank.items()}, F.col("split")).cast("int")
    seen = rows.select(F.col(split).alias("split"), F.col(group).alias("group_id")).distinct().withColumn("r", order).where("r IS NOT NULL")
    sets = seen.groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("r", "split"))).alias("s")).where(F.size("s") > 1)
    left = sets.select("group_id", "s", F.explode("s").alias("a"))
    both = left.select("group_id", "a", F.explode("s").alias("b")).where("a.r < b.r")
    return both.select(F.col("a.split").alias("left_split"), F.col("b.split").alias("right_split"), "group_id")


def firewall(corpus: DataFrame, holdout: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """(kind, value): values of the named columns that corpus and holdout share. columns: corpus column -> holdout column."""
    out = None
    for mine, theirs in columns.items():
        common = corpus.select(F.col(mine).cast("string").alias("value")).intersect(holdout.select(F.col(theirs).cast("string").alias("value")))
        common = common.select(F.lit(mine).alias("kind"), "value")
        out = common if out is None else out.unionByName(common)
    return out


@dataclass(frozen=True)
class Gate:
    pairs: int
    domains: int
    groups_per_domain: int
    judge_pairs: int
    judge_domains: int
    judge_pairs_per_domain: int


#: The two gate profiles.
PRODUCTION = Gate(3000, 5, 3, 100, 5, 20)
RESEARCH = Gate(100, 4, 3, 100, 4, 20)


def gate_issues(rows: DataFrame, gate: Gate, split: str = "split", domain: str = "domain", group: str = "group_id") -> DataFrame:
    """(seq, issue): what keeps a corpus from passing the gate, in reporting order; empty if it passes.

    Everything follows from one row a domain and one a split, so only sums travel.
    """
    per = domain_counts(rows, domain, group)
    total = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"), F.count(F.lit(1)).alias("domains"),
        F.count_if(F.col("n") >= gate.judge_pairs_per_domain).alias("qualified"),
    )
    below = lambda name, c, least: F.when(c < least, F.concat(F.lit(f"{name}:"), c.cast("string"), F.lit(f"<{least}")))
    heads = F.array(
        below("verified-pairs", F.col("pairs"), gate.pairs),
        below("domains", F.col("domains"), gate.domains),
        below("single-model-judge-pairs", F.col("pairs"), gate.judge_pairs),
        below("single-model-judge-qualified-domains", F.col("qualified"), gate.judge_domains),
    )
    first = total.select(F.posexplode(heads).alias("seq", "issue")).select((F.col("seq") + 1).alias("seq"), F.lit("").alias("sub"), "issue")
    small = per.where(F.col("groups") < gate.groups_per_domain).select(
        F.lit(5).alias("seq"), F.col("domain").alias("sub"),
        F.concat(F.lit("domain-groups:"), "domain", F.lit(":"), F.col("groups").cast("string"), F.lit(f"<{gate.groups_per_domain}")).alias("issue"),
    )
    held = rows.agg(*[F.count_if(F.col(split) == s).alias(s) for s in SPLITS])
    empty = held.select(
        F.posexplode(F.array(*[F.when(F.col(s) == 0, F.lit(f"{s}-empty")) for s in SPLITS])).alias("seq", "issue")
    ).select((F.col("seq") + 6).alias("seq"), F.lit("").alias("sub"), "issue")
    leak = leakage(rows, split, group).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    leak = leak.select(F.lit(9).alias("seq"), F.lit("").alias("sub"), F.lit("group-leakage").alias("issue"))
    return first.unionByName(small).unionByName(empty).unionByName(leak).where("issue IS NOT NULL").orderBy("seq", "sub").drop("sub")


def group_identity(rows: DataFrame, domain: str = "domain", group: str = "group_id") -> DataFrame:
    """A hash for each distinct domain and group, as lists of identities name them."""
    return rows.select(F.col(domain).alias("domain"), F.col(group).alias("group_id")).distinct().withColumn(
        "identity", F.sha2(F.concat_ws(":", "domain", "group_id"), 256)
    )


def duplicates(rows: DataFrame, key: str = "id") -> DataFrame:
    return rows.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def split_identity(rows: DataFrame, text: str, split: str = "split") -> DataFrame:
    """Rows and bytes of each split (with a line end each) and an order-free digest of its lines.

    The digest sums 60-bit pieces of the lines' hashes: equal multisets of lines have
    equal digests, and no task holds a whole split.
    """
    piece = F.conv(F.substring(F.sha2(F.col(text), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.groupBy(F.col(split).alias("split")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text) + 1).cast("bigint").alias("bytes"), F.sum(piece).cast("string").alias("digest")
    )
