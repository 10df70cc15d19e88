"""Corpus statistics and text functions over the documents table (domain = lang, group = source)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.functions import hashing, text
from prefmill.operators import admission, corpus
from prefmill.plans.registry import query, table

#: Documents fall into splits by the last digit of their id's hash.
SPLIT_SQL = "CASE WHEN right(sha256(doc_id::VARCHAR), 1) < 'c' THEN 'train' WHEN right(sha256(doc_id::VARCHAR), 1) < 'e' THEN 'valid' ELSE 'test' END"
#: Rows with a split, a domain and a group that holds a part of a source.
ROWS_SQL = f"SELECT doc_id, {SPLIT_SQL} AS split, lang AS domain, source || '-' || (doc_id % 50)::VARCHAR AS group_id, text FROM documents"


def split() -> Column:
    digit = F.right(F.sha2(F.col("doc_id").cast("string"), 256), F.lit(1))
    return F.when(digit < "c", "train").when(digit < "e", "valid").otherwise("test")


def rows(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    group = F.concat("source", F.lit("-"), (F.col("doc_id") % 50).cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", split().alias("split"), F.col("lang").alias("domain"), group.alias("group_id"), *more)


@query(
    "stratified_limit",
    """
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS round FROM documents) ORDER BY round, lang LIMIT 50
""",
)
def _stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return admission.stratified_limit(docs, 50, "lang", "doc_id").select("doc_id", "lang")


@query(
    "blind_label",
    "SELECT doc_id, CASE WHEN right(sha256(doc_id::VARCHAR), 1) IN ('0','2','4','6','8','a','c','e') THEN 'A' ELSE 'B' END AS label FROM documents",
)
def _label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", hashing.blind_label(F.col("doc_id").cast("string")).alias("label"))


@query(
    "row_hash",
    """SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || ',"source":"' || source || '"}') AS hash FROM documents""",
)
def _hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", hashing.row_hash(F.struct("doc_id", "lang", "n_chars", "source")).alias("hash"))


@query(
    "group_identity",
    f"SELECT DISTINCT domain, group_id, sha256(domain || ':' || group_id) AS identity FROM ({ROWS_SQL})",
)
def _identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.group_identity(rows(spark, sf_dir))


@query(
    "provenance",
    """
SELECT id, domain, corpus_split, 'pref-' || corpus_split || '-' || category || '-' || (doc_id % 4) AS group_id FROM (
  SELECT doc_id, 'x-' || category || '-' || lpad(doc_id::VARCHAR, greatest(3, length(doc_id::VARCHAR))::INT, '0') AS id, category,
         CASE category WHEN 'tutoring' THEN 'education-pedagogy' WHEN 'degree-audit' THEN 'academic-operations'
                       WHEN 'safe-education' THEN 'responsible-guidance' ELSE 'course-planning' END AS domain,
         CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'valid' ELSE 'test' END AS corpus_split
  FROM (SELECT doc_id, CASE lang WHEN 'en' THEN 'tutoring' WHEN 'de' THEN 'degree-audit' WHEN 'fr' THEN 'safe-education' ELSE 'schedule-constraints' END AS category FROM documents))
""",
)
def _provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = corpus.lookup({"en": "tutoring", "de": "degree-audit", "fr": "safe-education", "es": "schedule-constraints"}, F.col("lang"))
    which = F.when(F.col("doc_id") % 3 == 0, "train").when(F.col("doc_id") % 3 == 1, "validation").otherwise("preference-test")
    docs = table(spark, sf_dir, "documents").select("doc_id", category.alias("category"), which.alias("split"))
    number = F.col("doc_id").cast("string")
    docs = docs.withColumn("id", F.concat(F.lit("x-"), "category", F.lit("-"), F.lpad(number, F.greatest(F.lit(3), F.length(number)), F.lit("0"))))
    return corpus.provenance(docs).select("id", "domain", "corpus_split", "group_id")


@query("domain_group_counts", f"SELECT domain, count(*) AS n, count(DISTINCT group_id) AS groups FROM ({ROWS_SQL}) GROUP BY domain")
def _domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.domain_counts(rows(spark, sf_dir))


@query("distinct_groups", f"SELECT split, count(*) AS n, count(DISTINCT domain) AS domains, count(DISTINCT group_id) AS groups FROM ({ROWS_SQL}) GROUP BY split")
def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.split_counts(rows(spark, sf_dir))


@query("qualified_domains", f"SELECT domain, n FROM (SELECT domain, count(*) AS n FROM ({ROWS_SQL}) GROUP BY domain) WHERE n >= 120")
def _qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.domain_counts(rows(spark, sf_dir)).where("n >= 120").select("domain", "n")


@query("filter_split", f"SELECT doc_id, domain FROM ({ROWS_SQL}) WHERE split = 'valid'")
def _filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir).where("split = 'valid'").select("doc_id", "domain")


@query(
    "split_identity",
    f"""
SELECT split, count(*) AS n, sum(strlen(text) + 1)::BIGINT AS bytes, sum(('0x' || substr(sha256(text), 1, 15))::BIGINT::HUGEINT)::VARCHAR AS digest
FROM ({ROWS_SQL}) GROUP BY split
""",
)
def _split_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.split_identity(rows(spark, sf_dir, "text"), "text")


LEAK_SQL = f"""
SELECT a.split AS left_split, b.split AS right_split, a.group_id
FROM (SELECT DISTINCT split, group_id FROM ({ROWS_SQL})) a JOIN (SELECT DISTINCT split, group_id FROM ({ROWS_SQL})) b ON a.group_id = b.group_id
WHERE (a.split, b.split) IN (('train', 'valid'), ('train', 'test'), ('valid', 'test'))
"""


@query("group_leakage", LEAK_SQL)
def _leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.leakage(rows(spark, sf_dir))


@query(
    "holdout_firewall",
    "SELECT 'doc_id' AS kind, doc_id::VARCHAR AS value FROM documents INTERSECT SELECT 'doc_id', item_id::VARCHAR FROM benchmark",
)
def _firewall(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "benchmark").select("item_id")
    return corpus.firewall(docs, bench, {"doc_id": "item_id"})


def _gate_sql(g: corpus.Gate) -> str:
    return f"""
WITH r AS ({ROWS_SQL}), d AS (SELECT domain, count(*) AS n, count(DISTINCT group_id) AS groups FROM r GROUP BY domain),
t AS (SELECT coalesce(sum(n), 0)::BIGINT AS pairs, count(*) AS domains, count(*) FILTER (n >= {g.judge_pairs_per_domain}) AS qualified FROM d)
SELECT 1 AS seq, 'verified-pairs:' || pairs || '<{g.pairs}' AS issue FROM t WHERE pairs < {g.pairs}
UNION ALL SELECT 2, 'domains:' || domains || '<{g.domains}' FROM t WHERE domains < {g.domains}
UNION ALL SELECT 3, 'single-model-judge-pairs:' || pairs || '<{g.judge_pairs}' FROM t WHERE pairs < {g.judge_pairs}
UNION ALL SELECT 4, 'single-model-judge-qualified-domains:' || qualified || '<{g.judge_domains}' FROM t WHERE qualified < {g.judge_domains}
UNION ALL SELECT 5, 'domain-groups:' || domain || ':' || groups || '<{g.groups_per_domain}' FROM d WHERE groups < {g.groups_per_domain}
UNION ALL SELECT 6 + i, s || '-empty' FROM (VALUES (0, 'train'), (1, 'valid'), (2, 'test')) v(i, s) WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.split = v.s)
UNION ALL SELECT 9, 'group-leakage' WHERE EXISTS ({LEAK_SQL})
"""


@query("gate_production", _gate_sql(corpus.PRODUCTION))
def _production(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.gate_issues(rows(spark, sf_dir), corpus.PRODUCTION)


@query("gate_research", _gate_sql(corpus.RESEARCH))
def _research(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.gate_issues(rows(spark, sf_dir), corpus.RESEARCH)


@query("duplicate_ids", "SELECT sha256(text) AS id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def _duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.duplicates(table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("id")))


@query(
    "provenance_guard",
    """
SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'split' WHEN doc_id % 7 = 0 THEN 'domain' WHEN doc_id % 5 = 0 THEN 'group' ELSE 'evidence-kind' END AS violation
FROM documents WHERE doc_id % 11 = 0 OR doc_id % 7 = 0 OR doc_id % 5 = 0 OR lang = 'es'
""",
)
def _guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoil = lambda n, c: F.when(F.col("doc_id") % n != 0, c)
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", spoil(11, F.lit("train")).alias("split"), spoil(7, F.col("lang")).alias("domain"), spoil(5, F.col("source")).alias("group_id"),
        F.when(F.col("lang") != "es", "blind-critic").alias("evidence"),
    )
    return corpus.violations(docs, "split", "domain", "group_id", "evidence", ("blind-critic",)).select("doc_id", "violation")


@query(
    "word_set",
    """
SELECT doc_id, len(list_distinct(list_filter(list_transform(regexp_extract_all(text, '[a-zA-Z0-9]+'), lambda x: lower(x)), lambda x: length(x) > 2)))::INT AS n_words FROM documents
""",
)
def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(text.words(F.col("text"))).alias("n_words"))


@query("contains_ci", "SELECT doc_id, contains(lower(text), 'license') AS found FROM documents")
def _contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.contains_fold(F.col("text"), F.lit("LICENSE")).alias("found"))


@query("fence_strip", "SELECT doc_id, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS digest FROM documents")
def _fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    fenced = F.concat(F.lit("```json\n"), "text", F.lit("\n```\n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.fence_strip(fenced)).alias("digest"))


@query(
    "meta_phrases",
    """
SELECT doc_id, concat_ws(',', CASE WHEN contains(t, 'this lesson') THEN 'meta-language:this-lesson' END, CASE WHEN contains(t, 'this course') THEN 'meta-language:this-course' END,
  CASE WHEN contains(t, 'success criteria') THEN 'meta-language:success-criteria' END, CASE WHEN contains(t, 'evidence moves') THEN 'meta-language:evidence-moves' END,
  CASE WHEN contains(t, 'weekly check') THEN 'meta-language:weekly-check' END) AS codes
FROM (SELECT doc_id, lower(coalesce(text, '') || CASE doc_id % 5 WHEN 0 THEN ' This Lesson' WHEN 1 THEN ' has Success Criteria' WHEN 2 THEN ' weekly CHECK, this course' ELSE '' END) AS t FROM documents)
""",
)
def _meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 5
    more = F.when(k == 0, " This Lesson").when(k == 1, " has Success Criteria").when(k == 2, " weekly CHECK, this course").otherwise("")
    said = F.concat(F.coalesce("text", F.lit("")), more)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.meta_phrases(said), ",").alias("codes"))


@query("short_text", "SELECT doc_id, length(trim(coalesce(text, ''), chr(32) || chr(10) || chr(9) || chr(13))) < 400 AS is_short FROM documents")
def _short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.short(F.col("text"), 400).alias("is_short"))
