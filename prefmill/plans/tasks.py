"""Seed tasks, their puzzles, and the validators of answers to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.operators import admission, contracts, lessons, planning
from prefmill.plans.registry import query, table
from prefmill.sources import seeds

#: A plan with tasks for every document, in DuckDB SQL and Spark.
PLAN_SQL = """(SELECT CASE doc_id % 8 WHEN 5 THEN 'validation' WHEN 6 THEN 'preference-test' WHEN 7 THEN 'heldout' ELSE 'train' END AS split,
  CASE doc_id % 8 WHEN 5 THEN 'BRI' WHEN 6 THEN 'CRN' WHEN 7 THEN 'DUN' ELSE 'ALD' END AS prefix, doc_id::INT AS idx FROM documents)"""
ID_SQL = "split || '-' || category || '-' || printf('%03d', idx)"


def task_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeds.plan_of(table(spark, sf_dir, "documents"), "doc_id")


@query("seed_counts", f"SELECT split, count(*) * 8 AS n FROM {PLAN_SQL} GROUP BY split")
def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeds.tasks(spark, task_plan(spark, sf_dir)).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "seed_manifest",
    f"""
SELECT split, count(*) AS n, count(DISTINCT category) AS categories, min({ID_SQL}) AS first_id,
       sum(('0x' || substr(sha256({ID_SQL}), 1, 15))::BIGINT::HUGEINT)::VARCHAR AS digest
FROM {PLAN_SQL}, (VALUES ('prerequisite-reasoning'), ('schedule-constraints'), ('degree-audit'), ('uncertainty-grounding'),
     ('tutoring'), ('tool-use'), ('safe-education'), ('lesson-kernel')) c(category) GROUP BY split
""",
)
def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    piece = F.conv(F.substring(F.sha2("id", 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return seeds.tasks(spark, task_plan(spark, sf_dir)).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("category").alias("categories"), F.min("id").alias("first_id"), F.sum(piece).cast("string").alias("digest")
    )


@query(
    "modulo_dim_join",
    f"""
SELECT split, idx, concept, answer FROM {PLAN_SQL} p JOIN (VALUES (0, 'fraction-addition', '7/12'), (1, 'variable-isolation', '5'), (2, 'mean-versus-median', 'median'),
  (3, 'correlation-causation', 'additional causal evidence'), (4, 'photosynthesis-energy', 'light energy'), (5, 'independent-probability', '1/4'),
  (6, 'net-force', 'zero net force'), (7, 'claim-evidence', 'relevant evidence')) t(k, concept, answer) ON idx % 8 = k
""",
)
def _modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = spark.createDataFrame([(k, *x[:2]) for k, x in enumerate(seeds.TUTORING)], "k int, concept string, answer string")
    return task_plan(spark, sf_dir).join(F.broadcast(dim), F.pmod("idx", F.lit(8)) == F.col("k")).select("split", "idx", "concept", "answer")


EDGES_SQL = f"""
(SELECT split, idx, prefix, unnest([
  {{'c': 1, 'p': 0}}, {{'c': 2, 'p': 1}}, {{'c': 2, 'p': 5}}, {{'c': 3, 'p': 1}}, {{'c': 4, 'p': 2}}, {{'c': 4, 'p': 3}}]) AS e FROM {PLAN_SQL})
"""
CODE_SQL = "CASE WHEN {0} = 5 THEN prefix || 'M ' || (105 + idx * 10) ELSE prefix || ' ' || (110 + idx * 10 + 10 * {0}) END"
CASES_SQL = f"(SELECT split, idx, prefix, CASE WHEN idx % 2 = 0 THEN [0, 5] ELSE [0, 1, 5] END AS done, CASE WHEN idx % 3 = 0 THEN 2 ELSE 4 END AS target FROM {PLAN_SQL})"


@query(
    "prereq_missing",
    f"""
SELECT split, idx, {CODE_SQL.format("target")} AS target, coalesce((SELECT string_agg({CODE_SQL.format("x.e.p")}, ',' ORDER BY x.e.p) FROM {EDGES_SQL} x
   WHERE x.split = k.split AND x.idx = k.idx AND x.e.c = k.target AND NOT list_contains(k.done, x.e.p)), '') AS missing FROM {CASES_SQL} k
""",
)
def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = planning.missing_prerequisites(seeds.catalog(spark, task_plan(spark, sf_dir)), seeds.prerequisite_cases(spark, task_plan(spark, sf_dir)), ["split", "idx"])
    return got.withColumn("missing", F.array_join("missing", ","))


@query(
    "prereq_sequence",
    f"""
WITH RECURSIVE r AS (
  SELECT split, idx, prefix, done, target, target AS c, 0 AS depth FROM {CASES_SQL} k
  UNION ALL SELECT r.split, r.idx, r.prefix, done, target, x.e.p, depth + 1 FROM r JOIN {EDGES_SQL} x
    ON x.split = r.split AND x.idx = r.idx AND x.e.c = r.c WHERE NOT list_contains(done, x.e.p)),
m AS (SELECT split, idx, prefix, target, c, max(depth) AS depth FROM r WHERE depth > 0 GROUP BY ALL)
SELECT split, idx, {CODE_SQL.format("target")} AS target, string_agg({CODE_SQL.format("c")}, ',' ORDER BY depth DESC, {CODE_SQL.format("c")}) AS sequence FROM m GROUP BY split, idx, prefix, target
""",
)
def _sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = planning.prerequisite_sequence(spark, seeds.catalog(spark, task_plan(spark, sf_dir)), seeds.prerequisite_cases(spark, task_plan(spark, sf_dir)), ["split", "idx"])
    return got.where(F.size("sequence") > 0).withColumn("sequence", F.array_join("sequence", ","))


@query(
    "degree_audit",
    f"""
WITH c AS (SELECT split, idx, prefix, CASE WHEN idx % 2 = 0 THEN [prefix || 'W ' || (101 + idx), prefix || 'M ' || (201 + idx)]
   ELSE [prefix || 'W ' || (102 + idx), prefix || 'M ' || (201 + idx), prefix || 'M ' || (202 + idx)] END AS done FROM {PLAN_SQL}),
g AS (SELECT split, idx, done, 'writing' AS grp, 1 AS choose, [prefix || 'W ' || (101 + idx), prefix || 'W ' || (102 + idx)] AS courses FROM c
 UNION ALL SELECT split, idx, done, 'methods', 2, [prefix || 'M ' || (201 + idx), prefix || 'M ' || (202 + idx), prefix || 'M ' || (203 + idx)] FROM c
 UNION ALL SELECT split, idx, done, 'capstone', 1, [prefix || 'C ' || (490 + idx)] FROM c)
SELECT split, idx, grp, greatest(0, choose - len(list_filter(courses, lambda x: list_contains(done, x))))::INT AS remaining,
       array_to_string(list_filter(courses, lambda x: NOT list_contains(done, x)), ',') AS eligible FROM g
""",
)
def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.degree_audit(seeds.degree_cases(spark, task_plan(spark, sf_dir)), ["split", "idx"]).withColumn("eligible", F.array_join("eligible", ","))


@query(
    "schedule_solve",
    f"""
WITH s AS (SELECT split, idx, n, prefix || ' ' || (base + idx) || '-' || part AS section, credits, day, t0, t1 FROM {PLAN_SQL}, (VALUES
   (0, 201, 'A', 3, 'Mon', 9, 10), (0, 201, 'B', 3, 'Tue', 14, 15), (1, 301, 'A', 4, 'Mon', 9, 11), (1, 301, 'B', 4, 'Wed', 11, 13), (2, 401, 'A', 3, 'Thu', 10, 11)) v(n, base, part, credits, day, t0, t1)
   WHERE NOT (CASE WHEN idx % 2 = 0 THEN day = 'Tue' AND t0 < 16 AND t1 > 13 ELSE day = 'Fri' AND t0 < 12 AND t1 > 9 END)),
x AS (SELECT a.split, a.idx, a.section || ',' || b.section || ',' || c.section AS ids, a.credits + b.credits + c.credits AS credits
  FROM s a JOIN s b ON a.split = b.split AND a.idx = b.idx AND a.n = 0 AND b.n = 1 JOIN s c ON a.split = c.split AND a.idx = c.idx AND c.n = 2
  WHERE NOT (a.day = b.day AND a.t0 < b.t1 AND b.t0 < a.t1) AND NOT (a.day = c.day AND a.t0 < c.t1 AND c.t0 < a.t1) AND NOT (b.day = c.day AND b.t0 < c.t1 AND c.t0 < b.t1))
SELECT split, idx, true AS feasible, min(ids) AS section_ids, arg_min(credits, ids)::INT AS credits FROM x GROUP BY split, idx
""",
)
def _schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.smallest_schedule(seeds.section_cases(spark, task_plan(spark, sf_dir)), ["split", "idx"]).withColumn("section_ids", F.array_join("section_ids", ","))


#: Answers of six kinds made from each label: right ones and ones with a known fault.
ORACLE = '{"eligible":true,"missingImmediate":[],"recommendedSequence":["A 1"],"allowedRecommendedSequences":[["A 1"],["A 1","A 2"]],"requiredCitations":["A 1"],"allowedCitations":["A 1","A 2"]}'
ANSWERS = [
    ('{"eligible":true,"missingImmediate":[],"recommendedSequence":["A 1","A 2"],"explanation":"Every prerequisite is met.","citations":["A 1"]}', ""),
    ('{"eligible":1,"missingImmediate":[],"recommendedSequence":["A 1"],"explanation":"Every prerequisite is met.","citations":["A 1"]}', "wrong-eligibility"),
    ('{"eligible":true,"missingImmediate":["A 2"],"recommendedSequence":["A 2"],"explanation":"short","citations":["B 1"]}',
     "hallucinated-citation,missing-required-citation,short-text:explanation,wrong-missingImmediate,wrong-recommendedSequence"),
    ('{"eligible":true,"missingImmediate":[],"recommendedSequence":["A 1"],"explanation":"Every prerequisite is met.","citations":"A 1","more":1}',
     "citations-not-string-array,extra-key:more"),
    ('{"eligible":true} trailing', "invalid-json"),
    ("[1]", "root-not-object"),
]


@query(
    "validate_answers",
    "SELECT doc_id, CASE doc_id % 6 " + " ".join(f"WHEN {k} THEN '{c}'" for k, (_, c) in enumerate(ANSWERS)) + " END AS issues FROM labels",
)
def _validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.get(F.array(*[F.lit(a) for a, _ in ANSWERS]), F.col("doc_id") % 6)
    rows = table(spark, sf_dir, "labels").select("doc_id", F.lit("prerequisite-json-v1").alias("contract"), answer.alias("answer"), F.lit(ORACLE).alias("oracle"))
    return contracts.validate(rows, only=("prerequisite-json-v1",)).select("doc_id", F.array_join("issues", ",").alias("issues"))


@query("construct_rejected", "SELECT doc_id, 'wrong-eligibility' AS issues FROM labels")
def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").select("doc_id", F.lit("prerequisite-json-v1").alias("contract"), F.lit(ANSWERS[0][0]).alias("answer"), F.lit(ORACLE).alias("oracle"))
    return contracts.construct_rejected(rows, only=("prerequisite-json-v1",)).select("doc_id", F.array_join("rejected_issues", ",").alias("issues"))


ITEM = '{"q":"Which claim is best supported?","op":["a","b","c","d"],"ai":2,"ex":"Because the source says so."'


@query(
    "mc_options",
    "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '' WHEN 2 THEN 'mc-options-count' WHEN 5 THEN '' ELSE 'mc-options-duplicate' END AS issues FROM labels",
)
def _options(spark: SparkSession, sf_dir: str) -> DataFrame:
    # alike by case folding, though not by lower case: sharp s, final sigma
    kinds = ['"c","d"', '"A","d"', '"d"', '"Straße","STRASSE"', '"λόγος","ΛΌΓΟΣ"', '"mass","Maß 1"']
    options = F.get(F.array(*[F.lit(k) for k in kinds]), F.col("doc_id") % 6)
    item = F.concat(F.lit('{"q":"Which claim is best supported?","op":["a","b",'), options, F.lit('],"ai":0,"ex":"Because the source says so."}'))
    rows = table(spark, sf_dir, "labels").select("doc_id", F.lit("mc-item").alias("kind"), item.alias("text"))
    return lessons.validate_responses(rows, kinds=("mc-item",)).select("doc_id", F.array_join("issues", ",").alias("issues"))


@query(
    "fact_indexes",
    "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'mc-fact-index-invalid' WHEN 2 THEN 'mc-fact-index-count' ELSE 'mc-fact-index-invalid' END AS issues FROM labels",
)
def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = F.get(F.array(F.lit("[0,4]"), F.lit("[1,1]"), F.lit("[]"), F.lit("[true]")), F.col("doc_id") % 4)
    item = F.concat(F.lit(ITEM + ',"fi":'), index, F.lit("}"))
    rows = table(spark, sf_dir, "labels").select("doc_id", F.lit("mc-item").alias("kind"), item.alias("text"))
    return lessons.validate_responses(rows, kinds=("mc-item",)).select("doc_id", F.array_join("issues", ",").alias("issues"))


JUDGMENTS = [
    '{"preferred":"A","preferredScore":5,"groundingPass":true,"pedagogyPass":true,"issues":[]}',
    '{"preferred":"A","preferredScore":true,"groundingPass":true,"pedagogyPass":true,"issues":[]}',
    '{"preferred":"B","preferredScore":4,"groundingPass":true,"pedagogyPass":true,"issues":["x"]}',
    '{"preferred":"A","preferredScore":3,"groundingPass":true,"pedagogyPass":true,"issues":[]}',
    '{"preferred":"A","preferredScore":5,"groundingPass":true,"pedagogyPass":true,"issues":[1]}',
]


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.get(F.array(*map(F.lit, JUDGMENTS)), F.col("doc_id") % 5)
    return table(spark, sf_dir, "labels").select("doc_id", text.alias("judgment"))


@query("judgment_shape", "SELECT doc_id, doc_id % 5 IN (0, 2, 3) AS ok FROM labels")
def _shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("doc_id", admission.judgment_shape(F.col("judgment")).alias("ok"))


@query("critic_admission", "SELECT doc_id, doc_id % 5 = 0 AS ok FROM labels")
def _critic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("doc_id", admission.admitted(F.col("judgment"), F.lit("A")).alias("ok"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    ask = turn("user", F.col("text"))
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("category"), F.array(ask, turn("assistant", F.lit("good"))).alias("chosen"),
        F.array(ask, turn("assistant", F.lit("bad"))).alias("rejected"), F.struct(F.lit("train").alias("split"), F.col("lang").alias("domain")).alias("provenance"),
    )


@query(
    "judge_pairs",
    """
SELECT id, label AS chosen_label, CASE label WHEN 'A' THEN 'good' ELSE 'bad' END AS candidate_a, CASE label WHEN 'A' THEN 'bad' ELSE 'good' END AS candidate_b, 1 AS turns
FROM (SELECT doc_id::VARCHAR AS id, CASE WHEN right(sha256(doc_id::VARCHAR), 1) IN ('0','2','4','6','8','a','c','e') THEN 'A' ELSE 'B' END AS label FROM documents)
""",
)
def _judge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.judge_pairs(_pairs(spark, sf_dir)).select("id", "chosen_label", "candidate_a", "candidate_b", F.size("task").alias("turns"))


@query("orpo_rows", "SELECT doc_id::VARCHAR AS id, lang AS category, 'good' AS chosen, 'bad' AS rejected, lang AS domain FROM documents")
def _orpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = lambda c: F.element_at(c, -1)["content"]
    return admission.preference_rows(_pairs(spark, sf_dir)).select("id", "category", last("chosen").alias("chosen"), last("rejected").alias("rejected"), "provenance.domain")
