"""Lessons, key terms and responses of every kind, with flaws that follow from each label's id.

A template is JSON with marks; a mark is a Spark SQL expression over doc_id. The twin states, for each code, when it holds.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.operators import contracts, lessons
from prefmill.plans.registry import query, table

Codes = list[tuple[str, str]]


def filled(template: object, marks: dict[str, str]) -> str:
    """The Spark SQL text of a JSON template, "@name@" (with its quotes) standing for an expression that gives JSON."""
    parts = re.split(r'"@(\w+)@"', json.dumps(template, ensure_ascii=False))
    assert not any("'" in p or "\\" in p for p in parts[::2])
    return "concat(" + ", ".join(f"({marks[p]})" if k % 2 else f"'{p}'" for k, p in enumerate(parts)) + ")"


def told(codes: Codes, ordered: bool = False) -> str:
    """DuckDB SQL for the codes that hold, joined; ordered: sorted and each once."""
    found = "list_filter([" + ", ".join(f"CASE WHEN {on} THEN '{code}' END" for code, on in codes) + "], lambda x: x IS NOT NULL)"
    return f"array_to_string({f'list_sort(list_distinct({found}))' if ordered else found}, ',')"


def quoted(expression: str) -> str:
    return f"concat('\"', {expression}, '\"')"


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels, dealt to all cores: a few bytes a row make few splits, and a lesson a row is much work."""
    return table(spark, sf_dir, "labels").select("doc_id").repartition(4 * spark.sparkContext.defaultParallelism, "doc_id")


# -- key terms --------------------------------------------------------------------

DEFINED, CORRECTED = "concat('defines ', repeat('d', CAST(8 + doc_id % 9 AS INT)))", "concat('corrects ', repeat('c', CAST(5 + doc_id % 8 AS INT)))"
TERM = {"tr": "@tr@", "df": "@df@", "eg": "@eg@", "mi": "@mi@", "cx": "@cx@"}
TERM_MARKS = {
    "tr": quoted("repeat('t', CAST(1 + doc_id % 3 AS INT))"), "df": quoted(DEFINED), "eg": quoted("repeat('e', CAST(8 + doc_id % 7 AS INT))"), "cx": quoted(CORRECTED),
    "mi": quoted(f"CASE doc_id % 6 WHEN 0 THEN concat(' ', {DEFINED}, '!') WHEN 1 THEN upper(replace({CORRECTED}, ' ', '  ')) ELSE concat('mistake ', repeat('m', CAST(2 + doc_id % 5 AS INT))) END"),
}
TERM_CODES: Codes = [
    ("key-term-tr", "1 + doc_id % 3 < 2"), ("key-term-df", "16 + doc_id % 9 < 20"), ("key-term-eg", "8 + doc_id % 7 < 12"), ("key-term-mi", "doc_id % 6 > 1 AND 10 + doc_id % 5 < 12"),
    ("key-term-cx", "14 + doc_id % 8 < 18"), ("key-term-mi-equals-cx", "doc_id % 6 = 1"), ("key-term-mi-repeats-df", "doc_id % 6 = 0"),
]


def _count(codes: Codes) -> str:
    return " + ".join(f"({on})::INT" for _, on in codes)


@query(
    "key_terms",
    f"""
SELECT doc_id, CASE doc_id % 17 WHEN 3 THEN 'root-not-object' WHEN 4 THEN 'invalid-json' ELSE {told(TERM_CODES)} END AS issues,
    CASE WHEN doc_id % 17 IN (3, 4) THEN 0 ELSE round(1 - ({_count(TERM_CODES)}) / 12.0, 6) END::DOUBLE AS score FROM labels
""",
)
def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"CASE doc_id % 17 WHEN 3 THEN '[1]' WHEN 4 THEN 'no json' ELSE {filled(TERM, TERM_MARKS)} END"
    rows = table(spark, sf_dir, "labels").select("doc_id", F.lit("key-term").alias("kind"), F.expr(text).alias("text"))
    found = lessons.validate_responses(rows, kinds=("key-term",))
    return found.select("doc_id", F.array_join("issues", ",").alias("issues"), F.round("score", 6).alias("score"))


# -- lessons ----------------------------------------------------------------------

FACTS = [f"Fact number {k} states one checkable thing." for k in range(5)]
GOOD_TERM = {"tr": "term", "df": "What the term means, in some words.", "eg": "An example of it.", "mi": "A usual mistake.", "cx": "How the mistake is mended."}
GOOD_ITEM = {"q": "Which claim is best supported?", "op": ["a", "b", "c", "d"], "ai": 1, "ex": "Because the source says so.", "fi": [0, 4]}
LESSON = {
    "lessonId": "@id@", "facts": "@facts@", "keyTerms": "@terms@", "scenario": "@scenario@",
    "discussionPrompt": {"pr": "What would you weigh first here?", "tn": "Two good aims are at odds.", "po": "@positions@"},
    "assignmentCore": {"td": "Compare two sources and write down where they differ.", "pa": "@parameters@"},
    "mc": "@mc@", "studyGuide": {"sm": "@summary@", "rs": "Cover the page and recall each fact in turn."},
}


def _list(*items: object) -> str:
    return json.dumps(list(items), ensure_ascii=False)


def _case(turn: str, other: str, else_: str) -> str:
    return f"CASE WHEN {turn} THEN '{other}' ELSE '{else_}' END"


LESSON_MARKS = {
    "id": quoted("concat('ald-x-', doc_id % 3)"),
    "facts": f"CASE WHEN doc_id % 4 = 1 THEN '{_list(*FACTS[:4])}' WHEN doc_id % 7 = 2 THEN '{_list(*FACTS[:2], 'short', *FACTS[3:])}' ELSE '{_list(*FACTS)}' END",
    "terms": f"CASE WHEN doc_id % 5 = 3 THEN '{_list(GOOD_TERM, GOOD_TERM)}' WHEN doc_id % 6 = 4 THEN '{_list(GOOD_TERM, {**GOOD_TERM, 'eg': 'short'}, GOOD_TERM)}' WHEN doc_id % 6 = 5 THEN '{_list(GOOD_TERM, GOOD_TERM, 7)}' ELSE '{_list(*[GOOD_TERM] * 3)}' END",
    "scenario": "CASE WHEN doc_id % 8 = 5 THEN '[]' ELSE concat('{\"su\":\"', repeat('s', CAST(30 + doc_id % 11 AS INT)), '\",\"ma\":\"some materials to read\"}') END",
    "positions": _case("doc_id % 9 = 6", _list("a", "b"), _list("a", "b", "c")),
    "parameters": _case("doc_id % 10 = 7", _list("a", "b", "c"), _list("a", "b", "c", "d")),
    "mc": f"CASE WHEN doc_id % 13 = 9 THEN '{_list(*[GOOD_ITEM] * 3)}' WHEN doc_id % 12 = 10 THEN '{_list(GOOD_ITEM, GOOD_ITEM, {**GOOD_ITEM, 'op': ['a', 'A', 'c', 'd']}, GOOD_ITEM)}' ELSE '{_list(*[GOOD_ITEM] * 4)}' END",
    "summary": quoted("CASE WHEN doc_id % 11 = 8 THEN 'What This  lesson holds is said elsewhere, as are the Success Criteria of it.' ELSE 'The five facts are about evidence, and each can be checked in its source.' END"),
}
FOUR_MC, THREE_TERMS = "doc_id % 13 <> 9", "doc_id % 5 <> 3"
LESSON_CODES: Codes = [
    ("facts-count", "doc_id % 4 = 1"), ("fact-too-short", "doc_id % 4 <> 1 AND doc_id % 7 = 2"), ("key-terms-count", "doc_id % 5 = 3"), ("mc-count", "doc_id % 13 = 9"),
    ("scenario-not-object", "doc_id % 8 = 5"), ("scenario-setup", "doc_id % 8 <> 5 AND 30 + doc_id % 11 < 35"), ("discussion-positions-count", "doc_id % 9 = 6"),
    ("assignment-parameters-count", "doc_id % 10 = 7"), ("key-term-1:key-term-eg", f"{THREE_TERMS} AND doc_id % 6 = 4"), ("key-term-2:key-term-not-object", f"{THREE_TERMS} AND doc_id % 6 = 5"),
    ("mc-2:mc-options-duplicate", f"{FOUR_MC} AND doc_id % 12 = 10"), *[(f"mc-{k}:mc-fact-index-invalid", f"{FOUR_MC} AND doc_id % 4 = 1") for k in range(4)],
    ("meta-language:success-criteria", "doc_id % 11 = 8"),
]
KERNEL_CODES: Codes = [*LESSON_CODES, ("wrong-lesson-id", "doc_id % 3 > 0"), ("source-facts-changed", "doc_id % 4 = 1 OR doc_id % 7 = 2")]


@query(
    "lesson_kernels",
    f"SELECT doc_id, CASE doc_id % 19 WHEN 5 THEN 'lessons-count,source-facts-changed,wrong-lesson-id' WHEN 6 THEN 'unknown-contract' ELSE {told(KERNEL_CODES, True)} END AS issues FROM labels",
)
def _kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = f"CASE doc_id % 19 WHEN 5 THEN '{{\"lessons\":[]}}' ELSE {filled({'lessons': [LESSON]}, LESSON_MARKS)} END"
    oracle = json.dumps({"lessonId": "ald-x-0", "facts": FACTS})
    contract = F.when(F.col("doc_id") % 19 == 6, "x-lesson-kernel-json-v1").otherwise("lesson-kernel-json-v1")
    rows = labels(spark, sf_dir).select("doc_id", contract.alias("contract"), F.expr(answer).alias("answer"), F.lit(oracle).alias("oracle"))
    return contracts.validate(rows, only=("lesson-kernel-json-v1",)).select("doc_id", F.array_join("issues", ",").alias("issues"))


#: The edit puts another first fact in; whatever the lesson was, its facts are changed then.
EDITED_CODES: Codes = [(c, "true" if c == "source-facts-changed" else on) for c, on in KERNEL_CODES]


@query("rejected_lessons", f"SELECT doc_id, {told(EDITED_CODES, True)} AS issues FROM labels")
def _edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    oracle = json.dumps({"lessonId": "ald-x-0", "facts": FACTS})
    rows = labels(spark, sf_dir).select(
        "doc_id", F.lit("lesson-kernel-json-v1").alias("contract"), F.expr(filled({"lessons": [LESSON]}, LESSON_MARKS)).alias("answer"), F.lit(oracle).alias("oracle")
    )
    found = contracts.construct_rejected(rows, only=("lesson-kernel-json-v1",))
    return found.select("doc_id", F.array_join("rejected_issues", ",").alias("issues"))


# -- responses of all kinds ---------------------------------------------------------

BUNDLE = {"mcItems": "@items@", "keyTerms": "@terms@"}
BUNDLE_MARKS = {
    "items": f"CASE doc_id % 3 WHEN 0 THEN '[]' WHEN 1 THEN '{_list(GOOD_ITEM, 'no')}' ELSE '{_list({**GOOD_ITEM, 'ai': 4})}' END",
    "terms": f"CASE doc_id % 4 WHEN 0 THEN '{{}}' WHEN 1 THEN '{_list({**GOOD_TERM, 'tr': 't'})}' ELSE '{_list(GOOD_TERM)}' END",
}
BUNDLE_CODES: Codes = [
    ("bundle-mc-count", "doc_id % 3 = 0"), ("mc-1:mc-not-object", "doc_id % 3 = 1"), ("mc-0:mc-answer-index", "doc_id % 3 = 2"),
    ("bundle-key-term-count", "doc_id % 4 = 0"), ("key-term-0:key-term-tr", "doc_id % 4 = 1"),
]


@query(
    "response_kinds",
    f"""
SELECT doc_id, kind, CASE kind WHEN 'key-term' THEN {told(TERM_CODES)} WHEN 'source-bundle' THEN {told(BUNDLE_CODES)} WHEN 'lesson' THEN {told(LESSON_CODES, True)}
    WHEN 'mc-item' THEN CASE WHEN doc_id % 2 = 0 THEN 'mc-fact-index-count' ELSE '' END ELSE 'unknown-response-kind' END AS issues
FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'lesson' WHEN 1 THEN 'mc-item' WHEN 2 THEN 'key-term' WHEN 3 THEN 'source-bundle' ELSE 'poem' END AS kind FROM labels)
""",
)
def _kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = f"CASE WHEN doc_id % 2 = 0 THEN '{json.dumps({**GOOD_ITEM, 'fi': [1, 2, 3]})}' ELSE '{json.dumps({k: v for k, v in GOOD_ITEM.items() if k != 'fi'})}' END"
    text = f"""CASE doc_id % 5 WHEN 0 THEN {filled({"lessons": [LESSON]}, LESSON_MARKS)} WHEN 1 THEN {item} WHEN 2 THEN {filled(TERM, TERM_MARKS)}
        WHEN 3 THEN {filled(BUNDLE, BUNDLE_MARKS)} ELSE '{{}}' END"""
    kind = "CASE doc_id % 5 WHEN 0 THEN 'lesson' WHEN 1 THEN 'mc-item' WHEN 2 THEN 'key-term' WHEN 3 THEN 'source-bundle' ELSE 'poem' END"
    rows = table(spark, sf_dir, "labels").select("doc_id", F.expr(kind).alias("kind"), F.expr(text).alias("text"))
    found = lessons.validate_responses(rows).withColumn("issues", F.when(F.col("kind") == "lesson", F.array_sort(F.array_distinct("issues"))).otherwise(F.col("issues")))
    return found.select("doc_id", "kind", F.array_join("issues", ",").alias("issues"))
