"""Validators over answers that vary with each label's id, flows with scripted models, and JSON lines.

An answer is written by a Spark SQL expression over doc_id; its twin computes the issue
codes from the same arithmetic.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.functions import hashing, text
from prefmill.operators import admission, audit, canary, contracts, corpus, flows, receipts, schemas
from prefmill.plans.registry import query, table
from prefmill.plans.tasks import PLAN_SQL, task_plan
from prefmill.sources import jsonl, seeds
from prefmill.sources.shared import folder

CITED = '"requiredCitations":["s"],"allowedCitations":["s","t"]'
#: Citations by doc_id % 7: mostly the right one, one that is allowed but not the one asked for, one invented.
CITES = "concat('\"citations\":[\"', CASE doc_id % 7 WHEN 5 THEN 't' WHEN 6 THEN 'z' ELSE 's' END, '\"]')"
CITE_CODES = [("hallucinated-citation", "doc_id % 7 = 6"), ("missing-required-citation", "doc_id % 7 >= 5")]
EXPLAINED = "concat('\"explanation\":\"', repeat('x', CAST(10 + doc_id % 21 AS INT)), '\",')"
EXPLAIN_CODE = [("short-text:explanation", "10 + doc_id % 21 < 20")]
#: Contract -> (answer and oracle as Spark SQL, codes with the condition of each as DuckDB SQL).
CASES: dict[str, tuple[str, str, list[tuple[str, str]]]] = {
    "schedule-json-v1": (
        f"""concat('{{"feasible":', IF(doc_id % 2 = 0, 'true', 'false'), ',"sectionIds":["', IF(doc_id % 3 = 1, 'b', 'a'), '"],"totalCredits":', 10 + doc_id % 4,
           ',"conflicts":', IF(doc_id % 5 = 2, '["x"]', '[]'), ',', {EXPLAINED}, {CITES}, '}}')""",
        f"""'{{"feasible":true,"sectionIds":["a"],"totalCredits":10,{CITED}}}'""",
        [*CITE_CODES, *EXPLAIN_CODE, ("unexpected-conflicts", "doc_id % 5 = 2"), ("wrong-feasible", "doc_id % 2 = 1"), ("wrong-sectionIds", "doc_id % 3 = 1"),
         ("wrong-totalCredits", "doc_id % 4 > 0")],
    ),
    "degree-audit-json-v1": (
        f"""concat('{{"complete":', IF(doc_id % 2 = 0, 'false', 'true'), ',"remainingByGroup":{{"b":1,"a":', doc_id % 3, '}},"eligibleOptions":{{"a":["x', doc_id % 5, '"]}},',
           {EXPLAINED}, {CITES}, '}}')""",
        f"""'{{"complete":false,"remainingByGroup":{{"a":0.0,"b":1}},"eligibleOptions":{{"a":["x1"]}},{CITED}}}'""",
        [*CITE_CODES, *EXPLAIN_CODE, ("wrong-complete", "doc_id % 2 = 1"), ("wrong-eligibleOptions", "doc_id % 5 <> 1"), ("wrong-remainingByGroup", "doc_id % 3 > 0")],
    ),
    "uncertainty-json-v1": (
        f"""concat('{{"answer":"', IF(doc_id % 4 = 1, 'yes', 'insufficient_information'), '","known":', IF(doc_id % 3 = 2, '[]', '["x"]'), ',"needed":["The ',
           IF(doc_id % 5 = 4, 'other', 'LIST'), ' of ', doc_id, '."],"nextAction":"', repeat('n', CAST(12 + doc_id % 8 AS INT)), '",', {CITES}, '}}')""",
        f"""concat('{{"answer":"insufficient_information","neededContains":"list OF ', doc_id, '",{CITED}}}')""",
        [*CITE_CODES[:1], ("known-not-list", "doc_id % 3 = 2"), ("missing-information-not-identified", "doc_id % 5 = 4"), *CITE_CODES[1:],
         ("short-text:nextAction", "12 + doc_id % 8 < 15"), ("unsupported-answer", "doc_id % 4 = 1")],
    ),
    "tutor-json-v1": (
        f"""concat('{{"diagnosis":"', repeat('d', CAST(doc_id % 9 AS INT)), '","hint":"', repeat('h', CAST(doc_id % 8 AS INT)), '","workedExplanation":"it is ', IF(doc_id % 3 = 1, 'no', concat(doc_id, '/7')),
           '","checkQuestion":"?","checkAnswer":"', IF(doc_id % 4 = 3, ' ', 'x'), '",', {CITES}, '}}')""",
        f"""concat('{{"minimumLengths":{{"diagnosis":5,"hint":4}},"answerContains":"', doc_id, '/7",{CITED}}}')""",
        [("expected-answer-absent", "doc_id % 3 = 1"), *CITE_CODES, ("short-text:checkAnswer", "doc_id % 4 = 3"), ("short-text:diagnosis", "doc_id % 9 < 5"), ("short-text:hint", "doc_id % 8 < 4")],
    ),
    "tool-call-json-v1": (
        """concat('{"tool":"', IF(doc_id % 3 = 1, 'x', 'catalog.lookup'), '","arguments":', IF(doc_id % 11 = 4, '[]', concat('{"courseCodes":["', IF(doc_id % 6 = 5, 'B', 'A'), ' ', doc_id,
           '"],"term":"', IF(doc_id % 5 = 1, 'fall', 'spring'), '"', IF(doc_id % 7 = 3, ',"more":1', ''), '}')), ',"reason":"', repeat('r', CAST(10 + doc_id % 12 AS INT)),
           '","answerDeferred":', CASE doc_id % 4 WHEN 2 THEN '1' WHEN 3 THEN 'false' ELSE 'true' END, '}')""",
        """concat('{"tool":"catalog.lookup","courseCodes":["A ', doc_id, '"],"term":"spring","answerDeferred":true}')""",
        [("answer-not-deferred", "doc_id % 4 >= 2"), ("arguments-not-object", "doc_id % 11 = 4"), ("short-text:reason", "10 + doc_id % 12 < 15"),
         ("wrong-argument-keys", "doc_id % 11 <> 4 AND doc_id % 7 = 3"), ("wrong-course-codes", "doc_id % 11 <> 4 AND doc_id % 6 = 5"),
         ("wrong-term", "doc_id % 11 <> 4 AND doc_id % 5 = 1"), ("wrong-tool", "doc_id % 3 = 1")],
    ),
    "safety-json-v1": (
        """concat('{"boundary":"', IF(doc_id % 3 = 2, 'x', 'b'), '","cannotDo":"', repeat('c', CAST(10 + doc_id % 10 AS INT)), '","canHelpWith":["outline your own plan"',
           CASE WHEN doc_id % 5 = 1 THEN '' WHEN doc_id % 7 = 4 THEN ',"weak"' ELSE ',"check your own sources"' END, '],"nextStep":"', repeat('n', CAST(12 + doc_id % 6 AS INT)), '"}')""",
        """'{"boundary":"b","alternativeCount":2}'""",
        [("short-text:cannotDo", "10 + doc_id % 10 < 15"), ("short-text:nextStep", "12 + doc_id % 6 < 15"), ("weak-alternative", "doc_id % 5 <> 1 AND doc_id % 7 = 4"),
         ("wrong-alternative-count", "doc_id % 5 = 1"), ("wrong-boundary", "doc_id % 3 = 2")],
    ),
}


def _answers(spark: SparkSession, sf_dir: str, contract: str) -> DataFrame:
    answer, oracle, _ = CASES[contract]
    return table(spark, sf_dir, "labels").select("doc_id", F.lit(contract).alias("contract"), F.expr(answer).alias("answer"), F.expr(oracle).alias("oracle"))


def _codes_sql(codes: list[tuple[str, str]]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {on} THEN '{code}' END" for code, on in codes) + ")"


def _register(contract: str) -> None:
    name = "validate_" + contract.removesuffix("-json-v1").replace("-", "_")

    @query(name, f"SELECT doc_id, {_codes_sql(CASES[contract][2])} AS issues FROM labels")
    def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = contracts.validate(_answers(spark, sf_dir, contract), only=(contract,))
        return rows.select("doc_id", F.array_join("issues", ",").alias("issues"))


for _contract in CASES:
    _register(_contract)

#: The edit of each contract's answer makes this wrong, besides what was wrong before.
EDITS = {
    "schedule-json-v1": "wrong-totalCredits", "degree-audit-json-v1": "wrong-remainingByGroup", "uncertainty-json-v1": "unsupported-answer",
    "tutor-json-v1": "hallucinated-citation", "tool-call-json-v1": "answer-not-deferred", "safety-json-v1": "wrong-alternative-count",
}
#: Codes that a contract's edit makes hold besides.
ALSO = {"tutor-json-v1": ("missing-required-citation",)}


def _edited_sql() -> str:
    each = []
    for contract, code in EDITS.items():
        # the edit's own code always holds; a changed list of alternatives is never weak
        codes = [(c, "true" if c == code or c in ALSO.get(contract, ()) else "false" if c == "weak-alternative" else on) for c, on in CASES[contract][2]]
        each.append(f"SELECT doc_id, '{contract}' AS contract, {_codes_sql(codes)} AS issues FROM labels")
    return " UNION ALL ".join(each)


@query("rejected_edits", _edited_sql())
def _edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for contract in EDITS:
        rows = contracts.construct_rejected(_answers(spark, sf_dir, contract), only=(contract,))
        part = rows.select("doc_id", "contract", F.array_join("rejected_issues", ",").alias("issues"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "canary_answers",
    """
SELECT doc_id, concat_ws(',', CASE WHEN doc_id % 2 = 1 THEN 'eligibility' END, CASE WHEN doc_id % 3 = 1 THEN 'missing-prerequisite' END, CASE WHEN doc_id % 5 = 1 THEN 'catalog-citations' END) AS issues FROM labels
""",
)
def _canary(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.expr(
        """concat('{"eligible":', IF(doc_id % 2 = 1, 'true', 'false'), ',"missing":["', IF(doc_id % 3 = 1, 'C 9', 'C 2'), '"],"citations":["C 3"', IF(doc_id % 5 = 1, '', ',"C 2"'), ',"C 8"]}')"""
    )
    found = canary.canary_issues(answer, ["C 2"], ["C 2", "C 3"])
    return table(spark, sf_dir, "labels").select("doc_id", F.array_join(found, ",").alias("issues"))


#: A choice item whose parts go wrong by doc_id, as Spark SQL; and what its schema finds, as DuckDB SQL.
ITEM_TEXT = """CASE doc_id % 13 WHEN 6 THEN '[]' WHEN 7 THEN '{"q":' ELSE concat('{"q":"', repeat('q', CAST(4 + doc_id % 270 AS INT)), '",',
    IF(doc_id % 7 = 3, '', concat('"op":[', CASE doc_id % 5 WHEN 0 THEN '"a","b","c","d"' WHEN 1 THEN '"a","b","c"' WHEN 2 THEN '"a","b","b","d"' WHEN 3 THEN '"a","","c","d"' ELSE '"a",1,"c","d","e"' END, '],')),
    '"ai":', CASE doc_id % 8 WHEN 4 THEN '-1' WHEN 5 THEN '9' WHEN 6 THEN '"x"' WHEN 7 THEN '2.5' ELSE CAST(doc_id % 8 AS STRING) END, ',"ex":"', repeat('é', CAST(10 + doc_id % 20 AS INT)), '",',
    IF(doc_id % 11 = 4, '"more":null,', ''), '"fi":', CASE doc_id % 9 WHEN 0 THEN '[]' WHEN 1 THEN '[1,2,3]' WHEN 2 THEN '[1,-1]' WHEN 3 THEN '"1"' ELSE '[0]' END, '}') END"""
ITEM_CODES = [
    ("op:missing", "doc_id % 7 = 3"), ("more:extra", "doc_id % 11 = 4"), ("q:short", "4 + doc_id % 270 < 12"), ("q:long", "4 + doc_id % 270 > 256"), ("op:few", "doc_id % 7 <> 3 AND doc_id % 5 = 1"),
    ("op:many", "doc_id % 7 <> 3 AND doc_id % 5 = 4"), ("op:repeated", "doc_id % 7 <> 3 AND doc_id % 5 = 2"), ("op[1]:short", "doc_id % 7 <> 3 AND doc_id % 5 = 3"),
    ("op[1]:type", "doc_id % 7 <> 3 AND doc_id % 5 = 4"), ("ai:low", "doc_id % 8 = 4"), ("ai:high", "doc_id % 8 = 5"), ("ai:type", "doc_id % 8 >= 6"), ("ex:short", "10 + doc_id % 20 < 18"),
    ("fi:few", "doc_id % 9 = 0"), ("fi:many", "doc_id % 9 = 1"), ("fi[1]:low", "doc_id % 9 = 2"), ("fi:type", "doc_id % 9 = 3"),
]


@query("schema_violations", f"SELECT doc_id, CASE doc_id % 13 WHEN 6 THEN ':type' WHEN 7 THEN ':json' ELSE {_codes_sql(ITEM_CODES)} END AS violations FROM labels")
def _schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").select("doc_id", F.expr(ITEM_TEXT).alias("answer"))
    return schemas.check(rows, schemas.ITEM).select("doc_id", F.array_join("violations", ",").alias("violations"))


@query(
    "schema_typed",
    """
SELECT doc_id, 'a|b|c|d' AS options, doc_id % 8 AS answer, 10 + doc_id % 20 AS explained FROM labels
WHERE doc_id % 13 NOT IN (6, 7) AND doc_id % 7 <> 3 AND doc_id % 11 <> 4 AND 4 + doc_id % 270 BETWEEN 12 AND 256 AND doc_id % 5 = 0 AND doc_id % 8 < 4 AND doc_id % 20 >= 8 AND doc_id % 9 > 3
""",
)
def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").select("doc_id", F.expr(ITEM_TEXT).alias("answer"))
    found = schemas.typed(rows, schemas.ITEM).where("value IS NOT NULL")
    return found.select("doc_id", F.array_join("value.op", "|").alias("options"), F.col("value.ai").alias("answer"), F.length("value.ex").cast("bigint").alias("explained"))


# -- flows with a scripted model ------------------------------------------------


def scripted_teacher(messages: Sequence[Mapping[str, str]], settings: Mapping[str, Any]) -> dict[str, Any]:
    """Answers a tool task rightly from attempt k on, k being the first course number's last digit modulo 4."""
    first, second = messages[1]["content"].removeprefix("Do ").split(" fit ")[0].split(" and ")
    attempt = (settings["seed"] - 16031) % 7
    right = attempt >= int(first.split(" ")[1]) % 10 % 4
    told = json.loads(messages[-1]["content"].split(": ", 1)[1].split(". Send", 1)[0]) if attempt else []
    body = {
        "tool": "catalog.lookup", "arguments": {"courseCodes": [first, second], "term": "spring"}, "answerDeferred": right,
        "reason": "The catalog has to be looked up first; issues so far: " + ",".join(told),
    }
    return {"text": json.dumps(body), "metrics": {"generation_tokens": 100 + attempt, "tokens_per_second": 20.0, "peak_memory_gb": 1.0 + attempt}, "receipt": {"attempt": attempt}}


def scripted_critic(messages: Sequence[Mapping[str, str]], settings: Mapping[str, Any]) -> str:
    """Prefers the candidate that defers its answer; malformed at first for every second task."""
    pair = json.loads(messages[1]["content"])
    first = pair["candidateA"]["answerDeferred"]
    number = int(pair["candidateA"]["arguments"]["courseCodes"][0].split(" ")[1])
    if len(messages) == 2 and number % 2:
        return "A, I think"
    score = 3 if number % 5 == 0 else 5
    return "Here: " + json.dumps({"preferred": "A" if first else "B", "preferredScore": score, "groundingPass": True, "pedagogyPass": True, "issues": []})


def _taught(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = seeds.seed_rows(spark, task_plan(spark, sf_dir), only=("tool-use",))
    return flows.teacher(tasks, "train", scripted_teacher)


TAUGHT_SQL = f"SELECT 'train-tool-use-' || printf('%03d', idx) AS id, idx, (410 + idx) % 10 % 4 AS k FROM {PLAN_SQL} WHERE split = 'train'"


@query(
    "teacher_flow",
    f"""
SELECT id, CASE WHEN k < 3 THEN 'admitted' ELSE 'excluded' END AS status, least(k + 1, 3)::INT AS attempts, CASE WHEN k < 3 THEN '' ELSE 'answer-not-deferred' END AS issues,
       (100 + least(k, 2))::BIGINT AS tokens, '{{"attempt": ' || least(k, 2) || '}}' AS receipt FROM ({TAUGHT_SQL})
""",
)
def _teacher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _taught(spark, sf_dir).select("id", "status", "attempts", F.array_join("issues", ",").alias("issues"), F.col("metrics.generation_tokens").alias("tokens"), "receipt")


@query(
    "critic_flow",
    f"""
SELECT id, CASE WHEN (410 + idx) % 5 = 0 THEN 'critic-rejected' ELSE 'critic-admitted' END AS status, CASE WHEN (410 + idx) % 2 = 1 THEN 'false,true' ELSE 'true' END AS shapes, 1::BIGINT AS seq
FROM ({TAUGHT_SQL}) WHERE k < 3
""",
)
def _critic(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = flows.critic(_taught(spark, sf_dir), scripted_critic)
    return seen.select("id", "status", F.array_join(F.transform("valid_shapes", lambda x: x.cast("string")), ",").alias("shapes"), "seq")


@query(
    "preference_flow",
    f"""
SELECT id, 'train' AS split, 'academic-operations' AS domain, 'pref-train-tool-use-' || (idx % 4) AS group_id FROM ({TAUGHT_SQL}) WHERE k < 3 AND (410 + idx) % 5 > 0
""",
)
def _preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _taught(spark, sf_dir)
    return flows.preference_corpus(rows, flows.critic(rows, scripted_critic)).select("id", "split", "domain", "group_id")


# -- JSON lines -----------------------------------------------------------------


@query("jsonl_append", "SELECT doc_id, lang, n_chars, 2::BIGINT AS times FROM documents")
def _append(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text")
    path = folder(spark, "jsonl")
    jsonl.write(docs, path)
    jsonl.write(docs, path, append=True)
    back = jsonl.read(spark, path, docs.schema)
    return back.groupBy("doc_id", "lang", "n_chars", "text").agg(F.count(F.lit(1)).alias("times")).drop("text")


@query(
    "jsonl_lines",
    "SELECT CASE event_id % 4 WHEN 1 THEN 'invalid-json' WHEN 2 THEN 'root-not-object' ELSE 'ok' END AS issue, count(*) AS n FROM events WHERE event_id % 4 < 3 GROUP BY 1",
)
def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 4
    line = F.when(k == 0, F.col("props")).when(k == 1, F.concat("props", F.lit(" no"))).when(k == 2, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.lit("  "))
    path = folder(spark, "lines")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return jsonl.scan_strict(spark, path).groupBy(F.coalesce("issue", F.lit("ok")).alias("issue")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_files",
    "SELECT split, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'valid' ELSE 'test' END AS split FROM documents) GROUP BY split",
)
def _splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, top = table(spark, sf_dir, "documents").select("doc_id", "lang"), folder(spark, "splits")
    files = {s: f"{top}/{corpus.SPLIT_FILE[s]}" for s in corpus.SPLITS}
    for k, path in enumerate(files.values()):
        jsonl.write(docs.where(F.col("doc_id") % 3 == k), path)
    return jsonl.read_splits(spark, files, docs.schema).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


# -- text, hashes, tokens ---------------------------------------------------------


@query("squeezed_text", r"SELECT doc_id, md5(trim(regexp_replace(lower(text), '\s+', ' ', 'g'))) AS digest FROM documents")
def _squeezed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.squeezed(F.col("text"))).alias("digest"))


@query(
    "neutral_markers",
    "SELECT doc_id, md5('< |tool_call>' || text || '<turn| ><|other>') AS digest FROM documents",
)
def _neutral(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit("<|tool_call>"), "text", F.lit("<turn|><|other>"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.neutral(said)).alias("digest"))


@query(
    "canonical_hashes",
    """SELECT doc_id, sha256('{"a":[' || n_chars || ',"' || source || '\\u00e9"],"b":{"id":' || doc_id || '}}') AS ascii_hash,
       sha256('{"a":[' || n_chars || ',"' || source || 'é"],"b":{"id":' || doc_id || '}}') AS plain_hash FROM documents""",
)
def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.lit('{ "b": {"id": '), F.col("doc_id").cast("string"), F.lit('}, "a" : ['), F.col("n_chars").cast("string"), F.lit(', "'), "source", F.lit('é"]}'))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.sha2(hashing.canonical_ascii(body), 256).alias("ascii_hash"), F.sha2(hashing.canonical_json(body), 256).alias("plain_hash")
    )


@query(
    "canonical_numbers",
    """SELECT doc_id, '{"n":[' || doc_id || '.5,' || doc_id || ',1e-' || (7 + doc_id % 5) || ',' || (1 + doc_id % 9) || 'e+' || (21 + doc_id % 9) || ',0.00' || (1 + doc_id % 9) || ']}' AS form FROM labels""",
)
def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    s = lambda c: c.cast("string")
    body = F.concat(
        F.lit('{"n": ['), s(d), F.lit(".50, "), s(d), F.lit(".0, 0.1E-"), s(6 + d % 5), F.lit(", "), s(1 + d % 9), F.lit("E"), s(21 + d % 9), F.lit(", "), s(1 + d % 9), F.lit("e-3]}")
    )
    return table(spark, sf_dir, "labels").select("doc_id", hashing.canonical_numbers(body).alias("form"))


def spaced(s: str) -> int:
    """Stand-in tokenizer: pieces between spaces and line ends."""
    return len(s.replace("\n", " ").split(" "))


@query("token_lengths", "SELECT doc_id, len(string_split(replace(text, chr(10), ' '), ' '))::BIGINT AS tokens FROM documents")
def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", audit.token_counter(spaced)(F.col("text")).alias("tokens"))


@query(
    "tensor_names",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'base.layers.' || doc_id || '.q.lora_A.weight' WHEN 1 THEN 'base.layers.' || doc_id || '.q.lora_B.weight' END AS name FROM labels""",
)
def _tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    tail = F.when(d % 4 == 0, ".q.lora_a").when(d % 4 == 1, ".q.lora_b").when(d % 4 == 2, ".q.bias").otherwise("..x.lora_a")
    name = F.concat(F.lit("m.text.layers."), d.cast("string"), tail)
    return table(spark, sf_dir, "labels").select("doc_id", text.tensor_name(name, "m.text.", "base.").alias("name"))


@query(
    "comparison_labels",
    "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'lite' ELSE 'pro' END || CASE doc_id % 3 WHEN 0 THEN '-strict' WHEN 1 THEN '-schema' ELSE '-evaluation' END AS label FROM labels",
)
def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    tier, protocol = F.when(d % 2 == 0, "lite").otherwise("pro"), F.concat(F.lit("p"), (d % 3).cast("string"))
    return table(spark, sf_dir, "labels").select("doc_id", receipts.comparison_label(tier, protocol, {"p0": "strict", "p1": "schema"}).alias("label"))


@query(
    "last_issues",
    """SELECT user_id, count(*) AS attempts, min(CASE WHEN event_type = 'view' THEN r END) AS success_at,
       CASE WHEN min(CASE WHEN event_type = 'view' THEN r END) IS NULL THEN arg_max(event_type, r) END AS last_issues
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS r FROM events) WHERE r < 3 GROUP BY user_id""",
)
def _last(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import window as W

    rank = F.row_number().over(W.Window.partitionBy("user_id").orderBy("event_id")) - 1
    log = table(spark, sf_dir, "events").select("user_id", (F.col("event_type") == "view").alias("ok"), rank.alias("attempt"), "event_type")
    got = admission.first_success(log, "user_id", issues="event_type")
    return got.select("user_id", "attempts", "success_at", "last_issues")
