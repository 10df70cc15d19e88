"""Receipts of runs, preconditions, identities and reports, made from the given tables with flaws that follow from each row's key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefmill.functions import hashing
from prefmill.functions import json as J
from prefmill.functions import text as X
from prefmill.operators import receipts
from prefmill.plans.registry import query, table

# -- the chain of a training run ------------------------------------------------

#: The part of a run's receipts that is wrong, and the runs (doc_id) where it is: (modulus, remainder).
BROKEN: dict[str, tuple[int, int]] = {
    "training-plan-protocol": (11, 3), "training-repository-dirty": (7, 2), "training-base": (13, 4), "training-dataset-manifest": (9, 5), "training-dataset-identity": (17, 6),
    "training-result-protocol": (8, 7), "training-adapter-id": (12, 1), "training-plan-sha256": (10, 9), "training-plan-identity": (14, 8), "token-audit-status": (6, 4),
    "token-audit-sha256": (15, 2), "token-audit-dataset:train": (16, 3), "token-audit-dataset:validation": (18, 5), "token-audit-dataset:test": (19, 0),
    "training-file:adapter_config.json": (5, 3), "training-file-integrity:adapter_config.json": (4, 1), "training-file:adapters.safetensors": (21, 7),
    "training-file-integrity:adapters.safetensors": (3, 2),
}


def _holds(code: str) -> str:
    modulus, rest = BROKEN[code]
    return f"doc_id % {modulus} = {rest}"


def _chain_sql() -> str:
    each = []
    for code in BROKEN:
        gone = code.replace("-integrity", "")
        each.append(f"CASE WHEN {_holds(code)}{f' AND NOT {_holds(gone)}' if gone != code else ''} THEN '{code}' END")
    return f"SELECT doc_id::VARCHAR AS run, concat_ws(',', {', '.join(each)}) AS issues FROM documents"


@query("receipt_chain", _chain_sql())
def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan, result, audit and dataset of a run for each document, whose text stands for the trained files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("size"))
    wrong = lambda code: F.expr(_holds(code))
    lit = lambda good, code: F.when(wrong(code), "other").otherwise(good)
    named = lambda word: F.sha2(F.concat(F.lit(word), "sha"), 256)
    js = lambda **fields: F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()])
    plan = js(
        protocol=lit("run-v1", "training-plan-protocol"), lane="research", repository=js(dirty=wrong("training-repository-dirty")),
        base=js(modelId="base", revision=lit("r1", "training-base")), dataset=js(manifestSha256=lit(named("manifest"), "training-dataset-manifest"), identitySha256=lit(named("identity"), "training-dataset-identity")),
        adapter=js(id=F.concat(F.lit("run-"), "doc_id")), identity=js(sha256=named("plan")), trainer=js(tokenAudit=js(sha256=lit(named("audit"), "token-audit-sha256"))),
    )
    record = lambda name, code, size: js(path=lit(name, f"training-file:{name}"), bytes=size, sha256=lit(F.col("sha"), code))
    first, second = receipts.PARTS
    result = js(
        protocol="result-v1", status=lit("completed", "training-result-protocol"), adapterId=F.when(wrong("training-adapter-id"), "other").otherwise(F.concat(F.lit("run-"), "doc_id")),
        planSha256=lit(named("plan-file"), "training-plan-sha256"), planIdentitySha256=lit(named("plan"), "training-plan-identity"),
        files=F.array(record(first, f"training-file-integrity:{first}", F.col("size")), record(second, f"training-file-integrity:{second}", F.col("size"))),
    )
    splits = js(**{s: js(sha256=lit(named(s), f"token-audit-dataset:{s}")) for s in receipts.SPLITS})
    audit = js(status=lit("pass", "token-audit-status"), files=splits)
    entry = F.struct(F.col("size").alias("bytes"), F.col("sha").alias("sha256"))
    rows = docs.select(
        F.col("doc_id").cast("string").alias("run"), F.to_json(plan).alias("plan"), F.to_json(result).alias("result"), F.to_json(audit).alias("audit"),
        F.to_json(js(identity=js(sha256=named("identity")))).alias("dataset"), named("plan-file").alias("plan_sha"), named("audit").alias("audit_sha"), named("manifest").alias("manifest_sha"),
        F.lit("base").alias("model_id"), F.lit("r1").alias("revision"), F.create_map(*[x for s in receipts.SPLITS for x in (F.lit(s), named(s))]).alias("split_sha"),
        F.create_map(F.lit(first), entry, F.lit(second), entry).alias("files"),
    )
    return receipts.chain_issues(rows, {"plan": "run-v1", "result": "result-v1"}).select("run", F.array_join("issues", ",").alias("issues"))


@query(
    "preconditions",
    """
SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 5 = 4 THEN 'variant' END, CASE WHEN NOT base AND c_custkey % 3 = 0 THEN 'adapter-manifest' END,
    CASE WHEN c_custkey % 7 = 1 OR c_custkey % 11 = 2 THEN 'base-pin' END, CASE WHEN NOT base AND c_custkey % 4 = 1 AND c_custkey % 6 <> 5 THEN 'scale' END, CASE WHEN tasks = 0 THEN 'empty-split' END) AS unmet
FROM (SELECT c_custkey, c_custkey % 5 < 2 AS base, count(o_orderkey) AS tasks FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
""",
)
def _preconditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run for each customer, whose orders are its tasks."""
    k = F.col("c_custkey")
    tasks = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_tasks"))
    runs = table(spark, sf_dir, "customer").select("c_custkey").join(tasks, "c_custkey", "left").withColumns({
        "n_tasks": F.coalesce("n_tasks", F.lit(0)), "variant": F.when(k % 5 < 2, "base").when(k % 5 < 4, "adapter").otherwise("neither"),
        "adapter_format": F.when(k % 3 > 0, "lora"), "base_name": F.lit("base.bin"), "pin_name": F.lit("base.bin"), "base_bytes": k + F.when(k % 7 == 1, 1).otherwise(0), "pin_bytes": k,
        "base_sha256": F.sha2(k.cast("string"), 256), "pin_sha256": F.when(k % 11 == 2, F.lit(None)).otherwise(F.sha2(k.cast("string"), 256)),
        "scale": F.when(k % 4 == 1, 0.5).otherwise(1.0), "locked_scale": F.lit(1.0), "tuning": k % 6 == 5,
    })
    return receipts.unmet(runs).select("c_custkey", F.array_join("unmet", ",").alias("unmet"))


@query(
    "receipt_paths",
    """
SELECT doc_id, '{"files":["' || source || '/' || doc_id || '.json","/elsewhere/' || lang || '"],"root":".","text":"see /data/run"}' AS receipt FROM documents
""",
)
def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = F.array(F.concat(F.lit("/data/run/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".json")), F.concat(F.lit("/elsewhere/"), "lang"))
    body = F.to_json(F.struct(files.alias("files"), F.lit("/data/run").alias("root"), F.lit("see /data/run").alias("text")))
    rows = table(spark, sf_dir, "documents").select("doc_id", body.alias("body"))
    return rows.select("doc_id", receipts.relative_paths("body", "/data/run").alias("receipt"))


# -- identities and reports -------------------------------------------------------


@query(
    "dataset_identities",
    """
SELECT source, sha256('{"counts":{"train":' || train || ',"valid":' || valid || '},"domainGroupCounts":null,"domainMap":{"entries":' || n || ',"sha256":null},"domains":["' || langs || '"],"evidenceCounts":null,'
    || '"files":[{"bytes":' || bytes || ',"path":"' || source || '.jsonl"}],"gate":null,"groupIdentity":null,"holdoutBoundary":null,"instructorDomainCounts":null,"leakage":null,"modelJudgeDomainCounts":null,'
    || '"primaryPreferenceEvidence":null,"promotable":' || (n % 2 = 0) || ',"protocol":"dataset-identity-v2","schemaVersion":1,"sourceReceipts":[{"bytes":' || bytes || ',"sha256":"s","status":"verified"},{"status":"pending"}],'
    || '"splitIdentity":null,"status":"built","trainingFormat":null}') AS identity
FROM (SELECT source, count(*) FILTER (doc_id % 3 > 0) AS train, count(*) FILTER (doc_id % 3 = 0) AS valid, count(*) AS n, string_agg(DISTINCT lang, '","' ORDER BY lang) AS langs, sum(strlen(text))::BIGINT AS bytes
    FROM documents GROUP BY source)
""",
)
def _identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset for each source; when and where it was built does not tell it from another."""
    per = table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count_if(F.col("doc_id") % 3 > 0).alias("train"), F.count_if(F.col("doc_id") % 3 == 0).alias("valid"), F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_set("lang")).alias("langs"), F.sum(F.octet_length("text")).cast("bigint").alias("bytes"),
    )
    verified = F.struct(F.lit("verified").alias("status"), F.col("bytes"), F.lit("s").alias("sha256"), F.concat(F.lit("/tmp/"), "source").alias("path"))
    pending = F.struct(F.lit("pending").alias("status"), F.lit(None).cast("bigint").alias("bytes"), F.lit("x").alias("sha256"), F.lit("/tmp").alias("path"))
    manifest = F.struct(
        F.struct("train", "valid").alias("counts"), F.struct(F.col("n").alias("entries"), F.lit("/tmp/map").alias("path")).alias("domainMap"), F.col("langs").alias("domains"),
        F.array(F.struct("bytes", F.concat("source", F.lit(".jsonl")).alias("path"))).alias("files"), (F.col("n") % 2 == 0).alias("promotable"), F.lit(1).alias("schemaVersion"),
        F.lit("built").alias("status"), F.array(verified, pending).alias("sourceReceipts"), F.current_timestamp().cast("string").alias("builtAt"),
    )
    return per.select("source", hashing.dataset_identities(F.to_json(manifest)).alias("identity"))


@query(
    "report_subset",
    """
SELECT doc_id, '{' || concat_ws(',', CASE WHEN doc_id % 4 > 0 THEN '"adapter":{"id":"a' || doc_id || '","scale":null}' END, '"issueCount":' || n_chars,
    CASE WHEN doc_id % 3 > 0 THEN '"passRate":' || CASE doc_id % 3 WHEN 1 THEN '0.5' ELSE '0.125' END END, '"variant":"' || lang || '"') || '}' AS summary
FROM documents
""",
)
def _subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some fields of a report, without those that are null or absent."""
    k = F.col("doc_id")
    report = F.concat(
        F.lit('{"variant":"'), "lang", F.lit('","passRate":'), F.when(k % 3 == 1, "0.5").when(k % 3 == 2, "0.125").otherwise("null"), F.lit(',"secret":"x","results":[1,2],"issueCount":'), F.col("n_chars").cast("string"),
        F.when(k % 4 > 0, F.concat(F.lit(',"adapter":{"id":"a'), k.cast("string"), F.lit('","scale":null}'))).otherwise(""), F.lit("}"),
    )
    keys = ("variant", "passRate", "issueCount", "adapter", "scale")
    return table(spark, sf_dir, "documents").select("doc_id", J.subset(report, keys).alias("summary"))


@query(
    "distinct_in_order",
    """
SELECT conv_id, string_agg(w, ' ' ORDER BY spot) AS words FROM (
    SELECT conv_id, w, min((turn, i)) AS spot FROM (SELECT conv_id, turn, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT conv_id, turn, string_split(lower(text), ' ') AS ws FROM conversations))
    GROUP BY conv_id, w) GROUP BY conv_id
""",
)
def _in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of a conversation, each where it is first said."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("m"))
    said = F.flatten(F.transform("m", lambda t: F.split(F.lower(t["text"]), " ")))
    return turns.select("conv_id", F.array_join(X.distinct_in_order(said), " ").alias("words"))
