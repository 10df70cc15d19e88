"""Operators on small literal tables."""

import json

import pytest
from pyspark.sql import functions as F

from prefmill.operators import admission, audit, contracts, corpus, evaluate, generate, lessons, receipts, schemas
from prefmill.sources import files, jsonl, registry, seeds


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def issues(spark, contract, answer, oracle):
    t = spark.createDataFrame([(contract, json.dumps(answer) if not isinstance(answer, str) else answer, json.dumps(oracle))], "contract string, answer string, oracle string")
    return contracts.validate(t, only=(contract,)).first()["issues"]


CITED = {"requiredCitations": ["s"], "allowedCitations": ["s", "t"]}


def test_tool_contract(spark):
    oracle = {"tool": "catalog.lookup", "courseCodes": ["A 1"], "term": "spring", "answerDeferred": True}
    good = {"tool": "catalog.lookup", "arguments": {"courseCodes": ["A 1"], "term": "spring"}, "reason": "The catalog is needed first.", "answerDeferred": True}
    assert issues(spark, "tool-call-json-v1", good, oracle) == []
    assert issues(spark, "tool-call-json-v1", {**good, "answerDeferred": False}, oracle) == ["answer-not-deferred"]
    assert issues(spark, "tool-call-json-v1", {**good, "arguments": []}, oracle) == ["arguments-not-object"]
    assert issues(spark, "other", good, oracle) == ["unknown-contract"]


def test_uncertainty_and_citations(spark):
    oracle = {"answer": "insufficient_information", "neededContains": "the list", **CITED}
    good = {"answer": "insufficient_information", "known": ["x"], "needed": ["The List"], "nextAction": "Ask the registrar now.", "citations": ["s"]}
    assert issues(spark, "uncertainty-json-v1", good, oracle) == []
    assert issues(spark, "uncertainty-json-v1", {**good, "citations": ["invented-source"]}, oracle) == ["hallucinated-citation", "missing-required-citation"]
    assert issues(spark, "uncertainty-json-v1", {**good, "known": [], "needed": "no"}, oracle) == ["known-not-list", "missing-information-not-identified"]


def test_schedule_numbers_and_keys(spark):
    oracle = {"feasible": True, "sectionIds": ["a"], "totalCredits": 10, **CITED}
    good = {"feasible": True, "sectionIds": ["a"], "totalCredits": 10.0, "conflicts": [], "explanation": "All sections fit in the week.", "citations": ["s"]}
    assert issues(spark, "schedule-json-v1", good, oracle) == []
    assert issues(spark, "schedule-json-v1", {**good, "conflicts": None, "x": 1}, oracle) == ["extra-key:x", "unexpected-conflicts"]


def test_tutor_and_safety(spark):
    oracle = {"minimumLengths": {"diagnosis": 5, "hint": 5, "workedExplanation": 5, "checkQuestion": 5}, "answerContains": "7/12", **CITED}
    good = {"diagnosis": "adds both", "hint": "try thirds", "workedExplanation": "it is 7/12 then", "checkQuestion": "and 1/2?", "checkAnswer": "x", "citations": ["s"]}
    assert issues(spark, "tutor-json-v1", good, oracle) == []
    assert issues(spark, "tutor-json-v1", {**good, "workedExplanation": "no", "checkAnswer": ""}, oracle) == ["expected-answer-absent", "short-text:checkAnswer", "short-text:workedExplanation"]
    safe = {"boundary": "b", "cannotDo": "I cannot write this for you.", "canHelpWith": ["outline your own plan", "check your sources"], "nextStep": "Share your draft with me."}
    assert issues(spark, "safety-json-v1", safe, {"boundary": "b", "alternativeCount": 2}) == []
    assert issues(spark, "safety-json-v1", {**safe, "canHelpWith": ["x", "outline your own plan"]}, {"boundary": "c", "alternativeCount": 2}) == ["weak-alternative", "wrong-boundary"]


def lesson():
    term = {"tr": "stock", "df": "What has been accumulated so far.", "eg": "water in a tub", "mi": "a stock is a flow", "cx": "a flow changes a stock over time"}
    item = {"q": "Which one is a stock?", "op": ["tub", "tap", "drain", "pipe"], "ai": 0, "ex": "Only the tub accumulates water.", "fi": [0, 4]}
    return {
        "lessonId": "ald-x-0",
        "facts": [f"Fact number {i} is long enough to be one." for i in range(5)],
        "keyTerms": [term] * 3,
        "scenario": {"su": "A town must decide how to size its water tank.", "ma": "two charts of daily use"},
        "discussionPrompt": {"pr": "Which delay matters most here?", "tn": "Speed against stability.", "po": ["a", "b", "c"]},
        "assignmentCore": {"td": "Draw the causal loop of the tank and mark every delay in it.", "pa": ["a", "b", "c", "d"]},
        "mc": [item] * 4,
        "studyGuide": {"sm": "Stocks accumulate what flows bring; delays make corrections overshoot the target.", "rs": "Redraw the loop from memory twice."},
    }


def test_lesson(spark):
    oracle = {"lessonId": "ald-x-0", "facts": lesson()["facts"]}
    assert issues(spark, "lesson-kernel-json-v1", {"lessons": [lesson()]}, oracle) == []
    bad = lesson()
    bad["facts"] = bad["facts"][:4]
    bad["keyTerms"] = [{**bad["keyTerms"][0], "cx": bad["keyTerms"][0]["mi"]}, "no", bad["keyTerms"][2]]
    bad["mc"] = [{**bad["mc"][0], "ai": True, "op": ["a", "A", "b", "c"]}] + bad["mc"][1:]
    bad["studyGuide"] = {"sm": "This lesson is short", "rs": "x"}
    got = issues(spark, "lesson-kernel-json-v1", {"lessons": [bad]}, oracle)
    want = {
        "facts-count", "source-facts-changed", "key-term-0:key-term-cx", "key-term-0:key-term-mi-equals-cx", "key-term-1:key-term-not-object",
        "mc-0:mc-options-duplicate", "mc-0:mc-answer-index", *[f"mc-{i}:mc-fact-index-invalid" for i in range(4)],
        "study-guide-summary", "study-guide-strategy", "meta-language:this-lesson",
    }
    assert set(got) == want
    assert set(issues(spark, "lesson-kernel-json-v1", {"lessons": []}, oracle)) == {"lessons-count", "wrong-lesson-id", "source-facts-changed"}


def test_response_kinds(spark):
    body = json.dumps({"mcItems": lesson()["mc"], "keyTerms": []})
    t = spark.createDataFrame([("source-bundle", body), ("lesson", json.dumps({"lessons": [lesson()]})), ("other", "{}"), ("lesson", "x")], "kind string, text string")
    got = {(r["kind"], r["text"]): (r["issues"], r["score"]) for r in lessons.validate_responses(t).collect()}
    assert got["source-bundle", body] == (["bundle-key-term-count"], 1 - 1 / 12)
    assert got["lesson", json.dumps({"lessons": [lesson()]})] == ([], 1.0)
    assert got["other", "{}"] == (["unknown-response-kind"], 0.0)
    assert got["lesson", "x"] == (["invalid-json"], 0.0)


@pytest.mark.parametrize(
    ("contract", "answer", "oracle"),
    [
        ("prerequisite-json-v1", {"eligible": True}, {"eligible": True, "missingImmediate": [], "recommendedSequence": []}),
        ("schedule-json-v1", {"totalCredits": 10}, {"feasible": True, "sectionIds": [], "totalCredits": 10}),
        ("degree-audit-json-v1", {"remainingByGroup": {"b": 1, "a": 0}}, {"complete": False, "remainingByGroup": {"a": 0, "b": 1}, "eligibleOptions": {}}),
        ("uncertainty-json-v1", {"answer": "insufficient_information"}, {"answer": "insufficient_information", "neededContains": "x"}),
        ("tutor-json-v1", {"citations": ["s"]}, {"minimumLengths": {}, "answerContains": "x", **CITED}),
        ("tool-call-json-v1", {"answerDeferred": True}, {"tool": "t", "courseCodes": [], "term": "x"}),
        ("safety-json-v1", {"canHelpWith": ["a", "b"]}, {"boundary": "b", "alternativeCount": 2}),
        ("lesson-kernel-json-v1", {"lessons": [lesson()]}, {"lessonId": "ald-x-0", "facts": lesson()["facts"]}),
    ],
)
def test_rejected_edits(spark, contract, answer, oracle):
    t = spark.createDataFrame([(contract, json.dumps(answer), json.dumps(oracle))], "contract string, answer string, oracle string")
    r = contracts.construct_rejected(t, only=(contract,)).first()
    changed = json.loads(r["rejected"])
    assert changed != answer and set(changed) == set(answer) and r["rejected_issues"]
    if contract.startswith("degree"):
        assert changed["remainingByGroup"] == {"a": 1, "b": 1}


def test_resume_is_sticky_and_hash_keyed(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "id string, hash string")
    old = spark.createDataFrame([("a", "1", "excluded"), ("b", "x", "admitted"), ("d", "4", "admitted")], "id string, hash string, status string")
    kept = admission.retained(old, now)
    assert rows(kept) == [("a", "1", "excluded")]
    assert rows(admission.pending(now, kept).select("id")) == [("b",), ("c",)]
    assert rows(admission.retained(old, now, usable=F.col("status") != "excluded")) == []


@pytest.mark.parametrize("few", [1 << 18, 3])
def test_ranks_of_any_numbers(spark, monkeypatch, few):
    """Nearest ranks of doubles and whole numbers over many magnitudes, ties, nulls, and a group without a name."""
    import math
    import random

    monkeypatch.setattr(audit, "SORTED", few)
    monkeypatch.setattr(audit, "BITS", 16 if few > 3 else 5)
    r = random.Random(5)
    spread = lambda: r.choice([r.gauss(0, 1), 10.0 ** r.randrange(-300, 300), -(10.0 ** r.randrange(-300, 300)), 0.0, -0.0, 7.5, float("inf"), 5e-324])
    rows = [("a", spread()) for _ in range(400)] + [("b", 1.5)] * 90 + [("b", 2.5)] * 10 + [(None, float(i)) for i in range(7)] + [("c", None), ("d", -3.0), ("a", None)]
    shares = {"p0": 0.0, "p01": 0.001, "p50": 0.5, "p90": 0.9, "p100": 1.0}

    def want(values, share):
        values = sorted(values, key=lambda x: (x, math.copysign(1, x)))
        return values[-1] if share <= 0 else values[max(1, math.ceil(share * len(values))) - 1]

    def expected(of):
        groups = {}
        for g, v in of:
            if v is not None:
                groups.setdefault(g, []).append(v)
        return sorted(str((g, len(vs), *[want(vs, s) for s in shares.values()])) for g, vs in groups.items())

    got = audit.ranks(spark.createDataFrame(rows, "g string, v double").repartition(3), "v", "g", shares)
    assert sorted(str(tuple(x)) for x in got.collect()) == expected(rows)
    whole = [(g, r.choice([-(1 << 63), (1 << 63) - 1, r.randrange(-99, 99), r.randrange(1 << 40)])) for g in "xy" for _ in range(150)]
    got = audit.ranks(spark.createDataFrame(whole, "g string, v bigint"), "v", "g", shares)
    assert sorted(str(tuple(x)) for x in got.collect()) == expected(whole)
    assert audit.ranks(spark.createDataFrame([], "g string, v int"), "v", "g", shares).count() == 0
    with pytest.raises(ValueError, match="no ranks over string"):
        audit.ranks(spark.createDataFrame([("a", "b")], "g string, v string"), "v", "g", shares)


def test_stratified_limit_takes_rounds(spark):
    t = spark.createDataFrame([(i, c) for i, c in enumerate("aaaabbc")], "ord int, category string")
    assert [r["category"] for r in admission.stratified_limit(t, 5).collect()] == ["a", "b", "c", "a", "b"]
    assert admission.stratified_limit(t, 2).count() == 2 and admission.stratified_limit(t, 99).count() == 7


def test_positions_over_partitions(spark):
    t = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    got = admission.positions(t, "k")
    assert got.where("pos <> k").count() == 0 and got.count() == 1000


@pytest.mark.parametrize("parts", ["1", "3", "8"])
def test_positions_of_wide_rows(spark, parts):
    """A permutation, in order, whatever columns the rows have and whichever of them are used."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        n = 200_000
        wide = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.repeat(F.lit("x"), F.col("id").cast("int") % 90).alias("a"), F.rand(1).alias("b"), F.lit(1).alias("_row"), F.lit(2).alias("_part"))
        got = admission.positions(wide, "k")
        assert got.columns == [*wide.columns, "pos"]
        assert got.where("pos <> k").count() == 0 and got.select("pos").distinct().count() == n
        # one key with a third of all rows, rows repeated as they are, keys in two columns
        hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 100).alias("k"), (F.col("id") % 7).alias("j"))
        got = admission.positions(hot, ["k", "j"]).cache()
        assert got.select("pos").distinct().count() == 30_000 and got.agg(F.max("pos")).first()[0] == 29_999
        pairs = [(r["k"], r["j"]) for r in got.orderBy("pos").collect()]
        assert pairs == sorted(pairs)
        got.unpersist()
        assert admission.positions(hot.where("k < 0"), "k").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("n", [1, 2, 20, 21])
def test_percentile_is_nearest_rank(spark, n):
    import math

    t = spark.range(n).select(F.lit("x").alias("g"), (F.col("id") * 3).alias("v"))
    r = audit.length_summary(t, "v", "g").first()
    assert r["median_len"] == 3 * (math.ceil(n * 0.5) - 1) and r["p95_len"] == 3 * (math.ceil(n * 0.95) - 1)


def test_shared_prompt_drift(spark):
    turns = "array<struct<role:string,content:string>>"
    a = [("user", "q"), ("assistant", "x")]
    t = spark.createDataFrame([(a, [("user", "q"), ("assistant", "y")]), (a, [("user", "z"), ("assistant", "y")]), (a, a[:1]), (None, a)], f"c {turns}, r {turns}")
    assert [r["x"] for r in t.select(audit.shared_prompt(F.col("c"), F.col("r")).alias("x")).collect()] == [True, False, False, False]


def test_provenance_and_leakage(spark):
    t = spark.createDataFrame([("train-tutoring-007", "tutoring", "train"), ("v-tutoring-7", "tutoring", "validation"), ("x", "tutoring", "train")], "id string, category string, split string")
    got = {r["id"]: (r["domain"], r["corpus_split"], r["group_id"]) for r in corpus.provenance(t).collect()}
    assert got["train-tutoring-007"] == ("education-pedagogy", "train", "pref-train-tutoring-3")
    assert got["v-tutoring-7"][2] == "pref-valid-tutoring-3" and got["x"][2] is None
    s = spark.createDataFrame([("train", "g"), ("valid", "g"), ("test", "g"), ("train", "h"), ("train", "h")], "split string, group_id string")
    assert rows(corpus.leakage(s)) == [("train", "test", "g"), ("train", "valid", "g"), ("valid", "test", "g")]


def gate_rows(spark, n):
    names = ["course-planning", "academic-operations", "education-pedagogy", "responsible-guidance"]
    data = [(s, d, f"{s}-{d}-{i % 8}") for d in names for s, k in (("train", 40), ("valid", 8), ("test", 8)) for i in range(k)]
    return spark.createDataFrame(data[:n], "split string, domain string, group_id string")


def test_gates(spark):
    t = gate_rows(spark, 224)
    assert [r["issue"] for r in corpus.gate_issues(t, corpus.PRODUCTION).collect()] == ["verified-pairs:224<3000", "domains:4<5", "single-model-judge-qualified-domains:4<5"]
    assert corpus.gate_issues(t, corpus.RESEARCH).count() == 0
    none = [r["issue"] for r in corpus.gate_issues(gate_rows(spark, 0), corpus.RESEARCH).collect()]
    assert none == ["verified-pairs:0<100", "domains:0<4", "single-model-judge-pairs:0<100", "single-model-judge-qualified-domains:0<4", "train-empty", "valid-empty", "test-empty"]


def result_rows(spark, bad):
    data = [(i, "safety" if i % 2 else "tutoring", ["x"] * bad.get(i, 0)) for i in range(32)]
    return spark.createDataFrame(data, "id int, category string, issues array<string>")


def test_promotion(spark):
    base, better = result_rows(spark, {i: 2 for i in range(10)}), result_rows(spark, {i: 1 for i in range(4)})
    assert evaluate.promotion(base, better).first()["status"] == "pass"
    r = evaluate.promotion(base, result_rows(spark, {1: 1, 3: 1, 5: 1, 7: 1, 9: 1, 11: 1})).first()
    assert (r["status"], r["no_regression"], r["pass_rate_up"]) == ("fail", False, True)
    empty = base.where("id < 0")
    assert tuple(evaluate.summarize_overall(empty).first()) == (0, 0, 0.0, 0)


def test_generator_boundary(spark):
    t = spark.createDataFrame([("a", [("user", "q")], 1), ("b", [("user", "r")], 2)], "id string, messages array<struct<role:string,content:string>>, seed int")
    check = lambda text: [] if '"seed": 3' in text else ["wrong-seed"]
    log = generate.attempts(t, generate.echo, check)
    assert [(r["id"], r["attempt"], bool(r["issues"])) for r in log.orderBy("id", "attempt").collect()] == [("a", 0, True), ("a", 1, True), ("a", 2, False), ("b", 0, True), ("b", 1, False)]
    first = admission.first_success(log.withColumn("ok", F.size("issues") == 0))
    assert rows(first.select("id", "success_at")) == [("a", 2), ("b", 1)]


def test_receipt_chain(spark):
    plan = {"protocol": "p", "lane": "research", "repository": {"dirty": False}, "base": {"modelId": "m", "revision": "r"}, "dataset": {"manifestSha256": "ms", "identitySha256": "di"},
            "adapter": {"id": "a"}, "identity": {"sha256": "pi"}, "trainer": {"tokenAudit": {"sha256": "as"}}}
    result = {"protocol": "q", "status": "completed", "adapterId": "a", "planSha256": "ps", "planIdentitySha256": "pi",
              "files": [{"path": "adapter_config.json", "bytes": 1, "sha256": "x"}, {"path": "adapters.safetensors", "bytes": 2, "sha256": "y"}]}
    audit_ = {"status": "pass", "files": {s: {"sha256": s[0]} for s in receipts.SPLITS}}
    ddl = ("run string, plan string, result string, audit string, dataset string, plan_sha string, audit_sha string, manifest_sha string, model_id string, revision string, "
           "split_sha map<string,string>, files map<string,struct<bytes:bigint,sha256:string>>")  # fmt: skip

    def row(name, p=plan, r=result, f=None):
        found = {"adapter_config.json": (1, "x"), "adapters.safetensors": (2, "y")} if f is None else f
        return (name, json.dumps(p), json.dumps(r), json.dumps(audit_), json.dumps({"identity": {"sha256": "di"}}), "ps", "as", "ms", "m", "r", {s: s[0] for s in receipts.SPLITS}, found)

    t = spark.createDataFrame([row("good"), row("bad", {**plan, "repository": {"dirty": True}}, {**result, "adapterId": "z"}, {"adapter_config.json": (9, "x")})], ddl)
    got = {r["run"]: r["issues"] for r in receipts.chain_issues(t, {"plan": "p", "result": "q"}).collect()}
    assert got == {"good": [], "bad": ["training-repository-dirty", "training-adapter-id", "training-file-integrity:adapter_config.json", "training-file:adapters.safetensors"]}


def test_schemas_find_what_validators_find(spark):
    """Keys that validators miss or find too many are violations of the contract's schema, and the other way round."""
    from prefmill.plans.answers import CASES

    ids = spark.createDataFrame([(i,) for i in range(40)], "doc_id bigint")
    for contract, (answer, oracle, _) in CASES.items():
        names = contracts.FIELDS[contract]
        rows = ids.select("doc_id", F.lit(contract).alias("contract"), F.expr(answer).alias("text"), F.expr(oracle).alias("oracle"))
        # every third answer loses a field, every fourth has one more
        gone = F.array(*[F.lit(n) for n in names])[(F.col("doc_id") % len(names)).cast("int")]
        fields = F.map_filter(F.try_parse_json("text").try_cast("map<string,variant>"), lambda k, _: (k != gone) | (F.col("doc_id") % 3 > 0))
        more = F.when(F.col("doc_id") % 4 == 0, F.create_map(F.lit("zz"), F.try_parse_json(F.lit("1")))).otherwise(F.map_filter(fields, lambda k, _: F.lit(False)))
        rows = rows.withColumn("answer", F.to_json(F.map_concat(fields, more)))
        rows = schemas.check(contracts.validate(rows, only=(contract,)), schemas.contract_schema(contract))
        for r in rows.collect():
            keys = {i for i in r["issues"] if i.startswith(("missing-key:", "extra-key:"))}
            top = {v.split(":") [1] + "-key:" + v.split(":")[0] for v in r["violations"] if v.endswith((":missing", ":extra")) and "." not in v}
            assert keys == top, (contract, r)
            assert (r["doc_id"] % 3 == 0 or r["doc_id"] % 4 == 0) == bool(keys)


def test_schema_paths_and_types(spark):
    deep = schemas.closed({"a": schemas.many({"type": "object", "additionalProperties": {"type": "integer", "maximum": 5}}), "n": {"type": "number"}}, ("n",))
    rows = [
        ('{"a": [{"x": 1}, {"y": 9, "w": "s", "x": 2}], "n": 1}', ["a[1].w:type", "a[1].y:high"]), ('{"a": []}', []), ('{"a": {}, "n": "1"}', ["a:type", "n:type"]), ("null", [":type"]), ("", [":json"]),
        (None, [":json"]), ('{"a": [[]], "b": 1, "n": 2.5}', ["b:extra", "a[0]:type"]), ('{"a": null}', ["a:type"]),
    ]
    d = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, answer string")
    assert {r["i"]: r["violations"] for r in schemas.check(d, deep).collect()} == {i: v for i, (_, v) in enumerate(rows)}
    assert schemas.ddl(deep) == "struct<`a`:array<map<string,bigint>>,`n`:double>"
    same = schemas.many(schemas.TEXT | {"type": "integer"}, unique=True)
    d = spark.createDataFrame([("[1, 1.0]",), ("[1, 2]",), ("[]",)], "answer string")
    assert [r["violations"] for r in schemas.check(d, {**same, "items": {"type": "number"}}).collect()] == [[":repeated"], [], []]
    read = schemas.typed(spark.createDataFrame([('{"a": [{"x": 1}]}',), ('{"a": 1}',)], "answer string"), deep).collect()
    assert read[0]["value"]["a"] == [{"x": 1}] and read[1]["value"] is None


def test_schemas():
    s = schemas.contract_schema("prerequisite-json-v1")
    assert s["required"] == ["eligible", "missingImmediate", "recommendedSequence", "explanation", "citations"] and s["properties"]["eligible"] == {"type": "boolean"}
    lesson_schema = schemas.contract_schema("lesson-kernel-json-v1")["properties"]["lessons"]["items"]
    assert "workedExample" in lesson_schema["properties"] and "workedExample" not in lesson_schema["required"]
    for bad in ("x", "other"):
        with pytest.raises(ValueError):
            schemas.response_schema(bad)
    assert schemas.response_format("mc-item")["json_schema"]["name"] == "pref_mc_item"


def test_files_round_trip(spark, tmp_path):
    t = spark.createDataFrame([("b", 1), ("a", 2)], "name string, n int")
    jsonl.write(t, str(tmp_path / "out"))
    jsonl.write(t, str(tmp_path / "out"), append=True)
    assert rows(jsonl.read(spark, str(tmp_path / "out"), "name string, n int")) == [("a", 2), ("a", 2), ("b", 1), ("b", 1)]
    (tmp_path / "x.jsonl").write_text('{"a":1}\n\n[1]\n{"a":1} no\n')
    assert sorted(r["issue"] or "" for r in jsonl.scan_strict(spark, str(tmp_path / "x.jsonl")).collect()) == ["", "invalid-json", "root-not-object"]
    found = files.inventory(spark, str(tmp_path), "x.jsonl").first()
    import hashlib

    assert found["bytes"] == 24 and found["sha256"] == hashlib.sha256((tmp_path / "x.jsonl").read_bytes()).hexdigest()
    want = spark.createDataFrame([("a", 1, "x"), ("/b", 1, "x"), ("c/../d", 1, "x"), ("e", 1, "x"), ("e", 1, "x")], "path string, bytes bigint, sha256 string")
    have = spark.createDataFrame([("a", 1, "x")], "path string, bytes bigint, sha256 string")
    assert rows(files.verify(want, have)) == [("/b", "unsafe"), ("a", "ok"), ("c/../d", "unsafe"), ("e", "duplicate")]


def test_registry(spark):
    assert registry.registry(spark).count() == 7
    with pytest.raises(ValueError):
        registry.student(spark, "max")


def test_seed_plan(spark):
    got = {(r["split"], r["category"]): r["n"] for r in seeds.tasks(spark).groupBy("split", "category").agg(F.count("*").alias("n")).collect()}
    assert len(got) == 32 and set(got.values()) == {20, 4}


def test_streaming_resume(spark, tmp_path):
    from prefmill.streaming import resume

    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "1")], "id string, hash string").write.json(src)
    resume.write_new(resume.unseen(resume.attempts(spark, src, "id string, hash string")), out, state).awaitTermination()
    spark.createDataFrame([("a", "1"), ("a", "9")], "id string, hash string").write.mode("append").json(src)
    resume.write_new(resume.unseen(resume.attempts(spark, src, "id string, hash string")), out, state).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("a", "1"), ("a", "9"), ("b", "2")]


def test_canary(spark):
    from prefmill.operators.canary import canary_issues

    t = spark.createDataFrame([('{"eligible":false,"missing":["C 2"],"citations":["C 2","C 3"]}',), ('{"eligible":true,"missing":[],"citations":["C 2"]}',), ("no",)], "a string")
    got = [r["x"] for r in t.select(canary_issues(F.col("a"), ["C 2"], ["C 2", "C 3"]).alias("x")).collect()]
    assert got == [[], ["eligibility", "missing-prerequisite", "catalog-citations"], ["json"]]


def test_tensor_names(spark):
    from prefmill.functions.text import tensor_name

    t = spark.createDataFrame([("m.text.layers.0.q.lora_a",), ("m.text.layers.0.q.lora_b",), ("other.q.lora_a",), ("m.text.a..b.lora_a",), ("m.text.q.bias",)], "n string")
    got = [r["x"] for r in t.select(tensor_name(F.col("n"), "m.text.", "base.").alias("x")).collect()]
    assert got == ["base.layers.0.q.lora_A.weight", "base.layers.0.q.lora_B.weight", None, None, None]


def test_dataset_identity_ignores_times_and_paths():
    from prefmill.functions.hashing import dataset_identity

    m = {"schemaVersion": 1, "counts": {"train": 2}, "sourceReceipts": [{"status": "verified", "bytes": 1, "sha256": "x", "path": "/a"}], "generatedAt": "now"}
    same = {**m, "generatedAt": "later", "sourceReceipts": [{"status": "verified", "bytes": 1, "sha256": "x", "path": "/b"}]}
    assert dataset_identity(m) == dataset_identity(same) != dataset_identity({**m, "counts": {"train": 3}})


def test_command_line(spark, tmp_path, capsys):
    from prefmill.__main__ import main

    out = str(tmp_path / "seeds")
    main(["seed", "--output", out])
    assert spark.read.parquet(out).count() == 256
    main(["models"])
    assert "primary-teacher" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["unknown"])


def test_preconditions_and_labels(spark):
    ddl = ("variant string, adapter_format string, base_name string, pin_name string, base_bytes bigint, pin_bytes bigint, base_sha256 string, pin_sha256 string, "
           "scale double, locked_scale double, tuning boolean, n_tasks int")  # fmt: skip
    good = ("adapter", "f", "b", "b", 1, 1, "s", "s", 10.0, 10.0, False, 3)
    bad = ("other", None, "b", "c", 1, 1, "s", "s", 9.0, 10.0, False, 0)
    got = [r["unmet"] for r in receipts.unmet(spark.createDataFrame([good, bad], ddl)).collect()]
    assert got == [[], ["variant", "adapter-manifest", "base-pin", "scale", "empty-split"]]
    t = spark.createDataFrame([('{"a":"/root/x/y","b":["/root/x"],"c":"/other"}', "lite", "p1"), ("{}", "pro", "p9")], "j string, tier string, protocol string")
    r = t.select(receipts.relative_paths("j", "/root/x").alias("j"), receipts.comparison_label(F.col("tier"), F.col("protocol"), {"p1": "strict"}).alias("l")).collect()
    assert [tuple(x) for x in r] == [('{"a":"y","b":["."],"c":"/other"}', "lite-strict"), ("{}", "pro-evaluation")]


def test_token_counter_and_limits(spark):
    count = audit.token_counter(lambda s: len(s.split()))
    t = spark.createDataFrame([("a b c",), (None,), ("",)], "t string").withColumn("n", count(F.col("t")))
    assert sorted(r["n"] for r in t.collect()) == [0, 0, 3] and audit.over_limit(t, "n", 2).count() == 1
