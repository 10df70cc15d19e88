"""The workflow from seeds to a comparison, with stand-in models."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from prefmill.operators import contracts, flows
from prefmill.sources import seeds


@pytest.fixture(scope="module")
def tasks(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("seeds") / "rows")
    seeds.seed_rows(spark).write.parquet(path)
    return spark.read.parquet(path)


def test_seed_rows(tasks):
    assert tasks.count() == 256 and tasks.select("id").distinct().count() == 256
    rows = {r["id"]: json.loads(r["oracle"]) for r in tasks.collect()}
    o = rows["train-prerequisite-reasoning-001"]
    assert (o["eligible"], o["missingImmediate"], o["recommendedSequence"]) == (False, ["ALD 140", "ALD 150"], ["ALD 140", "ALD 150"])
    o = rows["train-prerequisite-reasoning-002"]
    assert o["recommendedSequence"] == ["ALD 140", "ALD 150", "ALD 160"]
    assert o["requiredCitations"] == ["ALD 140", "ALD 150", "ALD 160", "ALD 170"]
    assert rows["train-prerequisite-reasoning-003"]["eligible"] is True
    o = rows["validation-schedule-constraints-000"]
    assert (o["sectionIds"], o["totalCredits"]) == (["BRI 201-A", "BRI 301-B", "BRI 401-A"], 10)
    o = rows["heldout-degree-audit-001"]
    assert o["remainingByGroup"] == {"capstone": 1, "methods": 0, "writing": 0} and o["eligibleOptions"]["methods"] == ["DUNM 204"]
    assert rows["train-tutoring-009"]["answerContains"] == "5"
    assert rows["heldout-lesson-kernel-002"]["lessonId"] == "dun-algorithmic-complexity-2"


def solve(messages, seed):
    """Answers schedule tasks rightly and everything else with an empty object."""
    text = messages[-1]["content"]
    if not text.startswith("SECTIONS"):
        return "{}"
    ids = sorted(s["section"] for s in json.loads(text.split("\n")[0].removeprefix("SECTIONS: ")))
    pick = [ids[0], ids[3], ids[4]]
    return json.dumps({"feasible": True, "sectionIds": pick, "totalCredits": 10, "conflicts": [], "explanation": "No two of these sections overlap.", "citations": pick})


def agree(messages, seed):
    pair = json.loads(messages[-1]["content"])
    a = pair["candidateA"]["totalCredits"] == 10
    return json.dumps({"preferred": "A" if a else "B", "preferredScore": 5, "groundingPass": True, "pedagogyPass": True, "issues": []})


def test_teacher_to_manifest(spark, tasks, tmp_path):
    some = tasks.where(F.col("category").isin("schedule-constraints", "tool-use"))
    flows.teacher(some, "train", solve).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert {(r["category"], r["status"]): r["count"] for r in rows.groupBy("category", "status").count().collect()} == {
        ("schedule-constraints", "admitted"): 20, ("tool-use", "excluded"): 20,
    }
    calls = lambda messages, seed: 1 / 0  # noqa: E731  nothing is left to ask
    assert flows.teacher(some, "train", calls, prior=rows).count() == 40
    flows.critic(rows, agree).write.parquet(str(tmp_path / "c"))
    evidence = spark.read.parquet(str(tmp_path / "c"))
    assert {r["status"] for r in evidence.collect()} == {"critic-admitted"}
    pairs = flows.preference_corpus(rows, evidence)
    parts = flows.manifest(pairs)
    assert [tuple(r) for r in parts["splits"].collect()] == [("train", 20, 1, 4)]
    assert parts["leakage"].count() == 0 and parts["gate"].count() > 0


def test_resumed_runs_ask_with_the_seeds_of_a_fresh_one(spark, tasks, tmp_path):
    """Places are told among all tasks, done ones included."""
    some = tasks.where("category IN ('schedule-constraints', 'safe-education') AND split = 'validation'")
    refuse = lambda messages, settings: "{}"
    seeds_of = lambda rows: {r["id"]: json.loads(r["settings"])["seed"] for r in rows.collect()}
    fresh = flows.teacher(some, "validation", refuse, most=1)
    assert seeds_of(fresh) == {i: 16031 + 7 * k for k, i in enumerate(sorted(r["id"] for r in some.collect()))}
    fresh.where("id >= 'validation-safe-education-002' AND id < 'validation-schedule-constraints-003'").write.parquet(str(tmp_path / "prior"))
    again = flows.teacher(some, "validation", refuse, prior=spark.read.parquet(str(tmp_path / "prior")), most=1)
    assert seeds_of(again) == seeds_of(fresh)
    flows.teacher(some, "validation", solve).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    judged = flows.critic(rows, agree)
    judged.where("id <> 'validation-schedule-constraints-003'").write.parquet(str(tmp_path / "c"))
    more = flows.critic(rows, agree, prior=spark.read.parquet(str(tmp_path / "c")))
    assert seeds_of(more) == seeds_of(judged) and len(seeds_of(more)) == 4
    limited = flows.teacher(some, "validation", refuse, limit=3, most=1)
    assert seeds_of(limited) == {"validation-safe-education-000": 16031, "validation-schedule-constraints-000": 16038, "validation-safe-education-001": 16045}


def test_retries_budgets_and_receipts(spark, tasks):
    """The teacher is told its issues twice; the critic repairs its answer; settings and metrics are recorded."""
    some = tasks.where("id IN ('train-schedule-constraints-000', 'train-schedule-constraints-001')")

    def late(messages, settings):
        told = [m["content"] for m in messages if m["role"] == "user"]
        tries = settings["seed"] - 16031 - (0 if settings["seed"] - 16031 < 7 else 7)
        text = solve(messages[:2], settings) if tries == 2 else "{}"
        assert len(messages) == (2 if tries == 0 else 4) and ("missing-key:feasible" in told[-1]) == (tries > 0)
        return {"text": text, "metrics": {"generation_tokens": 10, "tokens_per_second": 2.0}, "receipt": {"model": "m"}}

    rows = flows.teacher(some, "train", late)
    got = rows.collect()
    assert [(r["status"], r["attempts"], r["metrics"]["generation_tokens"], r["receipt"]) for r in got] == [("admitted", 3, 10, '{"model": "m"}')] * 2
    assert {json.loads(r["settings"])["max_tokens"] for r in got} == {700} and {json.loads(r["settings"])["temperature"] for r in got} == {0.15}
    assert {r["status"] for r in flows.teacher(some, "train", late, most=2).collect()} == {"excluded"}

    def repaired(messages, settings):
        pair = json.loads(messages[1]["content"])
        assert sorted(pair) == ["candidateA", "candidateB", "contract", "taskMessages"] and settings["max_tokens"] == 256
        return "prefer A" if settings["seed"] < 100_000 else agree(messages[:2], settings) + " done"

    seen = flows.critic(rows, repaired).collect()
    assert [(r["status"], r["valid_shapes"], r["seq"]) for r in seen] == [("critic-admitted", [False, True], 1)] * 2
    wrong = lambda m, s: agree(m, s).replace('"A"', '"x"').replace('"B"', '"A"').replace('"x"', '"B"')
    assert [(r["status"], r["valid_shapes"]) for r in flows.critic(rows, wrong).collect()] == [("critic-rejected", [True])] * 2


def test_evaluation(tasks):
    held = tasks.where("category IN ('schedule-constraints', 'safe-education')")
    parts = flows.report(flows.evaluation(held, "heldout", solve))
    assert tuple(parts["overall"].first())[:3] == (8, 4, 0.5)
    assert contracts.FIELDS


def test_seed_files_and_manifest(spark, tmp_path):
    import hashlib

    m = seeds.write(spark, str(tmp_path / "out"))
    assert m["counts"] == {"train": 160, "validation": 32, "preference-test": 32, "heldout": 32} and len(m["categories"]) == 8
    assert spark.read.text(str(tmp_path / "out" / "heldout.jsonl")).count() == 32
    for f in m["files"]:
        data = b"".join(p.read_bytes() for p in sorted((tmp_path / "out" / f["path"]).glob("part-*")))
        assert (f["bytes"], f["sha256"], f["rows"]) == (len(data), hashlib.sha256(data).hexdigest(), m["counts"][f["path"].split(".")[0].replace("preference_", "preference-")])
        ids = [json.loads(x)["id"] for x in data.decode().splitlines()]
        assert ids == sorted(ids)
    again = seeds.write(spark, str(tmp_path / "again"), parts=3)
    assert again["identitySha256"] == m["identitySha256"]
    other = seeds.write(spark, str(tmp_path / "other"), seeds.plan_of(spark.range(3, 12), "id"))
    assert other["counts"] == {"train": 48, "validation": 8, "preference-test": 8, "heldout": 8} and other["identitySha256"] != m["identitySha256"]
