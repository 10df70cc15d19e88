"""The pipeline against its stages' decisions in plain Python, and the registered queries."""

from __future__ import annotations

import corpus_pipeline
from prefmill.llm import decontaminate, queries, quality
from test_brute_force import groups
from test_whole_jobs import jaccard


def test_stages_and_run(spark, sf):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels, bench = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    good = {r["doc_id"] for r in quality.report(frame, labels).collect() if r["score"] >= 0.3}
    named = groups({k: docs[k]["text"] for k in good}, lambda a, b: jaccard(docs[a]["text"], docs[b]["text"]) >= 0.8)
    first = set(named.values())
    part = lambda ks: frame.where(frame["doc_id"].isin([int(k) for k in ks]))
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, part(good), sf).collect()} == first
    dirty = {r["doc_id"] for r in decontaminate.matches(part(first), bench).collect()}
    items = [decontaminate.normalise(r["text"]) for r in bench.collect()]
    assert {k for k in first if any(i in decontaminate.normalise(docs[k]["text"]) for i in items)} <= dirty
    clean = first - dirty
    assert {r["doc_id"] for r in corpus_pipeline.decontamination_stage(spark, part(first), sf).collect()} == clean
    mixed = {r["doc_id"] for r in corpus_pipeline.mixing_stage(spark, part(clean), sf).collect()}
    out = corpus_pipeline.run(spark, sf).collect()
    ids = {r["doc_id"] for r in out}
    assert len(ids) == len(out) and ids == mixed <= clean
    n = lambda ks: sum(len(docs[k]["text"].encode().split()) for k in ks)
    assert 0.75 * n(clean) < n(ids) <= 0.9 * n(clean) + 1
    assert all(r["text"] == docs[r["doc_id"]]["text"] and 0 <= r["shard"] < 40 for r in out)


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_all_are_registered(spark, sf):
    numbers = sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_sql_of_the_license_scan(spark, sf, duck):
    from helpers import same_rows

    same_rows(queries.QUERIES["op7_license_scans"](spark, sf), queries.ORACLES["op7_license_scans"], duck)
