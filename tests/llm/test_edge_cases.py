"""Nulls, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import pytest

from prefmill.llm import decontaminate, doc_fingerprints, licenses, maxent_lm, mixing, quality, sharding, simhash_dedup, substring_dedup, token_counts


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1), (7, 0), (9, 0), (None, 1), (-3, None), (5, 1)], "doc_id bigint, quality int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (None, "another text with this key"), (3, "x" * 100)], "item_id bigint, text string")


def reports(labels, benchmark):
    return {
        "mixing": mixing.report,
        "lm": maxent_lm.report,
        "simhash": simhash_dedup.report,
        "quality": lambda d: quality.report(d, labels),
        "fingerprints": doc_fingerprints.report,
        "substrings": substring_dedup.report,
        "licenses": licenses.scan,
        "sharding": lambda d: sharding.assign(d, keep=False),
    }


NAMES = ["mixing", "lm", "simhash", "quality", "fingerprints", "substrings", "licenses", "sharding"]


@pytest.mark.parametrize("name", NAMES)
def test_a_row_for_each_row(odd, labels, benchmark, name):
    rows = reports(labels, benchmark)[name](odd).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(["None", "None", "5", "5", "5", "7", "9", "-3"])


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(none, labels, benchmark, name):
    assert reports(labels, benchmark)[name](none).count() == 0


def test_empty_table_of_lengths_and_matches(none, benchmark):
    t = token_counts.context_table(token_counts.histogram(token_counts.token_lengths(none)), [5])
    assert [tuple(r) for r in t.select("context_limit", "docs_within", "truncated_total", "quantile").collect()] == [(5, 0, 0, None)]
    assert decontaminate.matches(none, benchmark).count() == 0


def test_odd_matches(odd, benchmark):
    got = sorted((str(r["doc_id"]), str(r["item_id"]), r["distance"]) for r in decontaminate.matches(odd, benchmark).collect())
    assert got == [("5", "None", 0), ("9", "3", 0)]
    assert decontaminate.matches(odd, benchmark.where("item_id = 77")).count() == 0


def test_stages_keep_columns(odd, labels, benchmark):
    kept = {
        "quality": quality.keep_good(odd, labels),
        "simhash": simhash_dedup.keep_first(odd),
        "clean": decontaminate.keep_clean(odd, benchmark),
        "mixed": mixing.keep_mixed(odd, 0.9),
    }
    for name, frame in kept.items():
        assert frame.columns == odd.columns and frame.count() <= 8, name
        assert {v for r in frame.select(*odd.columns[5:]).collect() for v in r} == {"clash"}, name
    assert kept["clean"].count() == 6
    ids = sorted(str(r["doc_id"]) for r in kept["simhash"].collect())
    assert ids.count("5") == 2 and ids.count("None") == 1  # the null text equals the empty one of 7
    out = sharding.assign(odd)
    mine = {"size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    assert set(out.columns) == {*odd.columns, *mine} and len(out.columns) == len(set(out.columns)) and out.count() == 8


def test_nothing_to_learn_from(spark, odd, small):
    no = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.report(odd, no).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.report(small, one).collect()} == {1.0}
    few = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 1)], "doc_id bigint, quality int")
    assert all(0 <= r["score"] <= 1 for r in quality.report(small, few).collect())
    held = small.where(maxent_lm.held_out("doc_id", 10))
    assert {(r["base_score"], r["score"], r["train_tokens"]) for r in maxent_lm.report(held).collect()} == {(0.0, 0.0, 0)}
