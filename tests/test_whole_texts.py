"""Registered queries read whole texts."""

from __future__ import annotations

from prefmill.functions.text import META_PHRASES
from prefmill.plans import corpus, tasks

FILL = "words before the phrase " * 20


def _documents(spark, tmp_path):
    rows = [(5 * i + 3, FILL + p.title() + " and more.", "en", "src1", 1) for i, p in enumerate(META_PHRASES)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    return rows


def test_meta_phrases_after_the_first_characters(spark, tmp_path):
    rows = _documents(spark, tmp_path)
    got = {r["doc_id"]: r["codes"] for r in corpus._meta(spark, str(tmp_path)).collect()}
    assert got == {r[0]: "meta-language:" + p.replace(" ", "-") for r, p in zip(rows, META_PHRASES)}


def test_pairs_hold_whole_texts(spark, tmp_path):
    rows = _documents(spark, tmp_path)
    got = {int(r["id"]): r["chosen"][0]["content"] for r in tasks._pairs(spark, str(tmp_path)).collect()}
    assert got == {r[0]: r[1] for r in rows}
