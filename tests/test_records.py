"""File records: hashes that are streamed, and what is no regular nonempty file."""

from __future__ import annotations

import hashlib
import os

import pytest

from prefmill.operators import corpus
from prefmill.sources import files, records


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "root"
    (root / "deep" / "er").mkdir(parents=True)
    held = {"a.bin": bytes(range(256)) * 9000, "deep/b.jsonl": b'{"a": 1}\n\n  \n{"b": "\xc3\xa9"}', "deep/er/c": b"\xef\xbb\xbf\r\n\x00", "z.gz": b"\x1f\x8b not really"}
    for name, data in held.items():
        (root / name).write_bytes(data)
    return root, held


def test_records_equal_the_files(spark, tree, monkeypatch):
    root, held = tree
    want = {n: (len(d), sha(d)) for n, d in held.items()}
    got = {r["path"]: (r["bytes"], r["sha256"]) for r in files.inventory(spark, str(root)).collect()}
    assert got == want
    assert {r["path"]: (r["bytes"], r["sha256"]) for r in files.inventory(spark, f"file://{root}").collect()} == want
    lines = {r["path"]: r["lines"] for r in records.file_records(spark, str(root)).collect()}
    assert lines["deep/b.jsonl"] == 2 and lines["deep/er/c"] == 2
    assert {r["path"] for r in files.inventory(spark, str(root), "*.jsonl").collect()} == {"deep/b.jsonl"}
    # the chunks of a file do not show, nor how files are dealt to tasks
    monkeypatch.setattr(records, "CHUNK", 7)
    assert records.digest(records.Local(str(root)), ["deep/b.jsonl"]) == (len(held["deep/b.jsonl"]), sha(held["deep/b.jsonl"]), 2)
    reader = records.FileRecordReader({"path": str(root)})
    assert len(reader.partitions()) == 1
    monkeypatch.setattr(records, "GROUP", 100)
    assert sorted(f[0] for g in reader.partitions() for f in g.files) == sorted(held) and len(reader.partitions()) == 2


def test_what_is_no_regular_nonempty_file(spark, tree, tmp_path):
    root, _ = tree
    (tmp_path / "outside").write_bytes(b"secret")
    (root / "none").write_bytes(b"")
    os.symlink(root / "a.bin", root / "inner")
    os.symlink(tmp_path / "outside", root / "outer")
    os.symlink(tmp_path, root / "up")
    os.mkfifo(root / "pipe")
    got = {r["path"]: r["issue"] for r in records.file_records(spark, str(root), strict=False).collect()}
    assert {k: v for k, v in got.items() if v} == {"none": "empty", "inner": "symlink", "outer": "escape", "up": "escape", "pipe": "irregular"}
    names = ["a.bin", "../outside", str(root / "a.bin"), "deep", "not there", "deep/../a.bin"]
    got = {r["path"]: r["issue"] for r in records.file_records(spark, str(root), names=names, strict=False).collect()}
    assert got == {"a.bin": None, "../outside": "escape", str(root / "a.bin"): "escape", "deep": "irregular", "not there": "missing", "deep/../a.bin": None}
    for name, issue in (("none", "empty"), ("inner", "symlink"), ("../outside", "escape"), ("not there", "missing")):
        with pytest.raises(Exception, match=f"{name}: {issue}"):
            records.file_records(spark, str(root), names=["a.bin", name]).collect()
    with pytest.raises(Exception, match="inner: symlink, none: empty, outer: escape"):
        files.inventory(spark, str(root)).collect()


def test_dataset_splits(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "concat('{\"id\": ', id, '}') AS value")
    for split, name in corpus.SPLIT_FILE.items():
        rows.where(f"id % 3 = {corpus.SPLITS.index(split)}").repartitionByRange(3, "id").sortWithinPartitions("id").select("value").write.text(str(tmp_path / name))
    want = {s: "".join(f'{{"id": {i}}}\n' for i in range(k, 1000, 3)).encode() for k, s in enumerate(corpus.SPLITS)}
    got = {r["split"]: (r["path"], r["bytes"], r["sha256"], r["rows"]) for r in records.split_records(spark, str(tmp_path), corpus.SPLIT_FILE).collect()}
    assert got == {s: (corpus.SPLIT_FILE[s], len(d), sha(d), d.count(b"\n")) for s, d in want.items()}
    # plain files as well
    (tmp_path / "one.jsonl").write_bytes(want["train"])
    one = records.split_records(spark, str(tmp_path), {"train": "one.jsonl"}).first()
    assert (one["bytes"], one["sha256"]) == (len(want["train"]), sha(want["train"]))
    (tmp_path / "blank.jsonl").write_bytes(b"\n  \n\t\n")
    with pytest.raises(Exception, match="missing nonempty split: blank.jsonl"):
        records.split_records(spark, str(tmp_path), {"train": "one.jsonl", "test": "blank.jsonl"}).collect()
    with pytest.raises(Exception, match="gone.jsonl: missing"):
        records.split_records(spark, str(tmp_path), {"train": "one.jsonl", "test": "gone.jsonl"}).collect()
    (tmp_path / "hollow").mkdir()
    (tmp_path / "hollow" / "part-0").write_bytes(b"")
    with pytest.raises(Exception, match="hollow: empty"):
        records.split_records(spark, str(tmp_path), {"test": "hollow"}).collect()
