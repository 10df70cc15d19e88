"""Archives: bytes that depend on names and contents alone, members as they were."""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import random
import tarfile

import pytest

from prefmill.sources import archives, files


@pytest.fixture
def package(tmp_path):
    root = tmp_path / "pack-1"
    (root / "deep").mkdir(parents=True)
    r = random.Random(4)
    held = {"manifest.json": b"{}\n", "deep/w.bin": r.randbytes(300_001), "x" * 90 + ".txt": b"a" * 1024, "one": b"\x00"}
    for name, data in held.items():
        (root / name).write_bytes(data)
    return root, held


@pytest.mark.parametrize("piece", [64 << 20, 100_000])
def test_archive_is_a_tar_of_its_members(spark, package, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(archives, "PIECE", piece)
    root, held = package
    names = list(held)
    got = archives.write(spark, str(root), names, str(tmp_path / "a" / "p.tar.gz")).first()
    data = (tmp_path / "a" / "p.tar.gz").read_bytes()
    assert (got["name"], got["bytes"], got["sha256"], got["package"], got["files"]) == ("p.tar.gz", len(data), hashlib.sha256(data).hexdigest(), "pack-1", 4)
    plain = gzip.decompress(data)
    with tarfile.open(fileobj=io.BytesIO(plain)) as tar:
        assert [i.name for i in tar] == [f"pack-1/{n}" for n in names]
        assert {i.name.removeprefix("pack-1/"): tar.extractfile(i).read() for i in tar} == held
    # as the standard library lays it out, up to the padding of the last record
    want = io.BytesIO()
    with tarfile.open(fileobj=want, mode="w", format=tarfile.USTAR_FORMAT) as tar:
        for n, d in held.items():
            info = tarfile.TarInfo(f"pack-1/{n}")
            info.size, info.mode = len(d), 0o644
            tar.addfile(info, io.BytesIO(d))
    assert want.getvalue().startswith(plain) and not want.getvalue()[len(plain) :].strip(b"\0")
    # times and modes do not show
    os.utime(root / "one", (5, 5))
    os.chmod(root / "manifest.json", 0o600)
    again = archives.write(spark, f"file://{root}", names, str(tmp_path / "b.tar.gz")).first()
    assert again["sha256"] == got["sha256"]
    read = archives.members(spark, str(tmp_path / "b.tar.gz")).orderBy("seq").collect()
    assert [(r["path"], r["bytes"], r["sha256"], r["plain"]) for r in read] == [(f"pack-1/{n}", len(d), hashlib.sha256(d).hexdigest(), True) for n, d in held.items()]


def test_release_is_what_the_manifest_says(spark, package, tmp_path):
    root, held = package
    ddl = "seq int, path string, bytes bigint, sha256 string"
    records = [(i, n, len(held[n]), hashlib.sha256(held[n]).hexdigest()) for i, n in enumerate(["one", "deep/w.bin"])]
    listed = spark.createDataFrame(records, ddl)
    archives.release(spark, str(root), "manifest.json", listed, str(tmp_path / "r.tar.gz"))
    assert [r["path"] for r in archives.members(spark, str(tmp_path / "r.tar.gz")).orderBy("seq").collect()] == ["pack-1/manifest.json", "pack-1/one", "pack-1/deep/w.bin"]
    wrong = {
        "not what the manifest says: one": [(0, "one", 1, "00")],
        "lists each file once": [records[0], records[0]],
        "gone: missing": [(0, "gone", 1, "00")],
        "escape": [(0, "../out", 1, "00")],
    }
    (tmp_path / "out").write_bytes(b"1")
    for message, rows in wrong.items():
        with pytest.raises(Exception, match=message):
            archives.release(spark, str(root), "manifest.json", spark.createDataFrame(rows, ddl), str(tmp_path / "w.tar.gz"))
    with pytest.raises(Exception, match="lists each file once"):
        archives.release(spark, str(root), "one", listed, str(tmp_path / "w.tar.gz"))
    os.symlink(root / "one", root / "link")
    with pytest.raises(ValueError, match="link: symlink"):
        archives.write(spark, str(root), ["link"], str(tmp_path / "w.tar.gz"))
    assert not (tmp_path / "w.tar.gz").exists()
    assert files.inventory(spark, str(tmp_path), "*.tar.gz").count() == 1
