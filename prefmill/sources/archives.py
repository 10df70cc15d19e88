"""Deterministic tar.gz archives, compressed in pieces by the executors.

A gzip file may be several gzip streams one after the other, so an archive is cut into pieces: the header of a
member, up to ``PIECE`` bytes of its body, its padding, the end of the archive. Tasks read, compress and write their pieces to the shared
folder; one task joins them, a chunk at a time. No process holds more of an archive than a chunk, however large
its members are, and its bytes depend on the members' names and contents alone: not on times, owners, modes or tasks.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import tarfile
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from prefmill.functions.workers import importable
from prefmill.sources.records import CHUNK, Local, file_records, local_root
from prefmill.sources.shared import folder

PIECE = 64 << 20
FORMAT = "deterministic-tar-gzip-v1"
#: What the headers of all members say.
MODE, OWNER, TIME = 0o644, 0, 0
#: A gzip header without a name or a time: magic, deflate, no flags, time 0, best compression, unknown system.
GZIP = bytes((0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 2, 0xFF))


def header(name: str, size: int) -> bytes:
    """The USTAR header of a member."""
    info = tarfile.TarInfo(name)
    info.size, info.mtime, info.mode = size, TIME, MODE
    info.uid = info.gid = OWNER
    info.uname = info.gname = ""
    return info.tobuf(tarfile.USTAR_FORMAT)


def pieces(members: Sequence[tuple[str, str, int]]) -> list[tuple[int, str | None, str | None, int, int, int]]:
    """(number, name in the archive, name of the file, its size, from, to) of each piece; the last has no name."""
    out: list[tuple[int, str | None, str | None, int, int, int]] = []
    for name, file, size in members:
        for a in range(0, max(size, 1), PIECE):
            out.append((len(out), name, file, size, a, min(size, a + PIECE)))
    return [*out, (len(out), None, None, 0, 0, 0)]


def plain(store: Local, name: str | None, file: str | None, size: int, start: int, stop: int) -> Iterator[bytes]:
    """The bytes of the tar in a piece."""
    if name is None or file is None:
        yield bytes(1024)
        return
    if not start:
        yield header(name, size)
    with store.open(file) as body:
        body.seek(start)
        left = stop - start
        while left:
            chunk = body.read(min(CHUNK, left))
            if not chunk:
                raise ValueError(f"{file} has fewer bytes than its record says")
            left -= len(chunk)
            yield chunk
        if stop == size and body.read(1):
            raise ValueError(f"{file} has more bytes than its record says")
    if stop == size:
        yield bytes(-size % 512)


def packed(parts: Iterator[bytes]) -> Iterator[bytes]:
    """One gzip stream."""
    press, check, total = zlib.compressobj(9, zlib.DEFLATED, -zlib.MAX_WBITS), 0, 0
    yield GZIP
    for part in parts:
        check, total = zlib.crc32(part, check), total + len(part)
        if squeezed := press.compress(part):
            yield squeezed
    yield press.flush() + check.to_bytes(4, "little") + (total & 0xFFFFFFFF).to_bytes(4, "little")


def _saved(path: str, parts: Iterator[bytes]) -> tuple[int, str]:
    """(bytes, SHA-256) of parts, written under another name first, so that a task that is tried again does no harm."""
    size, sha, draft = 0, hashlib.sha256(), f"{path}.{os.getpid()}.draft"
    with open(draft, "wb") as out:
        for part in parts:
            out.write(part)
            sha.update(part)
            size += len(part)
    os.replace(draft, path)
    return size, sha.hexdigest()


def write(spark: SparkSession, root: str, names: Sequence[str], path: str, top: str | None = None) -> DataFrame:
    """Write the files below root, in the order of names, as a tar.gz to path: (name, bytes, sha256, package, files, format).

    Members are named below ``top``, by default the root's own name. Root, path and spark.checkpoint.dir are on a file
    system that driver and executors share. Raises where a file is no regular nonempty one.
    """
    importable(spark)
    places = {"root": local_root(root), "path": local_root(path), "work": local_root(folder(spark, "archive"))}
    if None in places.values():
        raise ValueError("archives are written from and to mounted file systems")
    base, target, work = places["root"], places["path"], places["work"]
    top = os.path.basename(base) if top is None else top
    store = Local(base)
    looked = [(n, *store.look(n)) for n in names]
    wrong = [f"{n}: {issue}" for n, _, issue in looked if issue]
    if wrong:
        raise ValueError(f"not regular nonempty files below {root}: {', '.join(wrong)}")
    asked = pieces([(f"{top}/{n}", n, size) for n, size, _ in looked])
    os.makedirs(work, exist_ok=True)
    os.makedirs(os.path.dirname(target), exist_ok=True)

    def compress(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number, name, file, size, start, stop in frame.itertuples(index=False, name=None):
                own = (name, file) if isinstance(name, str) else (None, None)
                done, _ = _saved(f"{work}/{number:09}", packed(plain(Local(base), *own, size, start, stop)))
                yield pd.DataFrame({"number": [number], "bytes": [done]})

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def read(count: int) -> Iterator[bytes]:
            for k in range(count):
                with open(f"{work}/{k:09}", "rb") as part:
                    while chunk := part.read(CHUNK):
                        yield chunk

        for frame in frames:
            for count in frame["id"]:
                yield pd.DataFrame([_saved(target, read(count))], columns=["bytes", "sha256"])

    spread = min(len(asked), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame(asked, "number int, name string, file string, size bigint, start bigint, stop bigint").repartitionByRange(spread, "number")
    made = rows.mapInPandas(compress, "number int, bytes bigint").count()  # names and sizes alone reach the driver
    if made != len(asked):
        raise ValueError(f"{made} of {len(asked)} pieces were written")
    whole = spark.range(made, made + 1, numPartitions=1).mapInPandas(join, "bytes bigint, sha256 string").first()
    for k in range(made):
        os.remove(f"{work}/{k:09}")
    os.rmdir(work)
    row = (os.path.basename(target), whole["bytes"], whole["sha256"], top, len(names), FORMAT)
    return spark.createDataFrame([row], "name string, bytes bigint, sha256 string, package string, files int, format string")


def release(spark: SparkSession, root: str, manifest: str, listed: DataFrame, path: str) -> DataFrame:
    """An archive of a package: its manifest first, then the files that it lists (path, bytes, sha256), in their order (seq).

    Raises where a listed file is missing, twice there, outside, or not what its record says.
    """
    want = [(r["path"], r["bytes"], r["sha256"]) for r in listed.orderBy("seq").collect()]
    names = [n for n, _, _ in want]
    if manifest in names or len(set(names)) != len(names):
        raise ValueError("a package lists each file once, and not its manifest")
    have = {r["path"]: (r["bytes"], r["sha256"]) for r in file_records(spark, root, names=names).collect()}
    wrong = sorted(n for n, size, sha in want if have[n] != (size, sha))
    if wrong:
        raise ValueError(f"files are not what the manifest says: {', '.join(wrong)}")
    return write(spark, root, [manifest, *names], path)


def members(spark: SparkSession, path: str) -> DataFrame:
    """(seq, path, bytes, sha256, plain) of an archive's members, read as a stream by one task; plain: no time, owner or other mode."""
    importable(spark)
    target = local_root(path)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _ in frame["id"]:
                with gzip.open(target) as body, tarfile.open(fileobj=body, mode="r|") as tar:
                    for seq, info in enumerate(tar):
                        sha, held = hashlib.sha256(), tar.extractfile(info)
                        while held is not None and (chunk := held.read(CHUNK)):
                            sha.update(chunk)
                        same = (info.mtime, info.uid, info.gid, info.uname, info.gname, info.mode) == (TIME, OWNER, OWNER, "", "", MODE)
                        yield pd.DataFrame([(seq, info.name, info.size, sha.hexdigest(), same)], columns=["seq", "path", "bytes", "sha256", "plain"])

    return spark.range(1, numPartitions=1).mapInPandas(read, "seq int, path string, bytes bigint, sha256 string, plain boolean")
