"""File records as a Spark data source: every file's size, SHA-256 and lines, streamed on the executors.

``spark.read.format("file_records")`` lists what lies below a folder, or the files it is given by name, and
deals them out: small files together up to ``GROUP`` bytes, a larger one alone. A task reads a file in chunks of
1 MiB, so its memory does not depend on the file's size. Nothing but names and sizes passes the driver.

A name may also stand for a folder of part files, as Spark writes them: with ``parts`` their bytes in the order of their
names count as one file.

Only regular, nonempty files inside the root are records. Anything else has an ``issue``: missing, symlink, escape
(an absolute name, one that leaves the root, or a link that does), empty, irregular (a folder, a device); the strict
reader raises with all of them instead. Stores other than a mounted file system are read by Arrow's file systems.
"""

from __future__ import annotations

import fnmatch
import hashlib
import json
import os
import stat
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from prefmill.functions.workers import importable

CHUNK = 1 << 20
GROUP = 64 << 20
SCHEMA = "path string, bytes bigint, sha256 string, lines bigint, issue string"


def local_root(path: str) -> str | None:
    """The folder on a mounted file system that a path names, or None where it is in another store."""
    url = urlparse(path)
    if url.scheme in ("", "file"):
        return os.path.realpath(unquote(url.path) if url.scheme else path)
    return None


class Local:
    """Files below a folder of a mounted file system."""

    def __init__(self, root: str) -> None:
        self.root = root

    def names(self) -> Iterator[str]:
        """Relative names of all files; folders that are links are told, not entered."""
        for at, folders, files in os.walk(self.root):
            linked = [d for d in folders if os.path.islink(os.path.join(at, d))]
            for name in sorted(files + linked):
                yield os.path.relpath(os.path.join(at, name), self.root).replace(os.sep, "/")

    def look(self, name: str) -> tuple[int, str | None]:
        """(bytes, issue) of a relative name."""
        path = os.path.join(self.root, name)
        if os.path.isabs(name) or not f"{os.path.realpath(path)}/".startswith(f"{self.root}/"):
            return 0, "escape"
        try:
            found = os.lstat(path)
        except OSError:
            return 0, "missing"
        if stat.S_ISLNK(found.st_mode):
            return 0, "symlink"
        if not stat.S_ISREG(found.st_mode):
            return 0, "irregular"
        return found.st_size, None if found.st_size else "empty"

    def parts(self, name: str) -> list[str] | None:
        """The part files of a folder, or None where it is none."""
        path = os.path.join(self.root, name)
        if os.path.islink(path) or not os.path.isdir(path):
            return None
        return [f"{name}/{x}" for x in sorted(os.listdir(path)) if x[0] not in "._"]

    def open(self, name: str):
        return open(os.path.join(self.root, name), "rb")  # noqa: SIM115


class Remote:
    """Files below a folder of a store that Arrow knows by its URL."""

    def __init__(self, url: str) -> None:
        from pyarrow import fs

        self.store, self.root = fs.FileSystem.from_uri(url)

    def names(self) -> Iterator[str]:
        from pyarrow import fs

        found = self.store.get_file_info(fs.FileSelector(self.root, recursive=True))
        yield from sorted(os.path.relpath(x.path, self.root) for x in found if x.type == fs.FileType.File)

    def look(self, name: str) -> tuple[int, str | None]:
        from pyarrow import fs

        if name.startswith("/") or ".." in name.split("/"):
            return 0, "escape"
        found = self.store.get_file_info(f"{self.root}/{name}")
        if found.type == fs.FileType.NotFound:
            return 0, "missing"
        if found.type != fs.FileType.File:
            return 0, "irregular"
        return found.size, None if found.size else "empty"

    def parts(self, name: str) -> list[str] | None:
        from pyarrow import fs

        at = f"{self.root}/{name}"
        if self.store.get_file_info(at).type != fs.FileType.Directory:
            return None
        found = self.store.get_file_info(fs.FileSelector(at))
        return [f"{name}/{x.base_name}" for x in sorted(found, key=lambda x: x.base_name) if x.base_name[0] not in "._"]

    def open(self, name: str):
        return self.store.open_input_stream(f"{self.root}/{name}")


def place(path: str) -> Local | Remote:
    root = local_root(path)
    return Remote(path) if root is None else Local(root)


def digest(store: Local | Remote, names: Sequence[str]) -> tuple[int, str, int]:
    """(bytes, SHA-256, lines that are not blank) of some files' bytes one after the other."""
    total, lines, sha = 0, 0, hashlib.sha256()
    full = False  # whether the line that is being read has anything but white space
    for name in names:
        with store.open(name) as file:
            while chunk := file.read(CHUNK):
                total += len(chunk)
                sha.update(chunk)
                *ended, rest = chunk.split(b"\n")
                for line in ended:
                    lines += full or not (line.isspace() or not line)
                    full = False
                full = full or not (rest.isspace() or not rest)
    return total, sha.hexdigest(), lines + full


class Group(InputPartition):
    """Some logical files of one task: (name, physical names, issue)."""

    def __init__(self, files: list[tuple[str, list[str], str | None]]) -> None:
        super().__init__(files)
        self.files = files


class FileRecordReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.path = options["path"]
        self.pattern = options.get("pattern", "*")
        self.given = json.loads(options["names"]) if "names" in options else None
        self.joined = options.get("parts", "false").lower() == "true"
        self.strict = options.get("strict", "true").lower() == "true"

    def partitions(self) -> Sequence[Group]:
        store = place(self.path)
        if self.given is not None:
            names = list(self.given)
        else:
            names = sorted(n for n in store.names() if fnmatch.fnmatch(n.rsplit("/", 1)[-1], self.pattern))
        files, wrong = [], []
        for name in names:
            size, issue = store.look(name)
            own = [name]
            if issue == "irregular" and self.joined and (parts := store.parts(name)) is not None:
                looked = [(p, *store.look(p)) for p in parts]
                # an empty part file is as good as none, a folder of such is empty
                issue = next((i for _, _, i in looked if i not in (None, "empty")), None)
                own, size = [p for p, n, _ in looked if n], sum(n for _, n, _ in looked)
                issue = issue or (None if size else "empty")
            if issue:
                wrong.append(f"{name}: {issue}")
            files.append((size, (name, own, issue)))
        if wrong and self.strict:
            raise ValueError(f"not regular nonempty files below {self.path}: {', '.join(wrong)}")
        groups, held, room = [], [], GROUP
        for size, file in files:
            if held and size > room:
                groups.append(Group(held))
                held, room = [], GROUP
            held.append(file)
            room -= size
        return [*groups, Group(held)]

    def read(self, partition: Group) -> Iterator[tuple]:
        store = place(self.path)
        for name, own, issue in partition.files:
            yield (name, None, None, None, issue) if issue else (name, *digest(store, own), None)


class FileRecords(DataSource):
    """Options: path (the root), pattern (of file names) or names (a JSON list of relative names), parts, strict."""

    @classmethod
    def name(cls) -> str:
        return "file_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FileRecordReader:
        return FileRecordReader(self.options)


def file_records(spark: SparkSession, path: str, pattern: str = "*", names: Sequence[str] | None = None, parts: bool = False, strict: bool = True) -> DataFrame:
    """(path, bytes, sha256, lines, issue) of the files below path, or of those given by name."""
    importable(spark)
    spark.dataSource.register(FileRecords)
    reader = spark.read.format("file_records").option("pattern", pattern).option("parts", str(parts)).option("strict", str(strict))
    if names is not None:
        reader = reader.option("names", json.dumps(list(names)))
    return reader.load(path)


def split_records(spark: SparkSession, path: str, files: Mapping[str, str]) -> DataFrame:
    """(split, path, bytes, sha256, rows) of a dataset's splits, each a file or a folder of part files below path.

    Raises, before any row, where a split is missing or empty, and when read, where it has only blank lines.
    """
    found = file_records(spark, path, names=list(files.values()), parts=True)
    named = spark.createDataFrame([(s, p) for s, p in files.items()], "split string, path string")
    blank = F.raise_error(F.concat(F.lit("missing nonempty split: "), F.col("path")))
    return found.join(F.broadcast(named), "path").select("split", "path", "bytes", "sha256", F.when(F.col("lines") > 0, F.col("lines")).otherwise(blank).alias("rows"))
