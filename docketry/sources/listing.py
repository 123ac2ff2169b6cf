"""A file listing as a Spark data source, registered as ``file_listing``.

Spark's own file sources leave out files of zero bytes.  This one lists them
too, and it lists on the executors: the driver only looks at the first level of
folders, which it deals to a bounded number of partitions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from docketry.session import ship_package

SCHEMA = "file_name string, size_bytes bigint, last_modified timestamp"
_ARROW = pa.schema(
    [
        ("file_name", pa.string()),
        ("size_bytes", pa.int64()),
        ("last_modified", pa.timestamp("us", tz="UTC")),
    ]
)
_BATCH = 10_000
#: Partitions that the first level of folders is dealt to, at most; a task for each folder
#: would make a store of many small folders cost a task start for every file.
_PARTITIONS = 128
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def open_filesystem(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a folder given as a path or URI."""
    if "://" not in root and not root.startswith("file:"):
        return pafs.LocalFileSystem(), root.rstrip("/")
    if root.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + root[len("file:"):].strip("/")
    scheme, rest = root.split("://", 1)
    # Hadoop's names of the same stores.
    system, path = pafs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")
    return system, path.rstrip("/")


def glob_pattern(glob: str) -> re.Pattern:
    """A file name glob as Hadoop reads it: ``*``, ``?``, ``[a-z]``, ``[^a]`` and ``{a,b}``."""
    out, depth, i = "", 0, 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out += re.escape(glob[i])
        elif c == "[" and "]" in glob[i + 2:]:
            end = glob.index("]", i + 2)
            inside = glob[i + 1:end]
            out += "[" + ("^" + inside[1:] if inside[0] in "^!" else inside).replace("\\", "\\\\") + "]"
            i = end
        elif c == "{":
            out, depth = out + "(?:", depth + 1
        elif c == "}" and depth:
            out, depth = out + ")", depth - 1
        elif c == "," and depth:
            out += "|"
        else:
            out += {"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c))
        i += 1
    if depth:
        raise ValueError(f"unclosed group in {glob!r}")
    return re.compile(out)


class _Folders(InputPartition):
    def __init__(self, paths: list[str], recurse: bool):
        self.paths, self.recurse = paths, recurse


class _ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        glob = options.get("pathglobfilter") or options.get("pathGlobFilter")
        self.pattern = glob_pattern(glob) if glob else None

    def partitions(self) -> list[_Folders]:
        system, path = open_filesystem(self.root)
        children = system.get_file_info(pafs.FileSelector(path))
        folders = sorted(c.path for c in children if c.type == pafs.FileType.Directory)
        n = min(_PARTITIONS, len(folders))
        return [_Folders([path], False)] + [_Folders(folders[i::n], True) for i in range(n)]

    def read(self, partition: _Folders) -> Iterator[pa.RecordBatch]:
        system, path = open_filesystem(self.root)
        waiting, rows = list(partition.paths), []
        while waiting:
            for info in system.get_file_info(pafs.FileSelector(waiting.pop())):
                if info.type == pafs.FileType.Directory:
                    if partition.recurse:
                        waiting.append(info.path)
                elif self.pattern is None or self.pattern.fullmatch(info.base_name):
                    rows.append((info.path[len(path) + 1:], info.size or 0, info.mtime))
                    if len(rows) == _BATCH:
                        yield _batch(rows)
                        rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
    )


class FileListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _ListingReader:
        return _ListingReader(self.options)


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(FileListing)
