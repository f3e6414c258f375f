"""Listings of landed files made by tasks: a data source whose partitions are prefixes."""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ladderlake.session import materialize, reachable, register_source

LISTING = "path string, length bigint, modificationTime timestamp"

# Names of one batch that a task hands on.
BATCH = 10_000


def open_path(path: str):
    """The file system of a path, as tasks reach it, the path within, and what Spark puts before."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path.rstrip("/") or "/", "file:"
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].strip("/"), "file:"
    system, within = fs.FileSystem.from_uri(path.rstrip("/"))
    return system, within, path.rstrip("/").removesuffix(within)


def _hidden(name: str) -> bool:
    return name.startswith((".", "_"))


class Prefix(InputPartition):
    """A folder to list with all below it, or, if not ``deep``, its own files alone."""

    def __init__(self, path: str, deep: bool):
        self.path, self.deep = path, deep


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.glob = options.get("glob", "*")
        self.levels = int(options.get("levels", "1"))

    def partitions(self) -> list[Prefix]:
        """One prefix for each folder ``levels`` below the root, and the files above them."""
        from pyarrow import fs

        system, root, _ = open_path(self.root)
        if system.get_file_info(root).type == fs.FileType.NotFound:
            raise FileNotFoundError(self.root)
        level, found = [root], []
        for _ in range(self.levels):
            found += [Prefix(p, False) for p in level]
            level = [x.path for p in level for x in _entries(system, p) if x.type == fs.FileType.Directory]
        return found + [Prefix(p, True) for p in level]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, _, before = open_path(self.root)
        held: list[tuple] = []
        folders = [partition.path]
        while folders:
            for x in _entries(system, folders.pop()):
                if x.type == fs.FileType.Directory:
                    if partition.deep:
                        folders.append(x.path)
                elif x.size and fnmatchcase(x.base_name, self.glob):
                    held.append((before + x.path, x.size, (x.mtime_ns or 0) // 1_000_000 * 1000))
                    if len(held) == BATCH:
                        yield _batch(held)
                        held = []
        yield _batch(held)


def _entries(system, folder: str) -> list:
    from pyarrow import fs

    return [x for x in system.get_file_info(fs.FileSelector(folder)) if not _hidden(x.base_name)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows)] or [[], [], []]
    kinds = (pa.string(), pa.int64(), pa.timestamp("us", tz="UTC"))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "length", "modificationTime"]
    )


class ListingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_names"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options)


def list_by_tasks(spark: SparkSession, path: str, glob: str = "*.json", levels: int = 1) -> DataFrame:
    """``landed_files`` by many tasks: a task for every folder ``levels`` below ``path``.

    The driver lists folders down to there and no file; each task lists its prefix, with all
    below, folder by folder. The listing is stored, as it would be made anew by every use. Files
    are reached through ``pyarrow.fs``, in local mounts, object stores and HDFS; names that start
    with a dot or an underscore, and files without a byte, are left out, as by Spark. A path that does not exist is an error.
    """
    reachable(spark)
    register_source(spark, ListingSource)
    reader = spark.read.format("landed_names").option("glob", glob).option("levels", levels)
    return materialize(reader.load(path), "listing")
