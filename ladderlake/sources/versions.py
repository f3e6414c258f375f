"""Whole tables replaced at once: every publication is a folder of its own, and a file names the last."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.session import delete_path, path_exists
from ladderlake.sources.tables import read_table, write_table

_NAME = "_current"


def _files(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _names(spark: SparkSession, path: str) -> list[str]:
    system, folder = _files(spark, path)
    names = sorted(x.getPath().getName() for x in system.listStatus(folder))
    return [n for n in names if not n.startswith(".")]


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder that readers get, or None before the first publication."""
    pointers = f"{path.rstrip('/')}/{_NAME}"
    names = _names(spark, pointers) if path_exists(spark, pointers) else []
    return names[-1] if names else None


def publish_version(
    df: DataFrame, path: str, partition_by: list[str] | tuple[str, ...] = (), keep: int = 2, **layout
) -> str:
    """Replace a whole table so that readers see all of the old or all of the new one.

    The rows are written to a new folder. Then its name, which sorts behind all earlier ones, is
    put beside theirs by creating one empty file, the only step that readers can notice; a run
    that fails before has published nothing. ``df`` may read the version before. The last
    ``keep`` versions stay, for readers that are still at them; older ones, and what failed
    runs left, are deleted afterwards. One publisher at a time.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    last = current_version(spark, base)
    number = int(last.split("-")[0]) + 1 if last else 1
    name = f"{number:012}-{uuid.uuid4().hex}"
    write_table(df, f"{base}/{name}", partition_by=partition_by, **layout)
    system, pointer = _files(spark, f"{base}/{_NAME}/{name}")
    system.create(pointer).close()

    named = _names(spark, f"{base}/{_NAME}")
    stays = {_NAME, *named[-max(1, keep) :]}
    for old in named:
        if old not in stays:
            delete_path(spark, f"{base}/{_NAME}/{old}")
    for old in _names(spark, base):
        if old not in stays:
            delete_path(spark, f"{base}/{old}")
    return f"{base}/{name}"


def read_published(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """The table as last published; what is published later does not change this result."""
    name = current_version(spark, path)
    if name is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return read_table(spark, f"{path.rstrip('/')}/{name}", merge=merge)


def publish_values(
    df: DataFrame, path: str, column: str, values: list[str], partition_by: list[str] | tuple[str, ...] = ()
) -> str:
    """Replace the rows of some values of a column, at once: the rest is taken over unchanged."""
    spark = df.sparkSession
    if current_version(spark, path) is None:
        return publish_version(df, path, partition_by or [column])
    before = read_published(spark, path, merge=True)
    rest = before.filter(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))
    both = rest.unionByName(df, allowMissingColumns=True)
    return publish_version(both, path, partition_by or [column])
