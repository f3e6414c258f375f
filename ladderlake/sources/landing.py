"""The raw landing zone: keyed writes, file listings, resume points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.functions import page_number
from ladderlake.operators.ranking import top_n


def land_json(
    df: DataFrame, path: str, folders: Sequence[str] = (), options: dict | None = None
) -> str:
    """Write rows as JSON lines, one folder per value of ``folders``.

    The rebalance splits a hot folder over several files and merges small ones. Fields
    that are null are written as such.
    """
    options = {"ignoreNullFields": "false", **(options or {})}
    writer = df.hint("rebalance", *folders).write.options(**options).mode("overwrite")
    if folders:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*folders)
    writer.json(path)
    return path


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``: last write wins.

    Each task cuts its keys to one row before the shuffle, so many copies
    of one key do not meet in one task.
    """
    return top_n(df, keys, order, 1, "_rn").drop("_rn")


def landed_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Path, size and time of the landed files; contents are not read.

    Spark lists files on the driver, so point it at a tier or a day (``raw/gold_*``)
    rather than at a root with a file for every match.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )


def next_page(
    listing: DataFrame, group: Sequence[str], page: str, expected: DataFrame | None = None
) -> DataFrame:
    """Page to fetch next in each group: the last landed plus 1, or 1.

    ``expected`` lists the groups that may have landed nothing so far.
    """
    last = listing.groupBy(*group).agg(F.max(page).alias("_last"))
    if expected is not None:
        last = expected.select(*group).distinct().join(last, list(group), "left")
    return last.select(*group, F.coalesce(F.col("_last") + 1, F.lit(1)).alias("next_page"))


def landing_report(listing: DataFrame, group: Sequence[str], page: str) -> DataFrame:
    """Range of landed pages in each group and how many are absent inside it."""
    return landing_ranges(listing, group, page).filter("file_count > 0").drop("next_page")


def landing_ranges(listing: DataFrame, group: Sequence[str], page: str) -> DataFrame:
    """``landing_report`` of every group, also without a page, with the page to fetch next."""
    pages = listing.groupBy(*group, page).agg(F.count(F.lit(1)).alias("_files"))
    known = F.col(page).isNotNull()
    return (
        pages.groupBy(*group)
        .agg(
            F.min(page).alias("first_page"),
            F.max(page).alias("last_page"),
            F.count_if(known).alias("page_count"),
            F.coalesce(F.sum(F.when(known, F.col("_files"))), F.lit(0)).alias("file_count"),
        )
        .withColumn("next_page", F.coalesce(F.col("last_page") + 1, F.lit(1)))
        .withColumn(
            "absent_pages",
            (F.col("last_page") - F.col("first_page") + 1 - F.col("page_count")).cast("bigint"),
        )
    )


def with_pages(listing: DataFrame, pattern: str = r"(\d+)\.json$") -> DataFrame:
    """A file listing with the page number of each path."""
    return listing.withColumn("page", page_number("path", pattern))


def not_yet_loaded(landed: DataFrame, ledger: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Landed rows or files that the ledger of loaded ones does not name."""
    keys = [on] if isinstance(on, str) else list(on)
    return landed.join(ledger.select(*keys), keys, "left_anti")
