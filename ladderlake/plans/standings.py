"""Standings: landed pages to bronze, silver and gold tables.

One table per layer, partitioned by tier and division, takes the place of one
table per tier or division. A full run replaces the table, a run for some tiers
replaces these.

The only shuffle is for the file layout: many small landed files, or the small
bronze partitions of a tier, are merged, and a hot partition is split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.functions import (
    canonical_folder,
    canonical_tier,
    page_number,
    partition_folder,
    tier_key,
    tier_names,
)
from ladderlake.schemas import LADDER, StandingsColumns, standings_schema
from ladderlake.sources import (
    has_misfit,
    landed_files,
    landing_ranges,
    latest_per_key,
    list_by_tasks,
    note_load,
    parse_once,
    read_table,
    record_fields,
    replace_values,
    scan_records,
    why_rejected,
    with_pages,
    write_table,
)


def _only(df: DataFrame, column: str, wanted: Sequence[str] | None) -> DataFrame:
    return df if wanted is None else df.filter(F.col(column).isin(list(wanted)))


def _tiers(names: Sequence[str] | None) -> list[str] | None:
    return None if names is None else [canonical_tier(name) for name in names]


def standings_records(
    spark: SparkSession,
    raw: str,
    tiers: Sequence[str] | None = None,
    cols: StandingsColumns = StandingsColumns(),
    schema: T.StructType | str | None = None,
    extra: str | None = "record",
    latest_only: bool = False,
    glob: str = "*.json",
) -> tuple[DataFrame, DataFrame, dict[str, int | None]]:
    """Landed player records, the rejected ones and their counts, out of one parse.

    The parsed rows are stored: see ``standings_raw_to_bronze``.
    """
    schema = standings_schema(cols) if schema is None else schema
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    files = {"_file": "file_path", "_landed": "file_modification_time"}
    paths = raw if tiers is None else tier_paths(raw, tiers)
    rows = scan_records(spark, paths, glob, metadata=files).withColumns(record_fields(schema))
    reason = why_rejected([cols.player, cols.tier], F.col("record").isNull(), has_misfit(schema))
    # Of an array, the text of the record at hand.
    rows = rows.withColumn("_text", F.coalesce(F.to_json("record"), "_text"))
    rows = rows.withColumn("_why", reason)
    rows = rows.drop("record") if extra is None else rows.withColumnRenamed("record", extra)
    kept, rejected, counts = parse_once(
        rows, F.col("_why"), "standings", page=page_number("_file")
    )
    kept = kept.drop("_why").withColumn(cols.tier, F.upper(tier_key(cols.tier)))
    if latest_only:
        newest = [
            F.col("_landed").desc(),
            page_number("_file").desc_nulls_last(),
            F.col("_file").desc(),
        ]
        kept = latest_per_key(kept, [*cols.group, cols.player], newest)
    return kept.drop("_file", "_landed"), rejected, counts


def tier_paths(raw: str, tiers: Sequence[str]) -> str:
    """Glob of the folders of some tiers; a folder that Spark wrote names its column too."""
    names = [name for t in tiers for name in tier_names(t)]
    return f"{raw}/{{{','.join([*names, *(f'*={n}' for n in names)])}}}_*"


def standings_raw_to_bronze(
    spark: SparkSession,
    raw: str,
    bronze: str,
    tiers: Sequence[str] | None = None,
    cols: StandingsColumns = StandingsColumns(),
    schema: T.StructType | str | None = None,
    extra: str | None = "record",
    latest_only: bool = False,
    rebalance: bool = True,
    glob: str = "*.json",
    fmt: str = "parquet",
    rejects: str | None = None,
) -> DataFrame:
    """Landed pages, in folders ``<tier>_<division>``, to the bronze table.

    The declared fields become columns, and the whole record, with the fields nobody
    declared, a variant column ``extra``, unless that is None. ``tiers`` loads the folders of
    these tiers and no other file.
    A full run replaces the table; one for some tiers replaces these, and leaves none of
    their partitions that are gone. ``latest_only`` keeps the newest landing of a player
    who is in several pages; of files with the same time, the higher page is newer, and
    within one file the choice is arbitrary.

    The raw files are parsed once. Broken records, records with a value that does not fit its
    declared type, and records without player and tier, as failed requests land them, go to
    the table ``rejects`` (by default next to the bronze one) with file, reason and text; the
    other records of an array stay. Counts of that pass are appended to ``<bronze>_loads``.
    """
    kept, rejected, counts = standings_records(
        spark, raw, tiers, cols, schema, extra, latest_only, glob
    )
    base = bronze.rstrip("/")
    write_table(rejected, rejects or f"{base}_rejects", fmt)
    if tiers is None:
        write_table(kept, bronze, fmt, cols.group, "all", rebalance)
    else:
        kept = _only(kept, cols.tier, _tiers(tiers))
        replace_values(kept, bronze, cols.tier, _tiers(tiers), fmt, cols.group, rebalance)
    note_load(spark, f"{base}_loads", counts, ",".join(_tiers(tiers)) if tiers else "all")
    return read_table(spark, bronze, fmt, merge=True)


def ladder_folders(spark: SparkSession, tiers: Sequence[str] = tuple(LADDER)) -> DataFrame:
    """Raw folders that the tiers should have, in a column ``folder``."""
    pairs = [(tier, division) for tier in _tiers(tiers) for division in LADDER[tier]]
    ladder = spark.createDataFrame(pairs, "tier string, division string")
    return ladder.select(partition_folder("tier", "division").alias("folder"))


def landing_status(
    spark: SparkSession,
    raw: str,
    expected: DataFrame | None = None,
    glob: str = "*.json",
    folder_pattern: str = r"/([^/]+)/[^/]+$",
    page_pattern: str = r"(\d+)\.json$",
    levels: int | None = None,
) -> DataFrame:
    """Landed page range of every folder and the page to fetch next.

    To be kept next to a load: it shows a fetch that ended early. ``expected``
    lists folders, in a column ``folder``, that may hold no page so far; landed
    folders that it does not name are listed as well. Folders named by an alias of a
    tier count as that tier's. The patterns take folder and page number out of the
    file paths; no file is read. With ``levels`` the names are listed by tasks, one for each
    folder so many levels below ``raw``: see ``list_by_tasks``.
    """
    names = landed_files(spark, raw, glob) if levels is None else list_by_tasks(spark, raw, glob, levels)
    folder = canonical_folder(F.regexp_extract("path", folder_pattern, 1)).alias("folder")
    listing = with_pages(names, page_pattern).select(folder, "page")
    if expected is not None:
        named = expected.select(canonical_folder("folder").alias("folder"))
        listing = listing.unionByName(named, allowMissingColumns=True)
    return landing_ranges(listing, ["folder"], "page")


def standings_bronze_to_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    tiers: Sequence[str] | None = None,
    divisions: Sequence[str] | None = None,
    cols: StandingsColumns = StandingsColumns(),
    fmt: str = "parquet",
) -> DataFrame:
    """All divisions of each tier together; ``divisions`` narrows the choice."""
    df = read_table(spark, bronze, fmt, merge=True)
    df = _only(_only(df, cols.tier, _tiers(tiers)), cols.division, divisions)
    _publish(df, silver, tiers, cols, fmt)
    return read_table(spark, silver, fmt, merge=True)


def _publish(
    df: DataFrame, path: str, tiers: Sequence[str] | None, cols: StandingsColumns, fmt: str
) -> None:
    """Replace the table, or only the named tiers, also those without rows."""
    if tiers is None:
        write_table(df, path, fmt, [cols.tier])
    else:
        replace_values(df, path, cols.tier, _tiers(tiers), fmt, [cols.tier])


def standings_silver_to_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    tiers: Sequence[str] | None = None,
    cols: StandingsColumns = StandingsColumns(),
    fmt: str = "parquet",
) -> DataFrame:
    """Publish silver tiers unchanged."""
    df = _only(read_table(spark, silver, fmt, merge=True), cols.tier, _tiers(tiers))
    _publish(df, gold, tiers, cols, fmt)
    return read_table(spark, gold, fmt, merge=True)


def standings_all_tiers(
    spark: SparkSession,
    silver: str,
    gold_all: str,
    tiers: Sequence[str] | None = None,
    cols: StandingsColumns = StandingsColumns(),
    fmt: str = "parquet",
) -> DataFrame:
    """Every tier of silver, or the named ones, in one unpartitioned table."""
    df = _only(read_table(spark, silver, fmt, merge=True), cols.tier, _tiers(tiers))
    write_table(df, gold_all, fmt)
    return read_table(spark, gold_all, fmt)
