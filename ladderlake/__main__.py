r"""The jobs as commands, one layer step each, for any scheduler.

    spark-submit --py-files ladderlake.zip ladderlake/__main__.py \
        standings-bronze --raw RAW --bronze TABLE --tier GOLD
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from ladderlake.functions import canonical_tier
from ladderlake.operators import record_drift, top_players
from ladderlake.plans import (
    ladder_folders,
    landing_status,
    match_merge_to_bronze,
    match_raw_to_bronze,
    republish,
    standings_all_tiers,
    standings_bronze_to_silver,
    standings_raw_to_bronze,
    standings_silver_to_gold,
    whole_records_to_bronze,
)
from ladderlake.schemas import LADDER
from ladderlake.session import build_session, staging
from ladderlake.sources import read_table, write_csv
from ladderlake.streaming import resume_points, track_pages


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ladderlake", description=__doc__.splitlines()[0])
    parser.add_argument("--format", default="parquet", help="table format: parquet, or delta where the session has it")
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, *paths: str, tiers: bool = False) -> argparse.ArgumentParser:
        sub = steps.add_parser(name)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        if tiers:
            sub.add_argument("--tier", action="append", type=canonical_tier)
        return sub

    step("landing-status", "raw", tiers=True)
    step("standings-bronze", "raw", "bronze", tiers=True).add_argument(
        "--declared-only", action="store_true", help="leave out undeclared fields"
    )
    step("standings-silver", "bronze", "silver", tiers=True).add_argument(
        "--division", action="append"
    )
    step("standings-gold", "silver", "gold", tiers=True)
    step("standings-all", "silver", "gold", tiers=True)
    step("top-players", "gold")
    step("matches-bronze", "raw", "bronze").add_argument("--tier", type=canonical_tier)
    step("matches-merge", "raw", "bronze", "checkpoint")
    step("track-pages", "raw", "status", "checkpoint")
    step("record-drift", "bronze").add_argument("--day", help="a column of days")
    again = step("republish", "source", "target")
    again.add_argument("--partition-by", action="append", default=[])
    again.add_argument("--only-changed", action="store_true", help="rewrite partitions that differ")
    step("whole-records", "raw", "bronze").add_argument("--variant", action="store_true")
    step("export-csv", "source", "target")
    return parser


def run(spark: SparkSession, argv: list[str]) -> DataFrame:
    """Run one step and return its result."""
    a = _parser().parse_args(argv)
    fmt = a.format
    if a.step == "landing-status":
        return landing_status(spark, a.raw, ladder_folders(spark, a.tier or tuple(LADDER)))
    if a.step == "standings-bronze":
        extra = None if a.declared_only else "record"
        return standings_raw_to_bronze(spark, a.raw, a.bronze, tiers=a.tier, extra=extra, fmt=fmt)
    if a.step == "standings-silver":
        return standings_bronze_to_silver(spark, a.bronze, a.silver, a.tier, a.division, fmt=fmt)
    if a.step == "standings-gold":
        return standings_silver_to_gold(spark, a.silver, a.gold, a.tier, fmt=fmt)
    if a.step == "standings-all":
        return standings_all_tiers(spark, a.silver, a.gold, a.tier, fmt=fmt)
    if a.step == "top-players":
        return top_players(read_table(spark, a.gold, fmt))
    if a.step == "matches-bronze":
        return match_raw_to_bronze(spark, a.raw, a.bronze, a.tier, with_tier=True, fmt=fmt)
    if a.step == "matches-merge":
        return match_merge_to_bronze(spark, a.raw, a.bronze, a.checkpoint)
    if a.step == "track-pages":
        track_pages(spark, a.raw, a.status, a.checkpoint)
        return resume_points(spark, a.status, ladder_folders(spark))
    if a.step == "record-drift":
        bronze = read_table(spark, a.bronze, fmt, merge=True)
        return record_drift(bronze, ["tier"], day=a.day, declared=bronze.columns)
    if a.step == "republish":
        return republish(spark, a.source, a.target, a.partition_by, fmt, a.only_changed)
    if a.step == "whole-records":
        return whole_records_to_bronze(spark, a.raw, a.bronze, as_variant=a.variant, fmt=fmt)
    source = read_table(spark, a.source, fmt)
    write_csv(source, a.target)
    return source


def main(argv: list[str] | None = None) -> None:
    spark = build_session()
    with staging(spark):
        run(spark, sys.argv[1:] if argv is None else argv).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
