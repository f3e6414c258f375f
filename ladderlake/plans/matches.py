"""Matches of selected players: from the choice of players to gold fact rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.functions import canonical_tier, tier_key, tier_names
from ladderlake.operators.lookup import recent_per_player
from ladderlake.operators.nested import match_facts
from ladderlake.operators.ranking import top_players
from ladderlake.schemas import PARTICIPANT_FIELDS, StandingsColumns, match_schema
from ladderlake.session import materialize, staging
from ladderlake.sources import (
    is_broken,
    is_misfit,
    latest_per_key,
    merge_latest,
    note_load,
    parse_once,
    publish_changed,
    read_table,
    replace_values,
    scan_json,
    scan_records,
    why_rejected,
    write_table,
)
from ladderlake.sources.merge import BUCKETS
from ladderlake.streaming import load_new_files


def select_matches(
    standings: DataFrame,
    history: DataFrame,
    cols: StandingsColumns = StandingsColumns(),
    player: str = "player_id",
    match: str = "match_id",
    **request,
) -> DataFrame:
    """(tier, match) pairs to land: recent matches of the top players.

    A match that several chosen players of a tier share is listed once for it.
    """
    best = top_players(standings, cols).select(cols.tier, F.col(cols.player).alias(player))
    best = materialize(best, "best")
    played = history.join(best.select(player).distinct(), player, "left_semi")
    recent = recent_per_player(played, player, match, **request)
    return recent.join(best, player).select(cols.tier, match).distinct()


def land_matches(
    payloads: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """One payload per (tier, match): a later landing replaces an earlier one."""
    return latest_per_key(payloads, keys, order)


def match_raw_to_bronze(
    spark: SparkSession,
    raw: str,
    bronze: str,
    tier: str | None = None,
    fields: Sequence[str] = PARTICIPANT_FIELDS,
    with_tier: bool = False,
    latest_only: bool = False,
    rebalance: bool = True,
    glob: str = "*.json",
    fmt: str = "parquet",
    rejects: str | None = None,
) -> DataFrame:
    """Landed match files, ``<tier>_<match>.json``, to participant rows.

    ``tier`` selects files by name, and no other file is opened. ``with_tier`` makes the
    tier in the name a column, and the table one of all tiers; a run for one tier then
    replaces that tier, also if no row of it is left. ``latest_only`` keeps the newest
    landing of a match in each tier: by file time, then by file name; within one file the
    choice is arbitrary. Without it nothing is shuffled but for the file layout.

    The raw files are parsed once, to a copy that is deleted at the end. Broken records, records
    with a value that does not fit its declared type, and the empty ones of failed requests go
    to the table ``rejects`` (by default next to the bronze one) with file, reason and text.
    Counts of that pass are appended to ``<bronze>_loads``.
    """
    if tier is not None:
        glob = f"{{{','.join(tier_names(tier))}}}_{glob}"
    files = {"_file": "file_path", "_landed": "file_modification_time"}
    docs = scan_json(spark, raw, match_schema(fields), glob, metadata=files, corrupt="_text")
    reason = why_rejected(["metadata", "info"], is_broken("_text"), is_misfit("_text"))
    base = bronze.rstrip("/")
    with staging(spark):
        kept, rejected, counts = parse_once(docs, reason, "matches")
        write_table(rejected, rejects or f"{base}_rejects", fmt)
        note_load(spark, f"{base}_loads", counts, canonical_tier(tier) if tier else "all")
        name = F.regexp_extract("_file", r"/([^/_]+)_[^/]*$", 1)
        kept = kept.withColumn("tier", F.upper(tier_key(name)))
        if latest_only:
            kept = kept.withColumn("matchId", F.col("metadata.matchId"))
            newest = [F.col("_landed").desc(), F.col("_file").desc()]
            kept = latest_per_key(kept, ["tier", "matchId"], newest).drop("matchId")
        facts = match_facts(kept, fields, keep=["tier"] if with_tier else [])
        if not with_tier:
            write_table(facts, bronze, fmt, rebalance=rebalance)
        elif tier is None:
            write_table(facts, bronze, fmt, ["tier"], "all", rebalance)
        else:
            replace_values(facts, bronze, "tier", [canonical_tier(tier)], fmt, ["tier"], rebalance)
    return read_table(spark, bronze, fmt, merge=with_tier)


def match_merge_to_bronze(
    spark: SparkSession,
    raw: str,
    bronze: str,
    checkpoint: str,
    fields: Sequence[str] = PARTICIPANT_FIELDS,
    buckets: int = BUCKETS,
    glob: str = "*.json",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Match files landed since the last run, merged into the newest payload of every match.

    The table holds a document per (tier, match), with the time and name of its file, in hash
    buckets of that key. A run parses the new files only, and reads and replaces the buckets
    that their matches fall in. The participant rows of all documents are returned. The newest
    landing is that of ``match_raw_to_bronze``; rejects and counts are stored as by
    ``load_new_files``.
    """

    def save(docs: DataFrame, batch: str) -> None:
        name = F.regexp_extract("file", r"/([^/_]+)_[^/]*$", 1)
        docs = docs.withColumns(
            {"tier": F.upper(tier_key(name)), "matchId": F.col("metadata.matchId")}
        )
        newest = [F.col("landed").desc(), F.col("file").desc()]
        merge_latest(docs, bronze, ["tier", "matchId"], newest, ["tier"], buckets)

    load_new_files(
        spark,
        raw,
        bronze,
        checkpoint,
        match_schema(fields),
        glob,
        files_per_batch=files_per_batch,
        file_column="file",
        save=save,
        metadata={"landed": "file_modification_time"},
    )
    return match_facts(read_table(spark, bronze).drop("matchId"), fields, keep=["tier"])


def republish(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    only_changed: bool = False,
) -> DataFrame:
    """Publish a table unchanged in another layer, without a shuffle.

    The target is replaced whole: what the source no longer has is gone. With
    ``only_changed``, a partition whose rows are those published before is not written again:
    see ``publish_changed``.
    """
    df = read_table(spark, source, fmt, merge=bool(partition_by))
    if only_changed:
        publish_changed(spark, df, target, partition_by)
        return read_table(spark, target, fmt, merge=True)
    write_table(df, target, fmt, partition_by, rebalance=False)
    return read_table(spark, target, fmt)


def whole_records_to_bronze(
    spark: SparkSession,
    raw: str,
    bronze: str,
    schema: T.StructType | str | None = None,
    as_variant: bool = False,
    glob: str = "*",
    fmt: str = "parquet",
    options: dict | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """Landed records with all their fields.

    With ``as_variant`` the records stay whole in one column ``record`` of type
    variant, which takes any fields and a single pass. With a schema, its fields become
    columns. Without a schema it is inferred, in a pass of its own over the files, and records
    that are broken show up in a column ``_corrupt_record``. In all cases the records are
    parsed once, and broken, misfit and empty ones go to the table ``rejects`` (by default next
    to the bronze one) and counts to ``<bronze>_loads``.
    """
    files = {"_file": "file_path"}
    if as_variant:
        rows = scan_records(spark, raw, glob, metadata=files)
        nothing = F.when(F.is_variant_null("record"), None).otherwise(F.lit(True))
        rows = rows.withColumn("_some", nothing)
        own, reason = ["record"], why_rejected(["_some"], F.col("record").isNull())
    else:
        corrupt = None if schema is None else "_text"
        rows = scan_json(spark, raw, schema, glob, None, files, options, corrupt)
        own = [c for c in rows.columns if c not in ("_text", "_file")]
        if schema is None:
            rows = rows.withColumn("_text", F.lit("null"))
            reason = why_rejected(own, F.lit(False))
        else:
            reason = why_rejected(own, is_broken("_text"), is_misfit("_text"))
    kept, rejected, counts = parse_once(rows, reason, "records")
    base = bronze.rstrip("/")
    write_table(kept.select(own), bronze, fmt)
    write_table(rejected, rejects or f"{base}_rejects", fmt)
    note_load(spark, f"{base}_loads", counts)
    return read_table(spark, bronze, fmt)


def top_match_facts(
    wanted: DataFrame,
    docs: DataFrame,
    fields: Sequence[str] = PARTICIPANT_FIELDS,
    tier: str = "tier",
    match: str = "match_id",
) -> DataFrame:
    """Participant rows of the wanted (tier, match) pairs."""
    wanted = materialize(wanted.select(tier, match), "wanted")
    landed = docs.withColumn(match, F.col("metadata.matchId")).join(wanted, match)
    return match_facts(landed, fields, keep=[tier])
