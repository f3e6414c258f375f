"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake import stand_ins as views
from ladderlake.functions import (
    decode_json,
    digits,
    encode_json,
    match_path,
    page_number,
    page_path,
    partition_folder,
    tier_key,
    win_rate,
)
from ladderlake.operators import (
    columns_of_type,
    count_by,
    describe,
    describe_by,
    describe_strings,
    distinct_count,
    distinct_values,
    drift_across,
    explode_fields,
    lookup_chain,
    match_facts,
    matches_of_players,
    merge_states,
    null_profile,
    preview,
    profile_figures,
    recent_per_player,
    record_drift,
    record_schemas,
    resolve_names,
    row_count,
    schema_drift,
    schema_report,
    top_players,
    union_by_name,
    union_by_position,
    union_widened,
    update_profile,
)
from ladderlake.operators.ranking import eligible, rank_players, top_n
from ladderlake.plans import (
    landing_status,
    land_matches,
    match_merge_to_bronze,
    match_raw_to_bronze,
    republish,
    select_matches,
    standings_all_tiers,
    standings_bronze_to_silver,
    standings_raw_to_bronze,
    standings_silver_to_gold,
    top_match_facts,
    whole_records_to_bronze,
)
from ladderlake.schemas import MATCH_COUNT_FIELDS, match_schema
from ladderlake.session import dropping_shuffles, materialize, staging_path, tune
from ladderlake.sources import (
    CSV_OPTIONS,
    land_json,
    landing_report,
    latest_per_key,
    next_page,
    not_yet_loaded,
    publish_changed,
    publish_values,
    publish_version,
    read_published,
    read_table,
    reject_empty,
    scan_json,
    write_bucketed,
    write_clustered,
    write_csv,
    write_table,
)
from ladderlake.stand_ins import COLS, table
from ladderlake.streaming import load_new_files, resume_points, track_pages

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

STANDINGS_SCHEMA = (
    "player_id bigint, player_name string, tier string, division string, "
    "points double, wins bigint, losses bigint"
)
EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)
# JSON text of a timestamp has milliseconds only, unless told otherwise.
MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

# Bounds of the match history, in epoch seconds: 1996 to 1998.
SINCE, UNTIL = 820454400, 915148799


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        run.__name__, run.__doc__ = name, function.__doc__
        REGISTRY[name] = run
        return function

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- ranking -----------------------------------------------------------------


@query("top_n_players")
def top_n_players(spark, sf_dir):
    """Best two players of every tier and division with at least 20 games."""
    return rounded(top_players(views.standings(spark, sf_dir), COLS), "win_percentage")


@query("rank_players")
def rank_players_all(spark, sf_dir):
    """Position of every player in the division."""
    return rounded(rank_players(views.standings(spark, sf_dir), COLS), "win_percentage")


def top_events(spark, sf_dir, n):
    events = table(spark, sf_dir, "events").select("event_type", "value", "event_id")
    order = [F.col("value").desc_nulls_last(), F.col("event_id").asc()]
    return top_n(events, ["event_type"], order, n)


@query("top_n_hundred")
def top_n_hundred(spark, sf_dir):
    """So many rows per group that they are cut twice."""
    return top_events(spark, sf_dir, 100)


@query("top_n_large")
def top_n_large(spark, sf_dir):
    """More rows per group than Spark cuts groups to by itself."""
    return top_events(spark, sf_dir, 1500)


# --- projections, filters ----------------------------------------------------


@query("win_rate")
def win_rate_all(spark, sf_dir):
    rate = win_rate("wins", "losses").alias("win_percentage")
    return rounded(
        views.standings(spark, sf_dir).select("player_id", "wins", "losses", rate),
        "win_percentage",
    )


@query("min_games_filter")
def min_games_filter(spark, sf_dir):
    return eligible(views.standings(spark, sf_dir), COLS)


@query("player_lookup")
def player_lookup(spark, sf_dir):
    return views.standings(spark, sf_dir).filter(F.col("player_name") == "red widget")


@query("names_to_players")
def names_to_players(spark, sf_dir):
    """Players for a list of names: those of all parts of the largest size."""
    part = table(spark, sf_dir, "part")
    names = part.filter(F.col("p_size") == 50).select(F.col("p_name").alias("player_name"))
    players = part.select(
        F.col("p_partkey").alias("player_id"), F.col("p_name").alias("player_name")
    )
    return resolve_names(names, players, "player_name").select("player_id", "player_name")


@query("project_cols")
def project_cols(spark, sf_dir):
    return views.facts(spark, sf_dir).select("match_id", "damage")


@query("tier_slice")
def tier_slice(spark, sf_dir):
    return views.standings(spark, sf_dir).filter(F.col("tier") == "PROMO")


# --- aggregates --------------------------------------------------------------


@query("count_by_tier")
def count_by_tier(spark, sf_dir):
    return count_by(views.standings(spark, sf_dir), "tier")


@query("distinct_players")
def distinct_players(spark, sf_dir):
    return distinct_count(views.facts(spark, sf_dir), "player_id", "player_count")


@query("distinct_tiers")
def distinct_tiers(spark, sf_dir):
    return distinct_values(views.standings(spark, sf_dir), "tier")


@query("row_count")
def row_count_all(spark, sf_dir):
    return row_count(views.facts(spark, sf_dir))


@query("describe_metric")
def describe_metric(spark, sf_dir):
    return rounded(describe(views.facts(spark, sf_dir), "damage"), "mean", "stddev", places=4)


@query("describe_strings")
def describe_figures_as_text(spark, sf_dir):
    """Text figures, read back as numbers to compare them."""
    text = describe_strings(views.facts(spark, sf_dir), "gold", "damage")
    return text.select(
        "summary",
        F.round(F.col("gold").cast("double"), 4).alias("gold"),
        F.round(F.col("damage").cast("double"), 4).alias("damage"),
    )


@query("describe_by_tier")
def describe_by_tier(spark, sf_dir):
    """Fact rows carry their tier; here flag and status together play it."""
    tier = F.concat("l_returnflag", "l_linestatus").alias("tier")
    facts = table(spark, sf_dir, "lineitem").select(tier, F.col("l_extendedprice").alias("damage"))
    return rounded(describe_by(facts, ["tier"], "damage"), "mean", "stddev", places=4)


@query("numeric_columns_profile")
def numeric_columns_profile(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    columns = columns_of_type(lineitem, "bigint", "double")
    return rounded(describe(lineitem, *columns), "mean", "stddev", places=4)


@query("null_percentages")
def null_percentages(spark, sf_dir):
    """Missing values after an outer explode; matches without players give nulls."""
    docs = views.match_docs(spark, sf_dir, views.brief_participant())
    return rounded(null_profile(match_facts(docs, list(views.brief_participant()), outer=True)), "null_pct")


@query("null_or_nan_count")
def null_or_nan_count(spark, sf_dir):
    """NaN counts as missing: here the values of all error events."""
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return rounded(null_profile(table(spark, sf_dir, "events").withColumn("value", value)), "null_pct")


@query("profile_states")
def profile_from_states(spark, sf_dir):
    """Figures of every event type out of stored states of its days, loaded in two lots.

    The second lot has one day of the first again. Distinct counts are estimates: whether they
    are within 5 % of the exact ones.
    """
    path, keys, columns = staging_path(spark, "states"), ["event_type"], ["value", "user_id", "props"]
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date").cast("string"))
    middle = events.agg(F.percentile_approx(F.unix_date(F.col("ts").cast("date")), 0.5)).first()[0]
    day = F.unix_date(F.col("ts").cast("date"))
    for lot in (day <= middle, day >= middle):
        states = update_profile(events.filter(lot), path, keys, "day", columns)
    figures = profile_figures(merge_states(states, keys), keys)
    exact = [F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("exact")) for c in columns]
    exact = events.groupBy(*keys).agg(*[x.alias(f"_{k}") for k, x in enumerate(exact)])
    exact = exact.select(*keys, F.inline(F.array("_0", "_1", "_2")))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.05 * F.col("exact")
    both = figures.join(exact.withColumnRenamed("event_type", "type"), (F.col("event_type").eqNullSafe(F.col("type"))) & (figures.column_name == exact.column_name))
    both = both.select(*keys, figures.column_name, "row_count", "n", "mean", "stddev", "min_value", "max_value", "null_count", close.alias("distinct_close"))
    return rounded(both, "mean", "stddev", places=4)


# --- unions ------------------------------------------------------------------


@query("union_tiers")
def union_tiers(spark, sf_dir):
    """Tiers read one by one from a table and put together again."""
    path = staging_path(spark, "tiers")
    write_table(views.standings(spark, sf_dir), path, partition_by=["tier"])
    stored = read_table(spark, path)
    # The values of a partition column: as many as the table has folders.
    tiers = [row.tier for row in stored.select("tier").distinct().collect()]
    own = lambda t: F.col("tier").isNull() if t is None else F.col("tier") == t
    return union_by_name([stored.filter(own(t)) for t in tiers])


@query("union_with_drift")
def union_with_drift(spark, sf_dir):
    """Other column order, and columns that one side lacks."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("acctbal"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"),
    )
    return union_by_name([suppliers, customers])


@query("union_same_layout")
def union_same_layout(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal")
    )
    return union_by_position([customers, suppliers])


# --- nested records ----------------------------------------------------------


@query("explode_participants")
def explode_participants(spark, sf_dir):
    docs = views.match_docs(spark, sf_dir, views.brief_participant())
    return match_facts(docs, list(views.brief_participant()))


@query("explode_outer_participants")
def explode_outer_participants(spark, sf_dir):
    docs = views.match_docs(spark, sf_dir, views.brief_participant())
    facts = match_facts(docs, list(views.brief_participant()), outer=True)
    facts = facts.withColumn("win", F.col("win").cast("int"))
    # Integers without a value show as -1; the other columns keep their nulls.
    return facts.fillna(-1, ["player_id", "slot", "win"])


@query("match_facts")
def match_facts_all_columns(spark, sf_dir):
    """All columns of the participant facts."""
    return match_facts(views.match_docs(spark, sf_dir, views.full_participant()))


def stored_docs(spark, sf_dir) -> str:
    """Match documents with all participant fields, as a columnar table."""
    docs = views.match_docs(spark, sf_dir, views.line_columns())
    path = staging_path(spark, "full-docs")
    return write_table(docs, path, finish=views.with_full_participants)


@query("match_facts_stored")
def match_facts_of_stored_docs(spark, sf_dir):
    """All columns of the participant facts, out of stored documents."""
    return match_facts(read_table(spark, stored_docs(spark, sf_dir)))


@query("explode_stored_docs")
def explode_stored_docs(spark, sf_dir):
    """Two fields out of nested documents in a columnar table."""
    path = staging_path(spark, "docs")
    docs = views.match_docs(spark, sf_dir, views.brief_participant())
    write_table(docs, path)
    stored = read_table(spark, path)
    match_id = F.col("metadata.matchId").alias("matchId")
    return explode_fields(stored, "info.participants", ["player_id", "damage"], [match_id])


# --- JSON --------------------------------------------------------------------


def landed_standings(spark, sf_dir) -> str:
    """Standings as JSON files, in one folder per tier and division."""
    df = views.standings(spark, sf_dir).withColumn("folder", partition_folder("tier", "division"))
    return land_json(df, staging_path(spark, "raw-standings"), ["folder"])


@query("json_scan_standings")
def json_scan_standings(spark, sf_dir):
    return scan_json(spark, landed_standings(spark, sf_dir), STANDINGS_SCHEMA)


@query("json_scan_inferred")
def json_scan_inferred(spark, sf_dir):
    return scan_json(spark, landed_standings(spark, sf_dir))


@query("json_roundtrip")
def json_roundtrip(spark, sf_dir):
    """JSON text to a struct, and a row with nulls to JSON text; they show as -1 besides."""
    k = F.when(F.col("event_id") % 10 > 0, decode_json("props", "k bigint").k).alias("k")
    return (
        table(spark, sf_dir, "events")
        .select("event_id", k)
        .withColumn("doc", encode_json("event_id", "k"))
        .fillna(-1, ["k"])
    )


@query("json_text_roundtrip")
def json_text_roundtrip(spark, sf_dir):
    """Whole texts survive encoding, characters beyond ASCII included."""
    docs = table(spark, sf_dir, "documents").select("doc_id", encode_json("text").alias("body"))
    return docs.select("doc_id", decode_json("body", "text string").text.alias("text"))


# --- tables ------------------------------------------------------------------


@query("table_scan")
def table_scan(spark, sf_dir):
    orders = read_table(spark, f"{sf_dir}/orders.parquet")
    return orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("overwrite_roundtrip")
def overwrite_roundtrip(spark, sf_dir):
    """A second write replaces rows and schema of the first."""
    path = staging_path(spark, "overwrite")
    standings = views.standings(spark, sf_dir)
    write_table(standings.select("tier", F.col("wins").cast("string").alias("wins")), path)
    write_table(standings, path)
    return read_table(spark, path)


@query("partition_overwrite")
def partition_overwrite(spark, sf_dir):
    """A second write replaces one tier and leaves the others."""
    path = staging_path(spark, "partitions")
    standings = views.standings(spark, sf_dir)
    keys = ["tier", "division"]
    write_table(standings, path, partition_by=keys)
    one_tier = standings.filter(F.col("tier") == "PROMO").withColumn("points", F.col("points") + 1)
    write_table(one_tier, path, partition_by=keys, replace="partitions")
    return rounded(read_table(spark, path), "points")


@query("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    path = write_csv(views.standings(spark, sf_dir), staging_path(spark, "csv"))
    return spark.read.schema(STANDINGS_SCHEMA).csv(path, header=True)


@query("csv_documents")
def csv_documents(spark, sf_dir):
    """Whole texts of many lines through CSV."""
    documents = table(spark, sf_dir, "documents")
    path = write_csv(documents, staging_path(spark, "csv"))
    return spark.read.schema(documents.schema).options(**CSV_OPTIONS).csv(path, header=True)


@query("table_layout")
def table_layout(spark, sf_dir):
    """A table in partitions, with files of the advisory size."""
    path = staging_path(spark, "layout")
    write_table(table(spark, sf_dir, "lineitem"), path, partition_by=["l_returnflag"])
    columns = ("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return read_table(spark, path).select(*columns)


@query("republish_shrunk")
def republish_shrunk(spark, sf_dir):
    """A tier that the source no longer has is gone from the published table too."""
    source, target = staging_path(spark, "tiers"), staging_path(spark, "published")
    standings = views.standings(spark, sf_dir)
    for rows in (standings, standings.filter("tier <> 'PROMO'")):
        write_table(rows, source, partition_by=["tier"])
        republish(spark, source, target, ["tier"])
    return read_table(spark, target)


@query("publish_changed")
def publish_changed_tiers(spark, sf_dir):
    """A second publication after one tier changed, one is gone and one is new."""
    target = staging_path(spark, "published")
    standings = views.standings(spark, sf_dir)
    wins = F.when(F.col("tier") == "PROMO", F.col("wins") + 1).otherwise(F.col("wins"))
    publish_changed(spark, standings.filter("tier <> 'ECONOMY'"), target, ["tier"])
    changed = standings.filter("tier <> 'STANDARD'").withColumn("wins", wins)
    actions = publish_changed(spark, changed, target, ["tier"])
    stored = read_table(spark, target).groupBy("tier").agg(F.sum("wins").alias("wins"))
    return actions.join(stored, "tier", "left").withColumn("wins", F.coalesce("wins", F.lit(0).cast("bigint")))


@query("published_versions")
def published_versions(spark, sf_dir):
    """One tier is published anew, out of the table itself, and another is emptied, each at once."""
    path = staging_path(spark, "versions")
    publish_version(views.standings(spark, sf_dir), path, ["tier"])
    before = read_published(spark, path)
    one_tier = before.filter("tier = 'PROMO'").withColumn("points", F.col("points") + 1)
    publish_values(one_tier, path, "tier", ["PROMO", "ECONOMY"])
    return rounded(read_published(spark, path), "points")


@query("partition_new_field")
def partition_new_field(spark, sf_dir):
    """A field that came with the reload of one tier is in silver; -1 where it is not."""
    bronze, silver = staging_path(spark, "field-b"), staging_path(spark, "field-s")
    df = views.standings(spark, sf_dir).withColumn("folder", partition_folder("tier", "division"))
    season = df.withColumn("season", F.col("wins") + 1)
    raw = land_json(df, staging_path(spark, "raw-standings"), ["folder"])
    newer = land_json(season, staging_path(spark, "raw-standings"), ["folder"])
    job = {"cols": COLS, "extra": None}
    standings_raw_to_bronze(spark, raw, bronze, schema=STANDINGS_SCHEMA, **job)
    standings_raw_to_bronze(
        spark, newer, bronze, ["PROMO"], schema=STANDINGS_SCHEMA + ", season bigint", **job
    )
    stored = standings_bronze_to_silver(spark, bronze, silver, cols=COLS)
    return stored.select("player_id", "tier", F.coalesce("season", F.lit(-1)).alias("season"))


@query("bronze_all_fields")
def bronze_all_fields(spark, sf_dir):
    """Fields that nobody declared, from the landed pages to the gold table."""
    sizes = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("player_id"), F.struct("p_size").alias("mini")
    )
    df = views.standings(spark, sf_dir).join(sizes, "player_id")
    df = df.withColumn("folder", partition_folder("tier", "division"))
    raw = land_json(df, staging_path(spark, "raw-standings"), ["folder"])
    bronze, silver, gold = (staging_path(spark, f"fields-{x}") for x in ("b", "s", "g"))
    standings_raw_to_bronze(spark, raw, bronze, cols=COLS, schema=STANDINGS_SCHEMA)
    standings_bronze_to_silver(spark, bronze, silver, cols=COLS)
    size = F.variant_get("record", F.lit("$.mini.p_size"), "bigint").alias("p_size")
    return standings_silver_to_gold(spark, silver, gold, cols=COLS).select(
        "player_id", "tier", "points", size
    )


def flawed_pages(spark, sf_dir) -> DataFrame:
    """A landed line ``value`` for every player, and its ``page``; some are no usable record.

    Page 1 is cut off and page 2 null. On page 3 a field does not fit its type, and on page 4
    neither does it in the second record of each array.
    """
    body = encode_json(*views.standings(spark, sf_dir).columns)
    pages = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("player_id"), F.col("p_size").alias("page")
    )
    lines = views.standings(spark, sf_dir).withColumn("body", body).join(pages, "player_id")
    misfit = F.regexp_replace("body", '"wins":[^,}]*', '"wins":"many"')
    value = F.when(F.col("page") == 1, F.expr("substr(body, 1, length(body) - 4)"))
    value = value.when(F.col("page") == 2, "null").when(F.col("page") == 3, misfit)
    value = value.when(F.col("page") == 4, F.format_string("[%s, %s]", "body", misfit))
    return lines.select("page", value.otherwise(F.col("body")).alias("value"))


def land_pages(spark, lines: DataFrame, raw: str) -> str:
    """The lines as files ``<page>.json``."""
    lot = staging_path(spark, "lot")
    lines.repartition("page").write.partitionBy("page").text(lot)
    system, folder = file_system(spark, raw), spark._jvm.org.apache.hadoop.fs.Path
    system.mkdirs(folder(raw))
    for page in [x.getPath() for x in system.listStatus(folder(lot))]:
        name = page.getName().partition("=")[2]
        for file in files_below(spark, page.toString()):
            system.rename(file, folder(f"{raw}/{name}.json"))
    return raw


@query("rejected_pages")
def rejected_pages(spark, sf_dir):
    """Pages landed with records that are no use among them: rows for each reason."""
    raw, bronze = staging_path(spark, "raw-pages"), staging_path(spark, "pages-b")
    flawed_pages(spark, sf_dir).select("value").write.text(raw)
    kept = standings_raw_to_bronze(
        spark, raw, bronze, cols=COLS, schema=STANDINGS_SCHEMA, extra=None, glob="part-*"
    )
    rejected = read_table(spark, f"{bronze}_rejects").groupBy("reason")
    return row_count(kept).withColumn("reason", F.lit("kept")).unionByName(
        rejected.agg(F.count("*").alias("row_count"))
    )


@query("load_accounting")
def load_accounting(spark, sf_dir):
    """What a load counted on its one pass, beside what its tables hold."""
    raw, bronze = staging_path(spark, "raw-pages"), staging_path(spark, "pages-b")
    land_pages(spark, flawed_pages(spark, sf_dir), f"{raw}/gold_I")
    kept = standings_raw_to_bronze(spark, raw, bronze, cols=COLS, schema=STANDINGS_SCHEMA)
    loads = read_table(spark, f"{bronze}_loads").drop("load_id", "at", "scope")
    stored = row_count(kept, "stored")
    rejected = row_count(read_table(spark, f"{bronze}_rejects"), "rejected")
    rows = union_by_name([loads, stored, rejected])
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


# --- landing -----------------------------------------------------------------


@query("scan_prefix")
def scan_prefix(spark, sf_dir):
    """Files below all folders with a common prefix."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", F.col("source").alias("folder")
    )
    root = land_json(documents, staging_path(spark, "raw-documents"), ["folder"])
    schema = "doc_id bigint, text string, source string"
    return scan_json(spark, f"{root}/folder=src1*", schema)


@query("scan_path_regex")
def scan_path_regex(spark, sf_dir):
    """Files whose path matches a search for a tier."""
    root = landed_standings(spark, sf_dir)
    return scan_json(spark, root, STANDINGS_SCHEMA, path_regex=r"(economy|small)_")


@query("path_normalize")
def path_normalize(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        tier_key("p_type").alias("tier_key"),
        page_path("p_type", "p_brand", "p_size").alias("page_path"),
        match_path("p_type", "p_partkey").alias("match_path"),
        digits("p_brand").alias("brand_digits"),
    )


def pages_by_host(spark, sf_dir) -> DataFrame:
    host = F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host")
    page = page_number("url", r"[?&]page=(\d+)").alias("page")
    return table(spark, sf_dir, "pages").select(host, page)


@query("next_page")
def next_page_by_host(spark, sf_dir):
    return next_page(pages_by_host(spark, sf_dir), ["host"], "page")


@query("landing_report")
def landing_report_by_host(spark, sf_dir):
    return landing_report(pages_by_host(spark, sf_dir), ["host"], "page")


PART_PAGES = {"folder_pattern": r"/folder=([^/]+)/", "page_pattern": r"/page=(\d+)/"}


def part_pages(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Rows of parts by landing folder and page, and the folders to expect.

    One tier has landed nothing, another is not expected, and the pages of a third are
    landed under its name and an alias.
    """
    part = table(spark, sf_dir, "part")
    page = F.floor(F.col("p_size") / 10).cast("int").alias("page")
    alias = F.when(F.col("p_size") % 2 == 0, "platina").otherwise("platinum")
    folder = F.when(F.col("p_type") == "STANDARD", alias).otherwise(tier_key("p_type"))
    rows = part.select("p_partkey", "p_name", folder.alias("folder"), page)
    tiers = part.filter("p_type <> 'PROMO'").select(tier_key("p_type").alias("folder")).distinct()
    tiers = tiers.filter("folder <> 'standard'")
    return rows, tiers.union(spark.createDataFrame([("none",), ("platina",)], "folder string"))


def page_counts(status: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return status.select(
        "folder",
        "next_page",
        F.coalesce("page_count", zero).alias("page_count"),
        F.coalesce("absent_pages", zero).alias("absent_pages"),
    )


@query("landing_status")
def landing_status_of_parts(spark, sf_dir):
    """Resume points from the names of landed files."""
    rows, expected = part_pages(spark, sf_dir)
    root = land_json(rows, staging_path(spark, "raw-parts"), ["folder", "page"])
    return page_counts(landing_status(spark, root, expected, **PART_PAGES))


@query("landing_status_by_tasks")
def landing_status_listed_by_tasks(spark, sf_dir):
    """The same from names that a task for each folder lists."""
    rows, expected = part_pages(spark, sf_dir)
    root = land_json(rows, staging_path(spark, "raw-parts"), ["folder", "page"])
    return page_counts(landing_status(spark, root, expected, levels=1, **PART_PAGES))


@query("resume_points")
def resume_points_of_parts(spark, sf_dir):
    """The same out of the state of a stream, after two landings and a run without news."""
    rows, expected = part_pages(spark, sf_dir)
    root, status, checkpoint = (staging_path(spark, f"parts-{x}") for x in ("raw", "status", "state"))
    for lot in ("page in (1, 3)", "page not in (1, 3)", None):
        if lot:
            land_json(rows.filter(lot), root, ["folder", "page"])
        track_pages(spark, root, status, checkpoint, **PART_PAGES)
    return page_counts(resume_points(spark, status, expected))


@query("landing_dedup")
def landing_dedup(spark, sf_dir):
    """Newest event of every (type, user)."""
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    latest = latest_per_key(table(spark, sf_dir, "events"), ["event_type", "user_id"], order)
    return latest.select("event_type", "user_id", "event_id", "value")


@query("incremental_pages")
def incremental_pages(spark, sf_dir):
    """Events landed in two lots and loaded in three runs, the last without news."""
    raw, loaded = staging_path(spark, "raw-events"), staging_path(spark, "events")
    checkpoint = staging_path(spark, "events-checkpoint")
    events = table(spark, sf_dir, "events").withColumn("folder", F.col("event_type"))
    early = F.coalesce(F.col("event_type").isin("click", "view"), F.lit(False))
    for lot in (events.filter(early), events.filter(~early)):
        land_json(lot, raw, ["folder"], MICROS)
        load_new_files(spark, raw, loaded, checkpoint, EVENT_SCHEMA, options=MICROS)
    load_new_files(spark, raw, loaded, checkpoint, EVENT_SCHEMA, options=MICROS)
    return read_table(spark, loaded).drop("source_file", "load_batch")


@query("late_files")
def late_files(spark, sf_dir):
    """Two lots of events; the files of the second are years older, one of them from 1970."""
    raw, loaded = staging_path(spark, "raw-events"), staging_path(spark, "events")
    checkpoint = staging_path(spark, "events-checkpoint")
    events = table(spark, sf_dir, "events").withColumn("folder", F.col("event_type"))
    old = F.coalesce(F.col("event_type").isin("click", "view"), F.lit(False))
    land_json(events.filter(~old), raw, ["folder"], MICROS)
    load_new_files(spark, raw, loaded, checkpoint, EVENT_SCHEMA, options=MICROS)
    land_json(events.filter(old), raw, ["folder"], MICROS)
    late = [f for name in ("click", "view") for f in files_below(spark, f"{raw}/folder={name}")]
    for k, file in enumerate(late):
        file_system(spark, raw).setTimes(file, 1_500_000_000_000 if k else 86_400_000, -1)
    load_new_files(spark, raw, loaded, checkpoint, EVENT_SCHEMA, options=MICROS)
    return read_table(spark, loaded).drop("source_file", "load_batch")


def file_system(spark, path):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration())


def files_below(spark, path) -> list:
    """The few part files of one written folder, as paths of the file system."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = file_system(spark, path)
    if not system.exists(root):
        return []
    found = [x.getPath() for x in system.listStatus(root)]
    return [x for x in found if x.getName().startswith("part-")]


@query("incremental_ledger")
def incremental_ledger(spark, sf_dir):
    """Landed events that the ledger of loaded (type, user) keys does not name."""
    events = table(spark, sf_dir, "events")
    ledger = events.filter(F.col("value") > 50).select("event_type", "user_id").distinct()
    return not_yet_loaded(events, ledger, ["event_type", "user_id"]).select(
        "event_id", "event_type", "user_id"
    )


# --- lookups -----------------------------------------------------------------


def best_players(spark, sf_dir) -> DataFrame:
    return top_players(views.standings(spark, sf_dir), COLS)


@query("lookup_chain")
def lookup_chain_of_top_players(spark, sf_dir):
    """Top players to account ids to their matches to match records."""
    account = F.concat(F.lit("acc-"), F.col("p_partkey").cast("string")).alias("account_id")
    ids = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("player_id"), account)
    played = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("acc-"), F.col("l_partkey").cast("string")).alias("account_id"),
        F.col("l_orderkey").alias("match_id"),
    )
    players = best_players(spark, sf_dir).select("tier", "division", "player_id", "rn")
    chain = lookup_chain(players, ids, played, views.matches(spark, sf_dir))
    return chain.select(
        "tier", "division", "player_id", "rn", "account_id", "match_id", "match_type", "total"
    )


@query("lookup_chain_bucketed")
def lookup_chain_over_buckets(spark, sf_dir):
    """The chain over a history and matches that are stored in buckets of their keys."""
    account = F.concat(F.lit("acc-"), F.col("p_partkey").cast("string")).alias("account_id")
    ids = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("player_id"), account)
    played = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("acc-"), F.col("l_partkey").cast("string")).alias("account_id"),
        F.col("l_orderkey").alias("match_id"),
    )
    paths = [staging_path(spark, name) for name in ("history", "matches")]
    names = [path.rsplit("/", 1)[1].replace("-", "_") for path in paths]
    history = write_bucketed(played, names[0], ["account_id"], 16, paths[0])
    matches = write_bucketed(views.matches(spark, sf_dir), names[1], ["match_id"], 16, paths[1])
    players = best_players(spark, sf_dir).select("tier", "division", "player_id", "rn")
    return lookup_chain(players, ids, history, matches).select(
        "tier", "division", "player_id", "rn", "account_id", "match_id", "match_type", "total"
    )


@query("clustered_box")
def clustered_box(spark, sf_dir):
    """A box of dates and prices, and the parts of some names, out of a clustered table."""
    items = table(spark, sf_dir, "lineitem").withColumn("name", F.concat(F.lit("n"), F.col("l_partkey").cast("string")))
    path = write_clustered(items, staging_path(spark, "clustered"), ["l_shipdate", "l_extendedprice"], ["name"], files=8)
    stored = read_table(spark, path)
    box = F.col("l_shipdate").between("1996-03-01", "1996-06-30") & F.col("l_extendedprice").between(20000, 30000)
    named = F.col("name").isin("n7", "n77")
    return stored.filter(box | named).select("l_orderkey", "l_linenumber", "name", "l_extendedprice")


@query("recent_matches_per_player")
def recent_matches_per_player(spark, sf_dir):
    """Newest 20 urgent matches of every supplier in 1996 to 1998."""
    history = views.history(spark, sf_dir, "l_suppkey")
    return recent_per_player(history, wanted_type="1-URGENT", since=SINCE, until=UNTIL).select(
        "player_id", "match_id", "rn"
    )


@query("matches_of_top_players")
def matches_of_top_players(spark, sf_dir):
    """Matches with a division's best player in them."""
    best = best_players(spark, sf_dir).filter(F.col("rn") == 1)
    matches = views.matches(spark, sf_dir).select("match_id", "match_type", "total")
    return matches_of_players(matches, views.facts(spark, sf_dir), best)


# --- inspection --------------------------------------------------------------


@query("schema_report")
def schema_report_lineitem(spark, sf_dir):
    return schema_report(table(spark, sf_dir, "lineitem"), figures=True)


def unprefixed(spark, sf_dir, name: str) -> DataFrame:
    """Table without the letter prefix of its columns."""
    df = table(spark, sf_dir, name)
    return df.toDF(*[c.split("_", 1)[1] for c in df.columns])


@query("schema_drift")
def schema_drift_by_table(spark, sf_dir):
    names = ("customer", "nation", "part", "region", "supplier")
    return schema_drift({n: unprefixed(spark, sf_dir, n) for n in names}, figures=True)


def drifting_bronze(spark, sf_dir) -> DataFrame:
    """Bronze standings whose pages have fields that nobody declared, of types that vary.

    A season is a text in one tier, a rate has digits behind the point on every second page,
    and small pages have no ``mini``.
    """
    body = encode_json(*views.standings(spark, sf_dir).columns)
    size = F.col("p_size").cast("string")
    sizes = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("player_id"), "p_size")
    season = F.when(F.col("tier") == "PROMO", F.concat(F.lit('"s'), size, F.lit('"'))).otherwise(size)
    rate = F.when(F.col("p_size") % 2 == 0, size).otherwise(F.concat(size, F.lit(".5")))
    mini = F.when(F.col("p_size") > 10, F.concat(F.lit(',"mini":{"size":'), size, F.lit("}")))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).cast("string")
    lines = views.standings(spark, sf_dir).join(sizes, "player_id").select(
        F.concat(
            F.regexp_replace(body, r"\}$", ""),
            F.lit(',"season":'), season, F.lit(',"rate":'), rate, F.coalesce(mini, F.lit("")),
            F.lit(',"landed_on":"'), day, F.lit('"}'),
        )
    )
    raw, bronze = staging_path(spark, "raw-drift"), staging_path(spark, "drift-b")
    lines.write.text(raw)
    schema = STANDINGS_SCHEMA + ", landed_on string"
    return standings_raw_to_bronze(spark, raw, bronze, cols=COLS, schema=schema, glob="part-*")


@query("variant_drift")
def variant_drift(spark, sf_dir):
    """Types, rows and first day of undeclared fields in every tier; clashes are named."""
    bronze = drifting_bronze(spark, sf_dir)
    declared = [c for c in bronze.columns if c != "record"]
    return record_drift(bronze, ["tier"], day="landed_on", declared=declared)


@query("variant_drift_across")
def variant_drift_across(spark, sf_dir):
    """Undeclared fields over all tiers: who has them, and the type that holds them all."""
    bronze = drifting_bronze(spark, sf_dir)
    declared = [c for c in bronze.columns if c != "record"]
    drift = record_drift(bronze, ["tier"], declared=declared)
    return drift_across(drift, "tier", expected=5)


@query("variant_schemas")
def variant_schemas(spark, sf_dir):
    """Whether the merged schema of a tier's records clashes, and its type of one field."""
    merged = record_schemas(drifting_bronze(spark, sf_dir), ["tier"])
    season = F.regexp_extract("record_schema", r"season: (\w+)", 1).alias("season")
    return merged.select("tier", "row_count", season, F.col("record_schema").contains("VARIANT").alias("clashes"))


@query("union_widened")
def union_of_types(spark, sf_dir):
    """Columns of other types in each table: numbers widen, clashing types become text."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_nationkey").cast("int").alias("nation"), F.col("c_acctbal").alias("amount")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("key"), F.col("s_nationkey").cast("bigint").alias("nation"), F.lit("s").alias("kind")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderkey").alias("amount"), F.col("o_orderstatus").alias("kind")
    )
    return rounded(union_widened([customers, suppliers, orders]), "amount", places=4)


@query("preview")
def preview_standings(spark, sf_dir):
    return preview(views.standings(spark, sf_dir), ["tier", "division", "player_id"])


# --- jobs --------------------------------------------------------------------


@query("job_standings_gold")
def job_standings_gold(spark, sf_dir):
    """Landed standings through bronze and silver to the gold table."""
    raw = landed_standings(spark, sf_dir)
    bronze, silver, gold = (staging_path(spark, f"standings-{x}") for x in ("b", "s", "g"))
    standings_raw_to_bronze(spark, raw, bronze, cols=COLS, schema=STANDINGS_SCHEMA, extra=None)
    standings_bronze_to_silver(spark, bronze, silver, cols=COLS)
    return standings_silver_to_gold(spark, silver, gold, cols=COLS)


@query("job_all_tiers")
def job_all_tiers(spark, sf_dir):
    """Landed standings to one table of all tiers; the first tiers are loaded once more."""
    raw = landed_standings(spark, sf_dir)
    bronze, silver, gold = (staging_path(spark, f"all-{x}") for x in ("b", "s", "g"))
    job = {"cols": COLS, "schema": STANDINGS_SCHEMA, "extra": None}
    loaded = standings_raw_to_bronze(spark, raw, bronze, **job)
    standings_bronze_to_silver(spark, bronze, silver, cols=COLS)
    # The values of a partition column: as many as the table has folders.
    known = loaded.filter("tier is not null").select("tier").distinct().orderBy("tier")
    tiers = [row.tier for row in known.collect()][:2]
    standings_raw_to_bronze(spark, raw, bronze, tiers, **job)
    standings_bronze_to_silver(spark, bronze, silver, tiers, cols=COLS)
    return standings_all_tiers(spark, silver, gold, cols=COLS)


def match_body():
    """Payload text of a match document; without participants it is ``null``."""
    unplayed = F.col("info.participants").isNull()
    return F.when(unplayed, F.lit("null")).otherwise(encode_json("metadata", "info"))


def landed_matches(spark, sf_dir) -> str:
    """Match payloads as text lines; matches without players land as ``null``.

    Every payload is landed twice; the first landing knows no participants and the second
    replaces it.
    """
    docs = views.gathered(spark, sf_dir, views.landed_participant())
    docs = docs.select(F.col("matchId").alias("match_id"), "part", *views.document())
    payloads = docs.select(
        "match_id",
        "part",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("seq"), F.lit('{"info":{"participants":[]}}').alias("body")),
                F.struct(F.lit(2).alias("seq"), match_body().alias("body")),
            )
        ).alias("landing"),
    ).select("match_id", "part", "landing.seq", "landing.body")
    last = land_matches(payloads, ["match_id", "part"], [F.col("seq").desc()])
    path = staging_path(spark, "raw-matches")
    # A file is read by one task, and has the lines of one: their number is bounded.
    with dropping_shuffles(spark):
        last.select("body").write.text(path, compression="gzip")
    return path


@query("job_match_gold")
def job_match_gold(spark, sf_dir):
    """Landed matches to bronze participant rows, then published.

    The counts that no record has are null in the table and shown as -1.
    """
    raw = landed_matches(spark, sf_dir)
    bronze, gold = staging_path(spark, "matches-b"), staging_path(spark, "matches-g")
    match_raw_to_bronze(spark, raw, bronze, glob="part-*")
    return republish(spark, bronze, gold).fillna(-1, list(MATCH_COUNT_FIELDS))


def order_match(version: int):
    """Payload of an order as a match of ``version`` participants; its status is the tier."""
    participants = F.array(
        *[
            F.struct(
                F.concat(F.lit(f"p{k}-"), F.col("o_custkey").cast("string")).alias("puuid"),
                (F.floor("o_totalprice") + k).alias("goldEarned"),
            )
            for k in range(version)
        ]
    )
    info = F.struct(participants.alias("participants")).alias("info")
    key = F.struct(F.col("o_orderkey").cast("string").alias("matchId")).alias("metadata")
    return encode_json(key, info)


def land_order_matches(spark, orders: DataFrame, raw: str, version: int) -> None:
    """Payloads in files ``<tier>_<n>.json``; later versions have later file times."""
    rows = orders.select(F.lower("o_orderstatus").alias("tier"), order_match(version).alias("body"))
    written = staging_path(spark, "lot")
    rows.hint("rebalance", "tier").write.partitionBy("tier").text(written)
    system = file_system(spark, raw)
    folder = spark._jvm.org.apache.hadoop.fs.Path
    system.mkdirs(folder(raw))
    for tier in [x.getPath() for x in system.listStatus(folder(written))]:
        name = tier.getName().partition("=")[2]
        for k, file in enumerate(files_below(spark, tier.toString())):
            target = folder(f"{raw}/{name}_{version}{k:05}.json")
            system.rename(file, target)
            system.setTimes(target, 1_700_000_000_000 + 1000 * version, -1)


MATCH_FIELDS = ("puuid", "goldEarned")


@query("matches_by_tier")
def matches_by_tier(spark, sf_dir):
    """All tiers loaded, then one landed and loaded anew: each with its newest payloads."""
    raw, bronze = staging_path(spark, "raw-orders"), staging_path(spark, "orders-b")
    orders = table(spark, sf_dir, "orders")
    job = {"fields": MATCH_FIELDS, "with_tier": True, "latest_only": True}
    land_order_matches(spark, orders, raw, 1)
    match_raw_to_bronze(spark, raw, bronze, **job)
    land_order_matches(spark, orders, raw, 2)
    loaded = match_raw_to_bronze(spark, raw, bronze, tier="F", **job)
    return loaded.select("tier", "matchId", *MATCH_FIELDS)


@query("matches_relanded")
def matches_relanded(spark, sf_dir):
    """Every second match is landed again; its newest payload counts."""
    raw, bronze = staging_path(spark, "raw-orders"), staging_path(spark, "orders-b")
    orders = table(spark, sf_dir, "orders")
    land_order_matches(spark, orders, raw, 1)
    land_order_matches(spark, orders.filter("o_orderkey % 2 = 0"), raw, 2)
    loaded = match_raw_to_bronze(
        spark, raw, bronze, fields=MATCH_FIELDS, with_tier=True, latest_only=True
    )
    return loaded.select("tier", "matchId", *MATCH_FIELDS)


@query("matches_merged")
def matches_merged(spark, sf_dir):
    """Both landings of ``matches_relanded``, each merged into the newest payloads as it comes."""
    raw, bronze = staging_path(spark, "raw-orders"), staging_path(spark, "orders-m")
    checkpoint = staging_path(spark, "orders-checkpoint")
    orders = table(spark, sf_dir, "orders")
    for version, lot in ((1, orders), (2, orders.filter("o_orderkey % 2 = 0"))):
        land_order_matches(spark, lot, raw, version)
        merged = match_merge_to_bronze(spark, raw, bronze, checkpoint, MATCH_FIELDS, buckets=16)
    return merged.select("tier", "matchId", *MATCH_FIELDS)


@query("incremental_matches")
def incremental_matches(spark, sf_dir):
    """Matches landed in two lots; each run explodes only the new files."""
    raw, loaded = staging_path(spark, "raw-lots"), staging_path(spark, "lots")
    checkpoint = staging_path(spark, "lots-checkpoint")
    # Stored, so that both lots are cut from the same documents.
    docs = materialize(views.match_docs(spark, sf_dir, views.landed_participant()), "docs")
    fields = list(views.landed_participant())
    small = F.coalesce(F.size("info.participants") <= 3, F.lit(True))
    for lot in (docs.filter(small), docs.filter(~small)):
        lot.select(match_body()).write.mode("append").text(raw, compression="gzip")
        load_new_files(
            spark,
            raw,
            loaded,
            checkpoint,
            match_schema(fields),
            glob="part-*",
            file_column=None,
            transform=lambda new: match_facts(new, fields),
        )
    return read_table(spark, loaded).drop("load_batch")


@query("incremental_rejects")
def incremental_rejects(spark, sf_dir):
    """Pages that are no use among two landed lots: rows for each reason, and those observed."""
    raw, loaded = staging_path(spark, "raw-pages"), staging_path(spark, "pages")
    checkpoint = staging_path(spark, "pages-checkpoint")
    lines = flawed_pages(spark, sf_dir)
    for lot in (lines.filter("page % 2 = 0"), lines.filter("page % 2 = 1")):
        lot.select("value").write.mode("append").text(raw)
        load_new_files(spark, raw, loaded, checkpoint, STANDINGS_SCHEMA, glob="part-*")
    load_new_files(spark, raw, loaded, checkpoint, STANDINGS_SCHEMA, glob="part-*")
    reasons = read_table(spark, f"{loaded}_rejects").select("reason")
    rows = read_table(spark, loaded).select(F.lit("kept").alias("reason")).unionByName(reasons)
    stored = rows.groupBy("reason").agg(F.count("*").alias("row_count"))
    kinds = ("kept", "misfit", "broken", "empty")
    counts = read_table(spark, f"{loaded}_loads").agg(*[F.sum(k).alias(k) for k in kinds])
    pairs = F.array(*[F.struct(F.lit(k).alias("reason"), F.col(k).alias("observed")) for k in kinds])
    return stored.join(counts.select(F.inline(pairs)), "reason", "full")


@query("rejected_matches")
def rejected_matches(spark, sf_dir):
    """How many landed matches are kept, and how many are empty records."""
    docs = scan_json(spark, landed_matches(spark, sf_dir), match_schema(["win"]), "part-*")
    kept, rejected = reject_empty(docs)
    # A match may be landed in several documents; count it once.
    kept = kept.select(F.col("metadata.matchId").alias("match_id")).distinct()
    counts = {"kept": row_count(kept), "rejected": row_count(rejected)}
    return union_by_name([df.withColumn("status", F.lit(s)) for s, df in counts.items()])


@query("job_top_matches")
def job_top_matches(spark, sf_dir):
    """From the standings to the participants of the top players' recent matches."""
    wanted = select_matches(
        views.standings(spark, sf_dir),
        views.history(spark, sf_dir),
        COLS,
        wanted_type="1-URGENT",
        since=SINCE,
        until=UNTIL,
    ).withColumn("match_id", F.col("match_id").cast("string"))
    fields = list(views.landed_participant())
    docs, _ = reject_empty(
        scan_json(spark, landed_matches(spark, sf_dir), match_schema(fields), "part-*")
    )
    path = staging_path(spark, "top-matches")
    write_table(top_match_facts(wanted, docs, fields), path, partition_by=["tier"])
    return read_table(spark, path)


@query("job_passthrough")
def job_passthrough(spark, sf_dir):
    """Whole records, no field touched."""
    conversations = table(spark, sf_dir, "conversations")
    raw = land_json(conversations, staging_path(spark, "raw-conversations"))
    bronze = staging_path(spark, "conversations")
    return whole_records_to_bronze(spark, raw, bronze, conversations.schema)


@query("job_passthrough_variant")
def job_passthrough_variant(spark, sf_dir):
    """Whole records in one variant column; fields are taken out on reading."""
    raw = land_json(
        table(spark, sf_dir, "conversations"), staging_path(spark, "raw-conversations")
    )
    bronze = staging_path(spark, "conversations")
    records = whole_records_to_bronze(spark, raw, bronze, as_variant=True)
    fields = {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}
    return records.select(
        *[F.variant_get("record", F.lit(f"$.{n}"), t).alias(n) for n, t in fields.items()]
    )
