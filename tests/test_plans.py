"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from ladderlake import stand_ins as views
from ladderlake.operators import explode_fields, null_profile, recent_per_player, top_players
from ladderlake.queries import REGISTRY
from ladderlake.schemas import match_schema
from ladderlake.session import staging_path
from ladderlake.sources import scan_json


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_and_no_pairing_of_all_rows(spark, name):
    text = plan(REGISTRY[name](spark, "/root/testdata/sf0.001"))
    for operator in ("Python", "Cartesian", "BroadcastNestedLoop", "MapInPandas"):
        assert operator not in text


def test_groups_are_cut_before_the_shuffle(spark, sf_dir):
    for df in (
        top_players(views.standings(spark, sf_dir), views.COLS),
        recent_per_player(views.history(spark, sf_dir)),
        REGISTRY["landing_dedup"](spark, sf_dir),
    ):
        text = plan(df)
        assert "Partial" in text.split("WindowGroupLimit")[2]
        assert text.index("Final") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_line_items_are_counted_before_the_join(spark, sf_dir):
    text = plan(views.standings(spark, sf_dir))
    assert text.index("Join") < text.index("HashAggregate")


def test_outer_join_is_dropped_where_only_players_count(spark, sf_dir):
    assert "lineitem.parquet" not in plan(REGISTRY["count_by_tier"](spark, sf_dir))


def test_period_and_columns_reach_the_scan(spark, sf_dir):
    df = recent_per_player(views.history(spark, sf_dir, "l_suppkey"), wanted_type="1-URGENT")
    text = df._jdf.queryExecution().executedPlan().toString()
    orders = next(line for line in text.splitlines() if "o_orderdate" in line and "FileScan" in line)
    assert "o_totalprice" not in orders
    assert "o_orderdate" in orders.split("DataFilters")[1]


def test_explode_reads_only_the_named_fields(spark, sf_dir):
    path = staging_path(spark, "docs")
    views.match_docs(spark, sf_dir, views.brief_participant()).write.parquet(path)
    df = explode_fields(spark.read.parquet(path), "info.participants", ["gold", "slot"])
    schema = re.search(r"ReadSchema: (\S+)", df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )).group(1)
    assert "gold" in schema and "slot" in schema
    assert "damage" not in schema and "metadata" not in schema


def test_declared_schema_needs_no_pass_over_the_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"metadata": {"matchId": "1"}}')
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    scan_json(spark, str(tmp_path), match_schema())
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == list(before)


def test_files_outside_the_path_search_are_not_opened(spark, tmp_path):
    for tier in ("gold", "silver", "bronze"):
        for i in range(4):
            (tmp_path / f"{tier}_{i}.json").write_text('{"a": 1}')
    df = scan_json(spark, str(tmp_path), "a int", path_regex=r"/gold_[^/]*$")
    assert len(df.collect()) == 4
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() == 4


def test_profile_is_one_scan(spark, sf_dir):
    text = plan(null_profile(views.table(spark, sf_dir, "lineitem")))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_tier_filter_prunes_partitions(spark, sf_dir):
    text = plan(REGISTRY["union_tiers"](spark, sf_dir).filter(F.col("tier") == "PROMO"))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert len(filters) == 1 and "PROMO" in filters[0]


def test_choice_of_players_comes_before_the_history_is_built(spark, sf_dir):
    best = top_players(views.standings(spark, sf_dir), views.COLS).select("player_id")
    narrowed = views.history(spark, sf_dir).join(best.distinct(), "player_id", "left_semi")
    tree = narrowed._jdf.queryExecution().optimizedPlan().toString()
    lines = tree.splitlines()
    depth = {name: min(i for i, line in enumerate(lines) if name in line) for name in ("LeftSemi", "Aggregate")}
    assert depth["Aggregate"] < depth["LeftSemi"]
