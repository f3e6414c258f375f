"""Queries over tables in which one key holds a third of the rows, without broadcasts."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F
from test_oracle import bag

from ladderlake import stand_ins as views
from ladderlake.oracle import SQL
from ladderlake.queries import REGISTRY

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.files.maxPartitionBytes": "256k",
}

HOT = {
    "part": """select p_partkey, p_name, p_size, p_retailprice,
        case when p_partkey % 3 = 0 then 'Brand#1' else p_brand end as p_brand,
        case when p_partkey % 3 = 0 then 'PROMO' else p_type end as p_type from part""",
    "lineitem": """select
        case when i % 3 = 0 then 3 else l_orderkey end as l_orderkey,
        case when i % 3 = 1 then 7 else l_partkey end as l_partkey,
        case when i % 3 = 2 then 5 else l_suppkey end as l_suppkey,
        l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
        l_linestatus, l_shipdate
        from (select *, row_number() over () as i from lineitem)""",
    "events": """select event_id, ts, case when event_id % 3 = 0 then 1 else user_id end as user_id,
        case when event_id % 3 = 0 then 'click' else event_type end as event_type, value, props
        from events""",
}

NAMES = (
    "top_n_players",
    "rank_players",
    "describe_by_tier",
    "null_percentages",
    "explode_outer_participants",
    "landing_dedup",
    "incremental_ledger",
    "incremental_pages",
    "partition_overwrite",
    "lookup_chain",
    "recent_matches_per_player",
    "matches_of_top_players",
    "job_top_matches",
)


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    """A connection to the skewed tables, their folder, and settings that shuffle."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    source = duckdb.connect()
    names = [f.removesuffix(".parquet") for f in sorted(os.listdir(sf_dir))]
    for name in names:
        source.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    con = duckdb.connect()
    for name in names:
        sql, path = HOT.get(name, f"select * from {name}"), f"{folder}/{name}.parquet"
        source.execute(f"copy ({sql}) to '{path}' (format parquet, row_group_size 5000)")
        con.execute(f"create view {name} as select * from '{path}'")
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield con, folder
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_tables_give_whole_results(spark, skewed, name):
    con, folder = skewed
    df = REGISTRY[name](spark, folder)
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    actual = [tuple(row) for row in df.collect()]
    assert len(actual) == len(expected) > 0
    assert bag(df.columns, actual) == bag(columns, expected)


def test_a_hot_match_is_split_in_a_join(spark, skewed):
    _, folder = skewed
    df = views.facts(spark, folder).join(views.matches(spark, folder), "match_id")
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_copies_of_a_pair_collapse_before_the_shuffle(spark, skewed):
    """The hot match is no longer hot once its players are told apart."""
    con, folder = skewed
    rows, hot = con.execute(
        "select count(*), count(*) filter (where l_orderkey = 3) from lineitem"
    ).fetchone()
    assert hot * 3 >= rows
    history = views.history(spark, folder)
    assert history.filter("match_id = 3").count() * 10 < history.count()


def test_orders_without_lines_are_dealt_to_tasks_by_their_number(spark, tmp_path, monkeypatch):
    """A third of all lines is of one order; keys are null and come twice."""
    monkeypatch.setattr(views, "_TASK_BITS", 10, raising=False)
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 4000)
    key = F.when(F.col("id") != 5, hot).cast("bigint").alias("l_orderkey")
    spark.range(12_000).select(key, F.col("id").alias("l_partkey")).write.parquet(f"{tmp_path}/lineitem.parquet")
    twice = spark.range(8_000).select(F.when(F.col("id") > 0, F.col("id")).alias("o_orderkey"))
    twice.union(twice).write.parquet(f"{tmp_path}/orders.parquet")
    docs = views.match_docs(spark, str(tmp_path), {"player_id": F.col("l_partkey")})
    unplayed = docs.filter("info.participants is null").withColumn("task", F.spark_partition_id())
    found = [(r.metadata.matchId, r.task) for r in unplayed.collect()]
    lined = {7} | {i % 4000 for i in range(12_000) if i % 3 and i != 5}
    expected = [None if i == 0 else str(i) for i in range(8_000) if i == 0 or i not in lined]
    assert sorted(map(str, [k for k, _ in found])) == sorted(map(str, expected * 2))
    assert len({task for _, task in found}) > 20
