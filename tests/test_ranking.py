import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ladderlake.operators import number_rows, top_n, top_players
from ladderlake.operators.ranking import eligible, rank_players
from ladderlake.schemas import StandingsColumns

COLS = StandingsColumns()
SCHEMA = "tier string, rank string, summonerId string, leaguePoints bigint, wins bigint, losses bigint"


def test_threshold_is_20_games_and_null_drops(spark):
    rows = [
        ("GOLD", "I", "a", 10, 10, 9),
        ("GOLD", "I", "b", 10, 10, 10),
        ("GOLD", "I", "c", 10, 10, 11),
        ("GOLD", "I", "d", 10, None, 30),
        ("GOLD", "I", "e", 10, 0, 0),
    ]
    df = eligible(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.summonerId for r in df.collect()) == ["b", "c"]


def test_top_players_order_and_ties(spark):
    rows = [
        ("GOLD", "I", "low", 1, 20, 0),
        ("GOLD", "I", "z", 9, 10, 10),
        ("GOLD", "I", "y", 9, 10, 10),
        ("GOLD", "I", "better_rate", 9, 15, 5),
        ("GOLD", "I", "no_points", None, 20, 0),
        ("GOLD", "II", "x", 5, 20, 20),
    ]
    got = top_players(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["rank"], r.rn, r.summonerId) for r in got) == [
        ("I", 1, "better_rate"),
        ("I", 2, "y"),
        ("II", 1, "x"),
    ]


def test_rank_without_games_comes_last(spark):
    rows = [("GOLD", "I", "none", 5, 0, 0), ("GOLD", "I", "one", 5, 0, 1)]
    got = {r.summonerId: (r.rn, r.win_percentage) for r in rank_players(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"one": (1, 0.0), "none": (2, None)}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, and null groups."""
    rng = random.Random(7)
    rows = []
    for i in range(30_000):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((group, rng.choice([None, *range(50)]), i))
    return spark.createDataFrame(rows, "g string, v bigint, id bigint").cache()


def order():
    return [F.col("v").desc_nulls_last(), F.col("id").asc()]


def test_number_rows_equals_a_window(spark, skewed):
    got = number_rows(skewed, ["g"], order()).select("g", "v", "id", "rn")
    window = Window.partitionBy("g").orderBy(*order())
    want = skewed.withColumn("rn", F.row_number().over(window).cast("bigint"))
    assert got.count() == skewed.count()
    assert got.exceptAll(want).count() == 0


def test_number_rows_spreads_a_hot_group(spark, skewed):
    """The hot group is sorted in several tasks."""
    keys = [F.col("g").asc(), *order()]
    parts = (
        skewed.repartitionByRange(8, *keys)
        .withColumn("part", F.spark_partition_id())
        .filter("g = 'hot'")
        .groupBy("part")
        .count()
        .collect()
    )
    assert len(parts) >= 3
    plan = number_rows(skewed, ["g"], order())._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_numbers_have_no_gaps(skewed):
    spans = (
        number_rows(skewed, ["g"], order())
        .groupBy("g")
        .agg(F.min("rn").alias("lo"), F.max("rn").alias("hi"), F.count_distinct("rn").alias("n"))
    )
    assert all(r.lo == 1 and r.hi == r.n for r in spans.collect())


def test_number_rows_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, v bigint, id bigint")
    assert number_rows(empty, ["g"], order()).count() == 0


@pytest.mark.parametrize("n", [1, 3, 100, 1500])
def test_top_n_equals_a_window(spark, skewed, n):
    got = top_n(skewed, ["g"], order(), n)
    window = Window.partitionBy("g").orderBy(*order())
    want = skewed.withColumn("rn", F.row_number().over(window).cast("bigint")).filter(F.col("rn") <= n)
    assert got.exceptAll(want).count() == 0
    assert got.count() == want.count()


def test_many_rows_per_group_are_cut_twice(spark, skewed):
    def cuts(n):
        text = top_n(skewed, ["g"], order(), n)._jdf.queryExecution().executedPlan().toString()
        return text.count("WindowGroupLimit")

    assert cuts(3) == 2
    assert cuts(100) == 4


def test_top_n_keeps_nested_columns(spark):
    rows = [("a", i, (i, [i])) for i in range(100)]
    df = spark.createDataFrame(rows, "g string, v int, s struct<x int, l array<int>>")
    got = top_n(df, ["g"], [F.col("v").desc()], 50).collect()
    assert sorted(r.s.x for r in got) == list(range(50, 100))
    assert df.columns + ["rn"] == top_n(df, ["g"], [F.col("v").desc()], 50).columns
