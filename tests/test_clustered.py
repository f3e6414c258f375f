"""What lookups and filters read of tables laid out for them."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ladderlake import stand_ins as views
from ladderlake.operators import lookup_chain
from ladderlake.session import staging_path, tune
from ladderlake.sources import write_bucketed, write_clustered
from ladderlake.sources.clustered import _rank, interleaved


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below(text, name):
    """The operators above the scan of a table, up to its join."""
    lines = text.splitlines()
    at = next(k for k, line in enumerate(lines) if "FileScan" in line and name in line)
    path, depth = [], len(lines[at]) - len(lines[at].lstrip(" :+-"))
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            depth = own
            path.append(line)
            if "Join" in line:
                break
    return path


def test_stored_history_is_looked_up_without_a_shuffle(spark, sf_dir):
    own = tune(spark)
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own.conf.set("spark.sql.adaptive.enabled", "false")
    played = own.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_partkey").alias("account_id"), F.col("l_orderkey").alias("match_id")
    )
    history = write_bucketed(played, "history_b", ["account_id"], 12, staging_path(own, "history_b"))
    matches = write_bucketed(views.matches(own, sf_dir), "matches_b", ["match_id"], 12, staging_path(own, "matches_b"))
    ids = own.range(50).select(F.col("id").alias("player_id"), F.col("id").alias("account_id"))
    df = lookup_chain(own.range(20).select(F.col("id").alias("player_id")), ids, history, matches)
    text = plan(df)
    for name in ("history_b", "matches_b"):
        path = below(text, name)
        assert "Join" in path[-1] and not any("Exchange" in line for line in path)
    plain = lookup_chain(own.range(20).select(F.col("id").alias("player_id")), ids, played, views.matches(own, sf_dir))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, plain.collect()))
    own.sql("drop table history_b")
    own.sql("drop table matches_b")


def row_groups(path):
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            yield {group.column(c).path_in_schema: group.column(c) for c in range(group.num_columns)}, group.num_rows


def may_hold(path, box):
    """Share of the rows in row groups whose bounds meet the box."""
    total = met = 0
    for columns, rows in row_groups(path):
        total += rows
        bounds = [(columns[c].statistics.min, columns[c].statistics.max, low, high) for c, (low, high) in box.items()]
        met += rows * all(low <= b and high >= a for a, b, low, high in bounds)
    return met / total


def scanned(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().get("numOutputRows").get().value()


def test_a_box_meets_few_row_groups(spark, tmp_path):
    df = spark.range(40_000).select(
        F.col("id"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("x"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("y"),
    )
    small = {"parquet.block.size": "8192", "parquet.block.size.row.check.min": "100", "parquet.page.size.row.check.min": "100"}
    path = write_clustered(df, str(tmp_path / "z"), ["x", "y"], files=16, options=small)
    df.repartition(16).write.options(**small).parquet(str(tmp_path / "plain"))
    for box in ({"x": (100, 150), "y": (700, 750)}, {"x": (0, 99)}, {"y": (500, 560)}):
        assert may_hold(path, box) < (0.08 if len(box) == 2 else 0.45)
        assert may_hold(str(tmp_path / "plain"), box) > 0.95
    assert spark.read.parquet(path).exceptAll(df).count() == 0


def test_a_name_is_looked_up_in_few_row_groups(spark, tmp_path):
    own = tune(spark)
    own.conf.set("spark.sql.adaptive.enabled", "false")
    df = own.range(60_000).select(
        F.col("id").alias("x"), F.sha1(F.col("id").cast("string")).alias("name"), F.pmod("id", F.lit(7)).alias("y")
    )
    options = {"parquet.block.size": "65536", "parquet.enable.dictionary": "false"}
    path = write_clustered(df, str(tmp_path / "b"), ["y", "x"], ["name"], files=12, distinct=10_000, options=options)
    name = df.filter("x = 4321").first().name
    stored = own.read.parquet(path)
    assert stored.filter(F.col("name") == name).count() == 1
    assert scanned(stored.filter(F.col("name") == name)) < 60_000 / 5
    assert scanned(stored.filter(F.col("name") == "0" * 40)) < 60_000 / 10


@pytest.mark.parametrize("bounds", [[], [5], [1, 3, 5, 7, 9]])
def test_ranks_and_their_bits(spark, bounds):
    df = spark.createDataFrame([(v,) for v in (None, -1, 1, 4, 5, 9, 100)], "v int")
    found = [r[0] for r in df.select(_rank("v", bounds)).collect()]
    assert found == [0] + [1 + sum(v >= b for b in bounds) for v in (-1, 1, 4, 5, 9, 100)]
    z = spark.createDataFrame([(0b101, 0b011)], "a int, b int").select(interleaved([F.col("a"), F.col("b")], 3)).first()[0]
    assert z == 0b011011
