import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ladderlake import session as settings
from ladderlake.session import (
    CLUSTER_SETTINGS,
    SQL_SETTINGS,
    materialize,
    shared_root,
    staging,
    staging_path,
    staging_root,
    tune,
)


def fake(master, conf=None, checkpoint=None):
    state = {"dir": checkpoint}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda path: state.update(dir=path),
    )
    known = {"spark.checkpoint.dir": conf}
    settings = SimpleNamespace(get=lambda key, default=None: known.get(key) or default)
    return SimpleNamespace(sparkContext=context, conf=settings)


def test_the_named_folder_is_used():
    assert shared_root(fake("yarn", "s3a://shared/x/")) == "s3a://shared/x"
    assert shared_root(fake("yarn", None, "hdfs:///c")) == "hdfs:///c"


def test_a_cluster_never_stages_on_one_machine():
    with pytest.raises(RuntimeError):
        shared_root(fake("spark://host:7077"))


def test_a_local_session_gets_a_folder_of_its_own():
    session = fake("local[2]")
    assert shared_root(session) == shared_root(session)


def test_staging_paths_are_new(spark):
    assert staging_path(spark, "x") != staging_path(spark, "x")
    assert staging_path(spark, "x").startswith(shared_root(spark))


def test_materialized_results_are_stored_and_sized(spark):
    df = materialize(spark.range(10), "ten")
    assert df.count() == 10
    assert os.path.isdir(df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0])
    big = spark.range(0, 1_000_000).withColumnRenamed("id", "k")
    plan = big.join(df.withColumnRenamed("id", "k"), "k")._jdf.queryExecution().executedPlan()
    assert "BroadcastHashJoin" in plan.toString()


def test_tuning_leaves_the_session_as_it_is(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    other.conf.set("spark.sql.shuffle.partitions", "3")
    before = dict(other.conf.getAll)
    tuned = tune(other)
    assert all(tuned.conf.get(k) == v for k, v in SQL_SETTINGS.items())
    assert tuned.conf.get("spark.sql.shuffle.partitions") == "3"
    assert dict(other.conf.getAll) == before


def test_staged_data_is_deleted_at_the_end(spark):
    with staging(spark):
        root = staging_root(spark)
        with staging(spark):
            inner = materialize(spark.range(10), "ten").inputFiles()
        assert not os.path.exists(inner[0].removeprefix("file://"))
        assert materialize(spark.range(10), "ten").count() == 10
        assert os.listdir(root)
    assert not os.path.exists(root)


def test_a_path_without_scheme_is_refused_on_a_cluster():
    with pytest.raises(RuntimeError):
        shared_root(fake("yarn", "/tmp/x"))
    assert shared_root(fake("yarn", "file:///mnt/shared/x")) == "file:///mnt/shared/x"


def test_a_cluster_stages_in_a_folder_that_spark_named_without_a_scheme(spark, monkeypatch):
    root = spark.conf.get("spark.checkpoint.dir")
    assert root.startswith("/")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert shared_root(spark) == root
    assert materialize(spark.range(10), "ten").count() == 10
    assert not [x for x in os.listdir(f"{root}/ladderlake") if x.startswith("probe-")]


def test_a_folder_that_loses_rows_of_tasks_is_refused_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(settings, "_proven", set())
    read = type(spark.read).parquet
    lost = lambda self, *paths, **options: read(self, *paths, **options).filter("id > 0")
    monkeypatch.setattr(type(spark.read), "parquet", lost)
    with pytest.raises(RuntimeError):
        shared_root(spark)
    assert not settings._proven


def test_cluster_settings_are_accepted(spark):
    session = spark.newSession()
    for key, value in CLUSTER_SETTINGS.items():
        session.conf.set(key, value)
    assert session.range(10).groupBy((F.col("id") % 3).alias("k")).count().count() == 3


def test_partition_values_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("1", 5)], "division string, v int").write.partitionBy("division").parquet(path)
    assert dict(spark.read.parquet(path).dtypes)["division"] == "string"
