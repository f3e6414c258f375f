"""What the match queries leave on disk, over rows with hot, absent and repeated keys."""

import glob
import gzip
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from ladderlake import queries
from ladderlake import stand_ins as views
from ladderlake.operators import match_facts
from ladderlake.plans import match_raw_to_bronze
from ladderlake.schemas import MATCH_COUNT_FIELDS
from ladderlake.session import dropping_shuffles, materialize, staging_root
from ladderlake.sources import read_table, write_table

LINES = 6_000


@pytest.fixture
def sf(spark, tmp_path, monkeypatch):
    """A third of all lines is of order 7, one key is null; orders come twice, some without lines."""
    monkeypatch.setattr(views, "_TASK_BITS", 10)
    n = F.col("id")
    key = F.when(n != 5, F.when(n % 3 == 0, 7).otherwise(n % 900)).cast("bigint")
    spark.range(LINES).select(
        key.alias("l_orderkey"),
        (n % 50).alias("l_partkey"),
        F.when(n % 11 > 0, n % 20).alias("l_suppkey"),
        (n % 7 + 1).cast("int").alias("l_linenumber"),
        (n % 40).cast("double").alias("l_quantity"),
        (n * 1.5).alias("l_extendedprice"),
        F.when(n % 2 == 0, "N").otherwise("R").alias("l_returnflag"),
        F.when(n % 5 > 0, "O").alias("l_linestatus"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    twice = spark.range(1_000).select(F.when(n > 0, n).alias("o_orderkey"))
    twice.union(twice).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def shuffle_files(spark):
    """Names of the shuffle files there are, in local mode."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = list(manager.localDirs())
    return {n for d in folders for n in map(os.path.basename, glob.glob(f"{d}/*/shuffle_*"))}


def settled(spark, before):
    """Shuffle files more than before, once those being deleted are gone."""
    for _ in range(50):
        if not (more := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return more


def test_landing_shuffles_documents_once_and_lands_every_one(spark, sf, monkeypatch):
    plans, real = [], queries.land_matches

    def land(*args):
        last = real(*args)
        plans.append(last._jdf.queryExecution().executedPlan().toString())
        return last

    monkeypatch.setattr(queries, "land_matches", land)
    raw = queries.landed_matches(spark, sf)
    above, _, _ = plans[0].partition("REPARTITION_BY_NUM")
    assert above.count("Exchange") == 1, "bodies travel a second time"

    files = glob.glob(f"{raw}/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    lines = [x for f in files for x in gzip.open(f, "rt").read().splitlines()]
    docs = views.match_docs(spark, sf, views.landed_participant())
    size = F.coalesce(F.size("info.participants"), F.lit(0)).alias("n")
    docs = docs.select("metadata.matchId", "part", size).collect()
    lined = {7} | {i % 900 for i in range(LINES) if i % 3 and i != 5}
    unplayed = {str(i) for i in range(1, 1_000) if i not in lined}
    assert sum(r.n for r in docs) == LINES
    assert {r.matchId for r in docs if not r.n} == unplayed | {None}
    assert sum(not r.n for r in docs) == 2 * len(unplayed) + 2
    # What has one key is landed as one: also the null keys, with or without lines.
    assert len(lines) == len({(r.matchId, r.part) for r in docs})
    assert len(unplayed) <= lines.count("null") <= len(unplayed) + 1


def test_participants_are_made_after_the_shuffle(spark, sf):
    """Nor do their fields travel in the layout of the stored documents."""
    docs = views.match_docs(spark, sf, views.full_participant())
    plan = docs._jdf.queryExecution().executedPlan().toString()
    made, _, below = plan.partition("REPARTITION_BY")
    assert "struct(puuid" in made and "struct(puuid" not in below

    stored = match_facts(read_table(spark, queries.stored_docs(spark, sf)))
    expected = match_facts(docs)
    assert stored.dtypes == expected.dtypes and stored.count() == LINES
    assert stored.exceptAll(expected).count() == 0 == expected.exceptAll(stored).count()


def test_stored_docs_travel_as_line_items(spark, sf, monkeypatch):
    seen, real = [], queries.write_table

    def write(df, path, **layout):
        seen.append(df.select("info.participants").schema[0].dataType.elementType.names)
        return real(df, path, **layout)

    monkeypatch.setattr(queries, "write_table", write)
    stored = read_table(spark, queries.stored_docs(spark, sf))
    fields = stored.select("info.participants").schema[0].dataType.elementType.names
    assert set(MATCH_COUNT_FIELDS) < set(fields) and not set(MATCH_COUNT_FIELDS) & set(seen[0])


def test_finish_comes_after_the_rebalance(spark, tmp_path):
    path, plans = str(tmp_path / "t"), []

    def finish(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.withColumn("twice", F.col("id") * 2)

    write_table(spark.range(100), path, finish=finish)
    assert "Rebalance" in plans[0]
    assert sorted(read_table(spark, path).collect()) == [(i, 2 * i) for i in range(100)]


def test_the_parsed_copy_of_matches_is_deleted(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    for tier in ("gold", "silver"):
        body = '{"metadata":{"matchId":"M1"},"info":{"participants":[{"puuid":"p"}]}}'
        (tmp_path / "raw" / f"{tier}_M1.json").write_text(body)
    path = lambda root: {p for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}
    before = path(staging_root(spark))
    layouts = ({}, {"with_tier": True, "latest_only": True}, {"tier": "gold", "with_tier": True})
    for k, layout in enumerate(layouts):
        bronze = str(tmp_path / f"b{k}")
        loaded = match_raw_to_bronze(spark, str(tmp_path / "raw"), bronze, **layout)
        assert loaded.count() == (1 if "tier" in layout else 2)
        assert path(staging_root(spark)) == before


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    df = spark.range(1_000).repartition(5, "id").groupBy((F.col("id") % 9).alias("k")).count()
    before = shuffle_files(spark)
    stored = materialize(df, "nine")
    write_table(df, str(tmp_path / "t"))
    assert not settled(spark, before)
    assert sorted(stored.collect()) == sorted(read_table(spark, str(tmp_path / "t")).collect())
    assert df.count() == 9 == len(df.collect())


def test_shuffle_files_are_kept_again_after_a_write(spark):
    session = spark.newSession()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = session.conf.get(key)
    with pytest.raises(ValueError), dropping_shuffles(session):
        assert session.conf.get(key) == "true"
        raise ValueError
    assert session.conf.get(key) == before
    session.conf.set(key, "true")
    with dropping_shuffles(session):
        pass
    assert session.conf.get(key) == "true"


def landed_now(spark, before):
    """Files of raw matches that were not there before."""
    return set(glob.glob(f"{staging_root(spark)}/raw-matches-*/part-*")) - before


def test_rejected_matches_of_packed_landings(spark, sf):
    before = landed_now(spark, set())
    counts = {r.status: r.row_count for r in queries.rejected_matches(spark, sf).collect()}
    raw = landed_now(spark, before)
    assert raw and all(f.endswith(".gz") for f in raw)
    bodies = [json.loads(x) for f in raw for x in gzip.open(f, "rt").read().splitlines()]
    assert counts == {
        "kept": len({b["metadata"]["matchId"] for b in bodies if b}),
        "rejected": sum(b is None for b in bodies),
    }


def test_top_matches_of_packed_landings(spark, sf):
    n = F.col("id")
    orders = spark.range(1_000).select(
        n.alias("o_orderkey"),
        F.lit("1997-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        F.when(n % 2 == 0, "1-URGENT").otherwise("5-LOW").alias("o_orderpriority"),
        F.lit(1.0).alias("o_totalprice"),
    )
    orders.write.mode("overwrite").parquet(f"{sf}/orders.parquet")
    spark.range(50).select(
        n.alias("p_partkey"),
        F.lit("x").alias("p_name"),
        F.concat(F.lit("T"), n % 2).alias("p_type"),
        F.lit("B").alias("p_brand"),
        n.cast("double").alias("p_retailprice"),
    ).write.parquet(f"{sf}/part.parquet")
    before = landed_now(spark, set())
    top = queries.job_top_matches(spark, sf)
    raw = landed_now(spark, before)
    assert raw and all(f.endswith(".gz") for f in raw)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    pairs = {(r.l_orderkey, r.l_partkey) for r in lines.collect()}
    # The dearest parts: 47 and 49, 46 and 48, each with its 20 first matches of one day.
    wanted = set()
    for part in (46, 47, 48, 49):
        played = sorted(k for k, p in pairs if p == part and k is not None and k % 2 == 0)
        wanted |= {(f"T{part % 2}", str(k)) for k in played[:20]}
    sizes = {str(r.l_orderkey): r["count"] for r in lines.groupBy("l_orderkey").count().collect()}
    assert top.count() == sum(sizes[k] for _, k in wanted) > 0
    assert {(r.tier, r.matchId) for r in top.select("tier", "matchId").distinct().collect()} == wanted
