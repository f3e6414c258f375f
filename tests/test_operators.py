import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ladderlake import stand_ins as views
from ladderlake.functions import (
    canonical_tier,
    decode_json,
    digits,
    encode_json,
    match_path,
    page_path,
    percent,
    tier_key,
    tier_names,
    win_rate,
)
from ladderlake.operators import (
    columns_of_type,
    count_by,
    describe,
    describe_by,
    distinct_count,
    distinct_values,
    explode_fields,
    lookup_chain,
    match_facts,
    matches_of_players,
    null_profile,
    preview,
    recent_per_player,
    resolve_names,
    schema_drift,
    schema_report,
    union_by_name,
    union_by_position,
)
from ladderlake.schemas import MATCH_COLUMNS, match_schema


def test_win_rate_without_games_is_null(spark):
    df = spark.createDataFrame([(0, 0), (1, 3), (None, 2)], "w bigint, l bigint")
    assert [r[0] for r in df.select(win_rate("w", "l")).collect()] == [None, 0.25, None]


def test_paths_and_tiers(spark):
    assert canonical_tier("platina") == "PLATINUM" and canonical_tier(" Gold ") == "GOLD"
    assert tier_names("PLATINUM") == ["platinum", "platina"] and tier_names("gold") == ["gold"]
    row = (
        spark.createDataFrame([("Platina", "IV", 12)], "t string, d string, n int")
        .select(tier_key("t"), page_path("t", "d", "n"), match_path("t", "n"), digits("d"), percent("n", F.lit(0)))
        .first()
    )
    assert tuple(row) == ("platinum", "platinum_IV/12.json", "matchs/platinum_12.json", None, None)


def test_json_text_keeps_all_characters(spark):
    df = spark.createDataFrame([('ação "x"\n\\',)], "t string")
    body = df.select(encode_json("t").alias("b"))
    assert "ação" in body.first().b
    assert body.select(decode_json("b", "t string").t.alias("t")).first().t == 'ação "x"\n\\'


def docs(spark):
    schema = "metadata struct<matchId string>, info struct<participants array<struct<a int, b string, c int>>>"
    rows = [
        (("m1",), ([(1, "x", 0), (2, None, 0), None],)),
        (("m2",), ([],)),
        (("m3",), (None,)),
        (("m4",), None),
    ]
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("fields", [["a", "b"], ["a", "b", "c"]])
def test_explode_drops_or_keeps_empty_arrays(spark, fields):
    inner = match_facts(docs(spark), fields).select("matchId", "a", "b").collect()
    assert sorted(map(str, map(tuple, inner))) == [
        "('m1', 1, 'x')",
        "('m1', 2, None)",
        "('m1', None, None)",
    ]
    outer = match_facts(docs(spark), fields, outer=True)
    assert outer.count() == 6
    assert outer.columns == ["matchId", *fields]


def test_explode_count_is_the_sum_of_sizes(spark):
    rng = random.Random(5)
    rows = [(i, [(k,) for k in range(rng.randrange(4))] if rng.random() < 0.8 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, l array<struct<k int>>")
    want = sum(len(r[1] or []) for r in rows)
    assert explode_fields(df, "l", ["k"], ["id"]).count() == want
    outer = explode_fields(df, "l", ["k"], ["id"], outer=True).count()
    assert outer == want + sum(1 for r in rows if not r[1])


def test_absent_nested_fields_are_null(spark, tmp_path):
    (tmp_path / "gold_1.json").write_text(
        '{"metadata": {"matchId": "1"}, "info": {"participants": [{"puuid": "p", "win": true}]}}'
    )
    df = match_facts(spark.read.schema(match_schema()).json(str(tmp_path)))
    assert tuple(df.columns) == MATCH_COLUMNS and len(MATCH_COLUMNS) == 35
    row = df.first()
    assert row.puuid == "p" and row.win is True and row.goldEarned is None


def test_documents_are_bounded_and_whole(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(views, "_CHUNK_BITS", 6)
    got = views.match_docs(spark, sf_dir, views.brief_participant())
    assert got.select(F.max(F.size("info.participants"))).first()[0] <= 64
    rows = match_facts(got, ["player_id", "damage"])
    want = views.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string"), "l_partkey", "l_extendedprice"
    )
    assert rows.exceptAll(want).count() == 0 and rows.count() == want.count()


def test_union_by_name_aligns_and_fills(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2, True)], "s string, n int, extra boolean")
    c = spark.createDataFrame([(3,)], "n int")
    got = sorted(tuple(r) for r in union_by_name([a, b, c]).fillna({"s": "-", "extra": False}).collect())
    assert got == [(1, "x", False), (2, "y", True), (3, "-", False)]


def test_union_of_nested_drift(spark):
    a = spark.createDataFrame([((1,),)], "m struct<wins int>")
    b = spark.createDataFrame([((2, 3),)], "m struct<wins int, losses int>")
    got = union_by_name([a, b]).select("m.wins", "m.losses").collect()
    assert sorted(str(tuple(r)) for r in got) == ["(1, None)", "(2, 3)"]


def test_union_by_position_refuses_drift(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    assert union_by_position([a, a, a]).count() == 3
    for other in ("s string, n int", "n int"):
        with pytest.raises(ValueError):
            union_by_position([a, spark.createDataFrame([], other)])


def test_union_keeps_every_row(spark):
    parts = [spark.range(n) for n in (0, 3, 10, 3)]
    assert union_by_name(parts).count() == 16


def test_null_profile_counts_nan_and_nulls(spark):
    nan = float("nan")
    rows = [(1, nan, nan, "a"), (None, 2.0, None, None), (3, None, 1.0, "c"), (4, 4.0, 1.0, "d")]
    df = spark.createDataFrame(rows, "i bigint, d double, f float, s string")
    got = {r.column_name: (r.null_count, r.null_pct) for r in null_profile(df).collect()}
    assert got == {"i": (1, 25.0), "d": (2, 50.0), "f": (2, 50.0), "s": (1, 25.0)}
    assert [r.null_pct for r in null_profile(df.limit(0), "i").collect()] == [None]


def test_null_profile_stays_in_bounds(spark, sf_dir):
    for name in ("events", "labels", "pages"):
        got = null_profile(views.table(spark, sf_dir, name)).collect()
        assert all(0 <= r.null_pct <= 100 for r in got)


def test_describe_one_and_many(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (3, 4.0, "x"), (None, 6.0, "y")], "a bigint, b double, k string")
    assert columns_of_type(df, "bigint", "double") == ["a", "b"]
    got = {r.column_name: r for r in describe(df, "a", "b").collect()}
    assert (got["a"].n, got["a"].mean, got["a"].min_value, got["a"].max_value) == (2, 2.0, 1.0, 3.0)
    assert got["b"].stddev == 2.0
    by = {r.k: r for r in describe_by(df, ["k"], "b").collect()}
    assert by["x"].n == 2 and by["y"].stddev is None


def test_distinct_counts_skip_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "s string")
    assert distinct_count(df, "s").first()[0] == 2
    assert distinct_values(df, "s").count() == 3
    many = spark.range(50_000).select((F.col("id") % 10_000).alias("s"))
    assert abs(distinct_count(many, "s", approximate=0.02).first()[0] - 10_000) < 1000
    assert sorted(tuple(r) for r in count_by(df.fillna("-"), "s").collect()) == [("-", 1), ("a", 2), ("b", 1)]


def test_schema_report_and_drift(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n bigint")
    report = [tuple(r) for r in schema_report(a, figures=True).collect()]
    assert report == [(0, "n", "int", 2), (1, "s", "string", 1)]
    drift = {r.column_name: r for r in schema_drift({"a": a, "b": b}, figures=True).collect()}
    assert drift["s"].drifts is False and drift["s"].tables == "a,b" and drift["s"].row_count == 3
    assert drift["n"].drifts is True and drift["n"].data_types == "bigint,int"
    alone = schema_drift({"a": a, "b": b.drop("n")}).filter("column_name = 'n'").first()
    assert alone.drifts is True and alone.table_count == 1


def test_schemas_are_listed_without_reading_the_data(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).withColumn("s", F.lit("x")).write.parquet(path)
    stored = spark.read.parquet(path)
    for df in (schema_report(stored), schema_drift({"a": stored, "b": stored.drop("s")})):
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 2


def test_preview_is_in_order(spark):
    got = preview(spark.range(100).repartition(7), ["id"])
    assert [r.id for r in got.collect()] == list(range(20))


HISTORY = "player_id string, match_id string, ts timestamp_ntz, match_type string"


def test_recent_matches_use_period_type_and_bounds(spark):
    rows = [("p", f"m{i:02}", f"2024-06-{i:02} 10:00:00", "ranked") for i in range(1, 31)]
    rows += [
        ("p", "before", "2024-05-31 23:59:59", "ranked"),
        ("p", "after", "2024-07-01 00:00:00", "ranked"),
        ("p", "other", "2024-06-30 11:00:00", "normal"),
        ("q", "first", "2024-06-01 00:00:00", "ranked"),
        ("q", "last", "2024-06-30 23:59:59", "ranked"),
        ("q", "tie_b", "2024-06-10 00:00:00", "ranked"),
        ("q", "tie_a", "2024-06-10 00:00:00", "ranked"),
    ]
    df = spark.createDataFrame(rows, "player_id string, match_id string, ts string, match_type string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = recent_per_player(df)
    p = [r.match_id for r in got.filter("player_id = 'p'").orderBy("rn").collect()]
    assert p == [f"m{i:02}" for i in range(30, 10, -1)]
    q = [r.match_id for r in got.filter("player_id = 'q'").orderBy("rn").collect()]
    assert q == ["last", "tie_a", "tie_b", "first"]
    rest = recent_per_player(df.filter("player_id = 'p'"), start=20, count=5).orderBy("rn")
    assert [r.match_id for r in rest.collect()] == ["m10", "m09", "m08", "m07", "m06"]
    with_zone = recent_per_player(df.withColumn("ts", F.col("ts").cast("timestamp")))
    assert with_zone.count() == got.count()


def test_lookup_chain_and_matches_of_players(spark):
    top = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "player_id string")
    ids = spark.createDataFrame([("s1", "a1"), ("s2", "a2"), ("s9", "a9")], "player_id string, account_id string")
    history = spark.createDataFrame(
        [("a1", "m1"), ("a1", "m1"), ("a2", "m1"), ("a2", "m2"), ("a9", "m3"), ("a1", "gone")],
        "account_id string, match_id string",
    )
    matches = spark.createDataFrame([("m1", 1), ("m2", 2), ("m3", 3)], "match_id string, v int")
    got = lookup_chain(top, ids, history, matches).select("player_id", "match_id", "v").collect()
    assert sorted(tuple(r) for r in got) == [("s1", "m1", 1), ("s2", "m1", 1), ("s2", "m2", 2)]
    facts = history.join(ids, "account_id")
    kept = matches_of_players(matches, facts, top).collect()
    assert sorted(r.match_id for r in kept) == ["m1", "m2"]


def test_names_resolve_to_all_bearers(spark):
    players = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None)], "id int, name string")
    names = spark.createDataFrame([("x",), ("x",), (None,)], "name string")
    assert sorted(r.id for r in resolve_names(names, players, "name").collect()) == [1, 2]


def test_csv_refuses_nested_columns_unless_flattened(spark, tmp_path):
    df = spark.range(1).select(F.struct("id").alias("s"))
    with pytest.raises(AnalysisException):
        df.write.csv(str(tmp_path / "x"))
