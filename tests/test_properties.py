"""Random small inputs against plain Python."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ladderlake.operators import match_facts, null_profile, number_rows, top_n
from ladderlake.sources import latest_per_key

few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

keys = st.sampled_from(["a", "b", "", None])
values = st.one_of(st.none(), st.integers(-3, 3))
rows = st.lists(st.tuples(keys, keys, values), max_size=60)


def frame(spark, data):
    numbered = [(*row, i) for i, row in enumerate(data)]
    return numbered, spark.createDataFrame(numbered, "g string, h string, v bigint, id bigint")


def ranked(numbered):
    groups = defaultdict(list)
    for g, h, v, i in numbered:
        groups[g, h].append((v is None, -(v or 0), i))
    return {i: n for rows in groups.values() for n, (_, _, i) in enumerate(sorted(rows), start=1)}


def order():
    return [F.col("v").desc_nulls_last(), F.col("id").asc()]


@few
@given(data=rows)
def test_numbers(spark, data):
    numbered, df = frame(spark, data)
    got = {r.id: r.rn for r in number_rows(df, ["g", "h"], order()).collect()}
    assert got == ranked(numbered)


@few
@given(data=rows, n=st.sampled_from([1, 2, 40]))
def test_first_rows(spark, data, n):
    numbered, df = frame(spark, data)
    got = {r.id: r.rn for r in top_n(df, ["g", "h"], order(), n).collect()}
    assert got == {i: rn for i, rn in ranked(numbered).items() if rn <= n}


@few
@given(data=rows)
def test_last_write(spark, data):
    numbered, df = frame(spark, data)
    got = {(r.g, r.h): r.id for r in latest_per_key(df, ["g", "h"], [F.col("id").desc()]).collect()}
    assert got == {(g, h): i for g, h, _, i in numbered}


@few
@given(data=rows)
def test_null_shares(spark, data):
    numbered, df = frame(spark, data)
    got = {r.column_name: (r.null_count, r.null_pct) for r in null_profile(df).collect()}
    for k, name in enumerate(("g", "h", "v", "id")):
        count = sum(row[k] is None for row in numbered)
        share = count * 100.0 / len(numbered) if numbered else None
        assert got[name][0] == count
        assert got[name][1] == share or abs(got[name][1] - share) < 1e-9


@few
@given(sizes=st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=20))
def test_exploded_rows(spark, sizes):
    docs = [
        ((f"m{i}",), (None if n is None else [(k, "x") for k in range(n)],))
        for i, n in enumerate(sizes)
    ]
    schema = "metadata struct<matchId string>, info struct<participants array<struct<a int, b string>>>"
    df = spark.createDataFrame(docs, schema)
    inner = sorted((r.matchId, r.a) for r in match_facts(df, ["a"]).collect())
    assert inner == sorted((f"m{i}", k) for i, n in enumerate(sizes) for k in range(n or 0))
    assert match_facts(df, ["a", "b"], outer=True).count() == sum(max(n or 0, 1) for n in sizes)
