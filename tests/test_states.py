"""Profiles out of merged states against profiles of the rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ladderlake.operators import merge_states, profile_figures, profile_states, update_profile


@pytest.fixture(scope="module")
def rows(spark):
    own = random.Random(7)
    data = []
    for k in range(6000):
        tier, day = own.choice("GSB"), f"2024-01-{own.randrange(1, 9):02}"
        value = None if k % 50 == 0 else float("nan") if k % 51 == 0 else own.gauss(1e9, 1.0)
        data.append((tier, day, value, own.randrange(3000), f"n{own.randrange(700)}"))
    data += [("E", "2024-01-01", None, None, None), ("O", "2024-01-02", 5.0, 1, "x")]
    return spark.createDataFrame(data, "tier string, day string, v double, k int, s string")


def figures(df, keys):
    return {(*[r[k] for k in keys], r.column_name): r for r in df.collect()}


def test_merged_states_equal_a_profile_of_the_rows(rows):
    states = profile_states(rows, ["tier", "day"], ["v", "k", "s"])
    for keys in (["tier"], []):
        merged = figures(profile_figures(merge_states(states, keys), keys), keys)
        whole = figures(profile_figures(profile_states(rows, keys, ["v", "k", "s"]), keys), keys)
        assert set(merged) == set(whole)
        for key, a in merged.items():
            b = whole[key]
            assert (a.row_count, a.n, a.null_count, a.min_value, a.max_value) == (
                b.row_count, b.n, b.null_count, b.min_value, b.max_value
            )
            for x, y in ((a.mean, b.mean), (a.stddev, b.stddev)):
                assert x == y or math.isclose(x, y, rel_tol=1e-6), key
            assert a.distinct_count == pytest.approx(b.distinct_count, rel=0.05)


def test_deviations_keep_their_precision(rows):
    """Values near 1e9 with a deviation of 1, which sums of squares would lose."""
    states = profile_states(rows, ["tier", "day"], ["v"])
    found = profile_figures(merge_states(states)).first()
    exact = rows.filter("v is not null and not isnan(v) and v > 100").agg(F.stddev_samp("v")).first()[0]
    everything = rows.filter("v is not null and not isnan(v)").agg(F.stddev_samp("v")).first()[0]
    assert math.isclose(found.stddev, everything, rel_tol=1e-6) and 0.9 < exact < 1.1


def test_distinct_counts_are_near(rows):
    found = {r.column_name: r.distinct_count for r in profile_figures(merge_states(profile_states(rows, ["day"], ["k", "s"]))).collect()}
    exact = rows.agg(F.count_distinct("k"), F.count_distinct("s")).first()
    assert found["k"] == pytest.approx(exact[0], rel=0.05) and found["s"] == pytest.approx(exact[1], rel=0.05)


def test_groups_without_values(rows):
    found = figures(profile_figures(merge_states(profile_states(rows, ["tier", "day"], ["v", "s"]), ["tier"]), ["tier"]), ["tier"])
    assert (found["E", "v"].n, found["E", "v"].mean, found["E", "v"].null_pct) == (0, None, 100.0)
    assert (found["O", "v"].mean, found["O", "v"].stddev) == (5.0, None)
    assert found["E", "s"].distinct_count == 0


def test_a_new_day_adds_its_rows(spark, rows, tmp_path):
    path = str(tmp_path / "states")
    first = update_profile(rows.filter("day < '2024-01-05'"), path, ["tier"], "day", ["v"]).count()
    update_profile(rows.filter("day = '2024-01-05'"), path, ["tier"], "day", ["v"])
    again = update_profile(rows.filter("day >= '2024-01-05'"), path, ["tier"], "day", ["v"])
    assert again.count() == first + 3 * 4 == profile_states(rows, ["tier", "day"], ["v"]).count()
    assert again.agg(F.sum("row_count")).first()[0] == rows.count()
