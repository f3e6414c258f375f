"""Every registered query against its SQL, as bags of rows."""

import math
import os

import duckdb
import pytest

from ladderlake.oracle import SQL
from ladderlake.queries import REGISTRY


@pytest.fixture(scope="module")
def reference(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{sf_dir}/{file}'")
    yield con
    con.close()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(SQL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, reference, sf_dir, name):
    df = REGISTRY[name](spark, sf_dir)
    result = reference.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = result.fetchall()
    actual = [tuple(row) for row in df.collect()]
    assert len(actual) == len(expected) > 0
    assert bag(df.columns, actual) == bag(columns, expected)
