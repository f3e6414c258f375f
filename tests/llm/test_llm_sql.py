"""Queries whose results SQL can express, against their SQL."""

import os

import duckdb
import pytest
from brute import rows_of

from ladderlake.llm.queries import REGISTRY, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small_dir, name):
    con = duckdb.connect()
    for file in sorted(os.listdir(small_dir)):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{small_dir}/{file}'")
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    df = REGISTRY[name](spark, small_dir)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.select(columns)) == sorted(result.fetchall(), key=repr)
