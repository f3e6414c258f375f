"""Unions of many tables, distinct values, previews."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union that matches columns by name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_by_position(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by position, for tables of one layout.

    The names have to agree in order, as a plain union would silently put
    values of one column under another.
    """

    def both(a: DataFrame, b: DataFrame) -> DataFrame:
        if a.columns != b.columns:
            raise ValueError(f"columns differ: {a.columns} and {b.columns}")
        return a.union(b)

    return reduce(both, frames)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def preview(df: DataFrame, order: Iterable[Column | str], n: int = 20) -> DataFrame:
    """First ``n`` rows in a fixed order."""
    return df.orderBy(*[F.col(c) if isinstance(c, str) else c for c in order]).limit(n)
