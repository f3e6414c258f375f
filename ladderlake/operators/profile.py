"""Counts, descriptions, null shares and schema reports, each in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderlake.functions import missing, percent


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, *keys: str, name: str = "player_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count(
    df: DataFrame, column: str, name: str = "distinct_count", approximate: float | None = None
) -> DataFrame:
    """Distinct non-null values; ``approximate`` is a relative error to accept."""
    if approximate is not None:
        return df.agg(F.approx_count_distinct(column, approximate).alias(name))
    return df.agg(F.count_distinct(F.col(column)).alias(name))


def columns_of_type(df: DataFrame, *type_names: str) -> list[str]:
    """Names of the columns whose type is one of e.g. ``bigint``, ``double``."""
    return [name for name, type_name in df.dtypes if type_name in type_names]


def _figures(column: str):
    c = F.col(column)
    return (
        F.count(c).alias("n"),
        F.mean(c).alias("mean"),
        F.stddev_samp(c).alias("stddev"),
        F.min(c).cast("double").alias("min_value"),
        F.max(c).cast("double").alias("max_value"),
    )


def describe(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column."""
    packed = df.agg(*[F.struct(F.lit(c).alias("column_name"), *_figures(c)).alias(c) for c in columns])
    return packed.select(F.inline(F.array(*[F.col(c) for c in columns])))


def describe_strings(df: DataFrame, *columns: str) -> DataFrame:
    """The same figures as text, one row per figure."""
    return df.describe(*columns)


def describe_by(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The figures of one column in every group."""
    return df.groupBy(*keys).agg(*_figures(column))


def null_profile(df: DataFrame, *columns: str) -> DataFrame:
    """Missing values of every column as count and percentage.

    One aggregate over one scan, whatever the number of columns. NaN counts as
    missing in floating-point columns. Without rows the percentage is null.
    """
    names = columns or df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(missing(c, df.schema[c].dataType)).alias(c) for c in names],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("null_count"),
                percent(c, "_total").alias("null_pct"),
            )
            for c in names
        ]
    )
    return counts.select(F.inline(rows))


def schema_report(df: DataFrame, figures: bool = False) -> DataFrame:
    """Name and type of every column, from the schema alone.

    With ``figures`` also the number of values it holds, which reads all columns.
    """
    if not figures:
        rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
        return df.sparkSession.createDataFrame(
            rows, "position int, column_name string, data_type string"
        )
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(type_name).alias("data_type"),
                F.col(name).alias("value_count"),
            )
            for i, (name, type_name) in enumerate(df.dtypes)
        ]
    )
    return counts.select(F.inline(rows))


def schema_drift(tables: Mapping[str, DataFrame], figures: bool = False) -> DataFrame:
    """For each column: the tables that have it and its types, from the schemas alone.

    A column that not all tables share, or that has several types, is drift. With
    ``figures`` also the rows covered, which counts every table.
    """

    def listing(name: str, df: DataFrame) -> DataFrame:
        fields = F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"))
                for c, t in df.dtypes
            ]
        )
        counted = row_count(df) if figures else df.sparkSession.range(1).select(
            F.lit(None).cast("bigint").alias("row_count")
        )
        return counted.withColumn("table_name", F.lit(name)).select(
            "table_name", "row_count", F.inline(fields)
        )

    listings = reduce(DataFrame.union, [listing(n, df) for n, df in tables.items()])
    # At most one row per (table, column), so the sets are as short as the table list.
    drift = listings.groupBy("column_name").agg(
        F.array_join(F.array_sort(F.collect_set("table_name")), ",").alias("tables"),
        F.array_join(F.array_sort(F.collect_set("data_type")), ",").alias("data_types"),
        F.count(F.lit(1)).alias("table_count"),
        F.sum("row_count").alias("row_count"),
        F.count_distinct("data_type").alias("type_count"),
    )
    drifts = (F.col("table_count") < len(tables)) | (F.col("type_count") > 1)
    drift = drift.withColumn("drifts", drifts).drop("type_count")
    return drift if figures else drift.drop("row_count")
