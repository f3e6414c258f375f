"""Profiles kept as states that merge: counts, moments, bounds and sketches of distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.functions import missing, percent
from ladderlake.sources.tables import read_table, write_table

# 2^12 registers: a standard error of 1.6 % of the distinct count.
SKETCH_BITS = 12

_SKETCHED = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def _state(field: T.StructField, bits: int) -> Column:
    c = F.when(~missing(field.name, field.dataType), F.col(field.name))
    number = c.cast("double") if isinstance(field.dataType, T.NumericType) else F.lit(None).cast("double")
    value = c if isinstance(field.dataType, _SKETCHED) else c.cast("string")
    return F.struct(
        F.lit(field.name).alias("column_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.count(c).alias("n"),
        F.mean(number).alias("mean"),
        (F.var_pop(number) * F.count(number)).alias("m2"),
        F.min(number).alias("min_value"),
        F.max(number).alias("max_value"),
        F.hll_sketch_agg(value, bits).alias("sketch"),
    )


def profile_states(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int = SKETCH_BITS
) -> DataFrame:
    """One state for each group and column, out of one scan with partial aggregates.

    Missing values (null, and NaN) are counted apart. ``m2`` is the sum of squared deviations
    from the mean; figures of columns that are no numbers are null.
    """
    states = [_state(df.schema[c], bits).alias(f"_{k}") for k, c in enumerate(columns)]
    packed = df.groupBy(*keys).agg(*states)
    every = F.array(*[F.col(f"_{k}") for k in range(len(columns))])
    return packed.select(*keys, F.inline(every))


def _pairwise(moments: Column) -> Column:
    """Count, mean and squared deviations of all, from those of the parts."""

    def both(a: Column, b: Column) -> Column:
        n = a.n + b.n
        delta = b.mean - a.mean
        mean = a.mean + delta * b.n / n
        m2 = a.m2 + b.m2 + delta * delta * a.n * b.n / n
        return F.when(b.n == 0, a).when(a.n == 0, b).otherwise(
            F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))
        )

    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(F.array_sort(moments), nothing, both)


def merge_states(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """States of coarser groups. Reads states only, of which a group has one for each part.

    Means and deviations are merged by the pairwise formula, which keeps its precision where the
    parts' means are far from zero or from each other; sketches by their union.
    """
    zero = F.lit(0.0)
    number = F.when(F.col("mean").isNull(), 0).otherwise(F.col("n")).cast("bigint")
    part = F.struct(number.alias("n"), F.coalesce("mean", zero).alias("mean"), F.coalesce("m2", zero).alias("m2"))
    merged = states.groupBy(*keys, "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("n").alias("n"),
        _pairwise(F.collect_list(part)).alias("_moments"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.hll_union_agg("sketch").alias("sketch"),
    )
    some = F.col("_moments.n") > 0
    return merged.select(
        *keys,
        "column_name",
        "row_count",
        "n",
        F.when(some, F.col("_moments.mean")).alias("mean"),
        F.when(some, F.col("_moments.m2")).alias("m2"),
        "min_value",
        "max_value",
        "sketch",
    )


def profile_figures(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, bounds, missing values and distinct count of each state."""
    return states.select(
        *keys,
        "column_name",
        "row_count",
        "n",
        "mean",
        F.sqrt(F.try_divide(F.col("m2"), F.nullif(F.col("n") - 1, F.lit(0)))).alias("stddev"),
        "min_value",
        "max_value",
        (F.col("row_count") - F.col("n")).alias("null_count"),
        percent(F.col("row_count") - F.col("n"), "row_count").alias("null_pct"),
        F.hll_sketch_estimate("sketch").alias("distinct_count"),
    )


def update_profile(
    df: DataFrame, path: str, keys: Sequence[str], day: str, columns: Sequence[str], bits: int = SKETCH_BITS
) -> DataFrame:
    """Store the states of the days in ``df``, in place of earlier ones of the same days.

    A new day adds its rows, and no other day is read. Returns the stored states, to be merged.
    """
    states = profile_states(df, [*keys, day], columns, bits)
    write_table(states, path, partition_by=[day], replace="partitions")
    return read_table(df.sparkSession, path)
