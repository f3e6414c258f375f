"""Ranking inside groups: top-n and full numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.functions import games, win_rate
from ladderlake.schemas import MIN_GAMES, TOP_PLAYERS, StandingsColumns
from ladderlake.session import materialize

# Bits of monotonically_increasing_id() that count rows inside a partition.
_ROW_BITS = 33

# Rows per group and task that may meet in one task, and the parts to cut them in above that.
_ONE_CUT_ROWS = 32
_SALTS = 64


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rn"
) -> DataFrame:
    """``row_number()`` of every row in its group, with no group in one task.

    A window would sort each group in a single task, however large the group.
    Here the rows are range-partitioned on group and order, so a large group
    spreads over many tasks. The position inside the sorted partition plus the
    sizes of the earlier slices of the group gives the number. ``order`` has to
    end in a unique key.

    The slice table has one row per (group, partition) and is joined by its
    actual size.
    """
    keys = [F.col(c).asc() for c in group] + list(order)
    ordered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    ordered = materialize(ordered, "ordered").withColumn(
        "_slice", F.shiftright("_pos", _ROW_BITS)
    )

    earlier = (
        Window.partitionBy(*group)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    slices = (
        ordered.groupBy(*group, "_slice")
        .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    slices = materialize(slices, "slices")

    o, s = ordered.alias("o"), slices.alias("s")
    same = F.col("o._slice") == F.col("s._slice")
    for c in group:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}"))
    number = F.col("o._pos") - F.col("s._first") + F.col("s._before") + F.lit(1)
    return o.join(s, same).select(
        *[F.col(f"o.{c}") for c in df.columns], number.alias(name)
    )


def _first_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str
) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def top_n(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str = "rn"
) -> DataFrame:
    """First ``n`` rows of each group, numbered.

    Spark cuts every group to ``n`` rows per task before the shuffle, so a hot
    group never arrives whole, but as ``n`` rows from each of many tasks.
    Where that is a lot, the rows are cut once more in between, spread by a hash.
    Above Spark's own limit for the cut they are numbered by
    :func:`number_rows`.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        return number_rows(df, group, order, name).filter(F.col(name) <= n)
    candidates = df
    if n > _ONE_CUT_ROWS:
        nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
        plain = [f.name for f in df.schema if not isinstance(f.dataType, nested)]
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(_SALTS)))
        candidates = _first_rows(salted, [*group, "_salt"], order, n, name).drop("_salt", name)
    return _first_rows(candidates, group, order, n, name).withColumn(
        name, F.col(name).cast("bigint")
    )


def standings_order(cols: StandingsColumns, rate: str = "win_percentage") -> list[Column]:
    """Points, then win rate; the player id settles ties."""
    return [
        F.col(cols.points).desc_nulls_last(),
        F.col(rate).desc_nulls_last(),
        F.col(cols.player).asc(),
    ]


def eligible(
    standings: DataFrame, cols: StandingsColumns = StandingsColumns(), min_games: int = MIN_GAMES
) -> DataFrame:
    """Players with enough games; an unknown count drops the player."""
    return standings.filter(games(cols.wins, cols.losses) >= min_games)


def top_players(
    standings: DataFrame,
    cols: StandingsColumns = StandingsColumns(),
    n: int = TOP_PLAYERS,
    min_games: int = MIN_GAMES,
) -> DataFrame:
    """Best ``n`` eligible players of every (tier, division)."""
    rated = eligible(standings, cols, min_games).withColumn(
        "win_percentage", win_rate(cols.wins, cols.losses)
    )
    best = top_n(rated, cols.group, standings_order(cols), n)
    return best.select(*cols.group, cols.player, cols.points, "win_percentage", "rn")


def rank_players(
    standings: DataFrame, cols: StandingsColumns = StandingsColumns()
) -> DataFrame:
    """Every player with the position in the division."""
    rated = standings.select(
        *cols.group,
        cols.player,
        cols.points,
        win_rate(cols.wins, cols.losses).alias("win_percentage"),
    )
    return number_rows(rated, cols.group, standings_order(cols))
