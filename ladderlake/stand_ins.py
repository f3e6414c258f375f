"""Standings, match documents and histories derived from the TPC-H-like tables.

A part plays a player: its type is the tier, its brand the division, its price
the points. An order plays a match and a line item a participant.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.schemas import MATCH_COUNT_FIELDS, StandingsColumns

COLS = StandingsColumns(
    player="player_id",
    name="player_name",
    tier="tier",
    division="division",
    points="points",
    wins="wins",
    losses="losses",
)

# A document holds at most 2**16 participants; see match_docs().
_CHUNK_BITS = 16

# Rows of one task in task_count(): 2**17, or up to 2**21 rather than more than 200 tasks, as a
# shuffle to so many writes its rows straight to files.
_TASK_BITS, _MOST_TASK_BITS, _TASKS = 17, 21, 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part; its line items are counted before the join."""
    results = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("player_id"))
        .agg(
            F.count_if(F.col("l_returnflag") == "N").alias("wins"),
            F.count_if(F.col("l_returnflag") == "R").alias("losses"),
        )
    )
    players = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("player_id"),
        F.col("p_name").alias("player_name"),
        F.col("p_type").alias("tier"),
        F.col("p_brand").alias("division"),
        F.col("p_retailprice").alias("points"),
    )
    zero = F.lit(0).cast("bigint")
    return players.join(results, "player_id", "left").select(
        "player_id",
        "player_name",
        "tier",
        "division",
        "points",
        F.coalesce("wins", zero).alias("wins"),
        F.coalesce("losses", zero).alias("losses"),
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_partkey").alias("player_id"),
        F.col("l_linenumber").alias("slot"),
        F.col("l_linestatus").alias("team"),
        (F.col("l_returnflag") == "N").alias("win"),
        F.col("l_quantity").alias("gold"),
        F.col("l_extendedprice").alias("damage"),
    )


def history(spark: SparkSession, sf_dir: str, player: str = "l_partkey") -> DataFrame:
    """Which player took part in which match.

    Repeats go before the join, already in the scanning tasks, so that many copies of one
    pair never travel. A choice of players or matches made later still reaches
    the scan, as both columns are grouping keys.
    """
    played = (
        table(spark, sf_dir, "lineitem")
        .select(F.col(player).alias("player_id"), F.col("l_orderkey").alias("match_id"))
        .distinct()
    )
    return played.join(matches(spark, sf_dir), "match_id").select(
        "player_id", "match_id", "ts", "match_type"
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("match_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("match_type"),
        F.col("o_totalprice").alias("total"),
    )


def brief_participant() -> dict[str, Column]:
    """A few typed fields of a participant."""
    return {
        "player_id": F.col("l_partkey"),
        "slot": F.col("l_linenumber"),
        "team": F.col("l_linestatus"),
        "win": F.col("l_returnflag") == "N",
        "gold": F.col("l_quantity"),
        "damage": F.col("l_extendedprice"),
    }


def landed_participant(column: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """Some of the landed fields; the others are absent from the records.

    ``column`` finds a line item's column by its name.
    """
    return {
        "puuid": F.concat(F.lit("p"), column("l_partkey").cast("string")),
        "summonerId": F.concat(F.lit("s"), column("l_suppkey").cast("string")),
        "championName": F.concat_ws("-", column("l_returnflag"), column("l_linestatus")),
        "role": column("l_linestatus"),
        "goldEarned": column("l_quantity").cast("bigint"),
        "totalDamageDealt": F.floor(column("l_extendedprice")),
        "teamId": column("l_linenumber").cast("bigint"),
        "win": column("l_returnflag") == "N",
    }


def full_participant(column: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """All landed fields. The k-th count is quantity * k + line number."""
    fields = landed_participant(column)
    quantity, line = column("l_quantity").cast("bigint"), column("l_linenumber").cast("bigint")
    for k, name in enumerate(MATCH_COUNT_FIELDS, start=1):
        fields[name] = quantity * F.lit(k) + line
    return fields


def line_columns() -> dict[str, Column]:
    """A participant as those columns of the line item that with_full_participants() reads."""
    names = ("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_linenumber")
    return {name: F.col(name) for name in names}


def with_full_participants(docs: DataFrame) -> DataFrame:
    """Documents of line_columns() with all landed fields instead."""
    full = F.transform(
        "info.participants",
        lambda line: F.struct(
            *[c.alias(n) for n, c in full_participant(lambda name: line[name]).items()]
        ),
    )
    return docs.withColumn("info", F.struct(full.alias("participants")))


def task_count(*tables: DataFrame) -> int:
    """Tasks for the rows of some tables together: by their number, see ``_TASK_BITS``."""
    rows = sum(t.count() for t in tables)
    return 1 + max(min(rows >> _TASK_BITS, _TASKS - 1), rows >> _MOST_TASK_BITS)


def without_lines(orders: DataFrame, lines: DataFrame, tasks: int) -> DataFrame:
    """Orders whose ``l_orderkey`` no line has; of lines also the run of rows, as ``part``.

    The number of tasks follows the number of rows. Without it, adaptive execution would merge
    partitions up to a size in files, where keys take a tenth of what they take in a task's
    memory. Copies of a key go run by run, so that a hot one is dealt to many tasks.
    """
    played = lines.repartition(tasks, "l_orderkey", "part").distinct().select("l_orderkey")
    played = played.repartition(tasks, "l_orderkey")
    return orders.repartition(tasks, "l_orderkey").join(played, "l_orderkey", "left_anti")


def gathered(spark: SparkSession, sf_dir: str, participant: dict[str, Column]) -> DataFrame:
    """``matchId``, ``part`` and ``participants`` of every document of match_docs().

    What travels are the columns of the line items; the fields of a participant, which may be
    many times as large, are made by the receiving tasks. Documents are dealt by match id and
    run, played or not, so what then groups them by both does not shuffle them again.
    """
    element = F.struct(*[c.alias(n) for n, c in participant.items()])
    run = F.shiftright(F.monotonically_increasing_id(), _CHUNK_BITS)
    lines = table(spark, sf_dir, "lineitem").withColumn("part", run)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    tasks = task_count(lines, orders)
    # An order that comes twice has two documents, told apart by a number.
    unplayed = without_lines(orders, lines.select("l_orderkey", "part"), tasks).select(
        "l_orderkey",
        F.lit(0).cast("bigint").alias("part"),
        F.monotonically_increasing_id().alias("unplayed"),
    )
    rows = lines.unionByName(unplayed, allowMissingColumns=True)
    rows = rows.withColumn("matchId", F.col("l_orderkey").cast("string"))
    # Gathering makes nothing smaller, so it is left to the receiving tasks alone.
    spread = rows.repartition(tasks, "matchId", "part")
    played = F.col("unplayed").isNull()
    docs = spread.groupBy("matchId", "part", "unplayed").agg(
        F.collect_list(F.when(played, element)).alias("participants")
    )
    return docs.select(
        "matchId", "part", F.when(played, F.col("participants")).alias("participants")
    )


def document() -> list[Column]:
    """The columns of a document, out of those of gathered()."""
    return [F.struct("matchId").alias("metadata"), F.struct("participants").alias("info")]


def match_docs(spark: SparkSession, sf_dir: str, participant: dict[str, Column]) -> DataFrame:
    """Nested documents: one per match and run of input rows, as ``part``.

    The rows of a task are numbered and cut into runs of 2**16, and a document
    gathers one match within one run. So an array stays that short even
    for a match with a third of all participants, which gets several documents.
    Matches without participants have a document with a null array.
    """
    return gathered(spark, sf_dir, participant).select(*document(), "part")
