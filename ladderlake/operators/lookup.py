"""Lookups between players, their match history and the matches."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderlake.operators.ranking import top_n
from ladderlake.schemas import (
    HISTORY_COUNT,
    HISTORY_SINCE,
    HISTORY_START,
    HISTORY_TYPE,
    HISTORY_UNTIL,
)
from ladderlake.session import materialize


def resolve_names(names: DataFrame, players: DataFrame, on: str) -> DataFrame:
    """Player rows for a list of names."""
    return players.join(names.select(on).distinct(), on, "left_semi")


def lookup_chain(
    players: DataFrame,
    ids: DataFrame,
    history: DataFrame,
    matches: DataFrame,
    player: str = "player_id",
    account: str = "account_id",
    match: str = "match_id",
) -> DataFrame:
    """Players to account ids to match ids to match records.

    The selected players and their accounts are staged first, so that the
    planner sees how few they are and the large history is filtered in place
    instead of being shuffled. Repeated history entries count once.
    """
    accounts = materialize(players.join(ids, player), "accounts")
    return history.join(accounts, account).distinct().join(matches, match)


def _instant(column_type: str, epoch: int):
    text = datetime.fromtimestamp(epoch, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(text).cast(column_type)


def in_period(df: DataFrame, ts: str, since: int, until: int) -> DataFrame:
    """Rows between two epoch seconds, both included.

    The bounds take the type of the column, so the scan can skip on them.
    """
    column_type = dict(df.dtypes)[ts]
    return df.filter(F.col(ts).between(_instant(column_type, since), _instant(column_type, until)))


def recent_per_player(
    history: DataFrame,
    player: str = "player_id",
    match: str = "match_id",
    ts: str = "ts",
    match_type: str = "match_type",
    wanted_type: str = HISTORY_TYPE,
    since: int = HISTORY_SINCE,
    until: int = HISTORY_UNTIL,
    start: int = HISTORY_START,
    count: int = HISTORY_COUNT,
) -> DataFrame:
    """Newest matches of each player: skip ``start``, keep ``count``.

    Matches of the same instant follow the match id.
    """
    chosen = in_period(history, ts, since, until).filter(F.col(match_type) == wanted_type)
    order = [F.col(ts).desc_nulls_last(), F.col(match).asc()]
    return top_n(chosen, [player], order, start + count).filter(F.col("rn") > start)


def matches_of_players(
    matches: DataFrame,
    facts: DataFrame,
    players: DataFrame,
    player: str = "player_id",
    match: str = "match_id",
) -> DataFrame:
    """Match rows in which at least one of the players took part."""
    chosen = materialize(players.select(player).distinct(), "players")
    played = facts.join(chosen, player, "left_semi").select(match).distinct()
    return matches.join(played, match, "left_semi")
