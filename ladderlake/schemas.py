"""Declared input schemas, so that JSON scans need no inference pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: field names of the landed records -------------------------

MATCH_TEXT_FIELDS = ("puuid", "summonerId", "championName", "role")

MATCH_COUNT_FIELDS = (
    "assists",
    "damageDealtToTurrets",
    "damageDealtToObjectives",
    "detectorWardsPlaced",
    "visionScore",
    "visionWardsBoughtInGame",
    "wardsKilled",
    "wardsPlaced",
    "enemyMissingPings",
    "enemyVisionPings",
    "getBackPings",
    "goldEarned",
    "goldSpent",
    "longestTimeSpentLiving",
    "magicDamageDealt",
    "magicDamageDealtToChampions",
    "magicDamageTaken",
    "physicalDamageDealt",
    "physicalDamageDealtToChampions",
    "physicalDamageTaken",
    "totalDamageDealt",
    "totalDamageDealtToChampions",
    "totalDamageTaken",
    "totalTimeSpentDead",
    "spell1Casts",
    "spell2Casts",
    "spell3Casts",
    "spell4Casts",
    "teamId",
)

MATCH_FLAG_FIELDS = ("win",)

# --- fixed values: tiers, divisions, match history request -------------------

TIERS = ("BRONZE", "SILVER", "GOLD", "PLATINUM")
DIVISIONS = ("I", "II", "III", "IV")
# Crawled next to the tiers above: with all divisions, and with division I only.
HIGHER_TIERS = ("EMERALD", "DIAMOND")
APEX_TIERS = ("MASTER", "GRANDMASTER", "CHALLENGER")
TIER_ALIASES = {"platina": "platinum"}

MIN_GAMES = 20
TOP_PLAYERS = 2

# June 2024, UTC, in epoch seconds.
HISTORY_SINCE = 1717200000
HISTORY_UNTIL = 1719791999
HISTORY_TYPE = "ranked"
HISTORY_START = 0
HISTORY_COUNT = 20

# Divisions of every tier.
LADDER = {tier: DIVISIONS for tier in TIERS + HIGHER_TIERS} | {
    tier: DIVISIONS[:1] for tier in APEX_TIERS
}

# -----------------------------------------------------------------------------

PARTICIPANT_FIELDS = MATCH_TEXT_FIELDS + MATCH_COUNT_FIELDS + MATCH_FLAG_FIELDS
MATCH_COLUMNS = ("matchId",) + PARTICIPANT_FIELDS


@dataclass(frozen=True)
class StandingsColumns:
    """Column names of a standings table; the defaults are the landed ones."""

    player: str = "summonerId"
    name: str = "summonerName"
    tier: str = "tier"
    division: str = "rank"
    points: str = "leaguePoints"
    wins: str = "wins"
    losses: str = "losses"

    @property
    def group(self) -> tuple[str, str]:
        return (self.tier, self.division)


def standings_schema(cols: StandingsColumns = StandingsColumns()) -> T.StructType:
    text = (cols.player, cols.name, cols.tier, cols.division)
    counts = (cols.points, cols.wins, cols.losses)
    return T.StructType(
        [T.StructField(n, T.StringType()) for n in text]
        + [T.StructField(n, T.LongType()) for n in counts]
    )


def participant_schema(fields=PARTICIPANT_FIELDS) -> T.StructType:
    """Struct of the named participant fields; name fewer to read fewer."""

    def field_type(name):
        if name in MATCH_TEXT_FIELDS:
            return T.StringType()
        if name in MATCH_FLAG_FIELDS:
            return T.BooleanType()
        return T.LongType()

    return T.StructType([T.StructField(n, field_type(n)) for n in fields])


def match_schema(fields=PARTICIPANT_FIELDS) -> T.StructType:
    participants = T.ArrayType(participant_schema(fields))
    return T.StructType(
        [
            T.StructField(
                "metadata", T.StructType([T.StructField("matchId", T.StringType())])
            ),
            T.StructField(
                "info", T.StructType([T.StructField("participants", participants)])
            ),
        ]
    )
