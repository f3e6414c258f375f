from ladderlake.plans.matches import (
    land_matches,
    match_merge_to_bronze,
    match_raw_to_bronze,
    republish,
    select_matches,
    top_match_facts,
    whole_records_to_bronze,
)
from ladderlake.plans.standings import (
    ladder_folders,
    landing_status,
    standings_all_tiers,
    standings_bronze_to_silver,
    standings_raw_to_bronze,
    standings_silver_to_gold,
)

__all__ = [
    "ladder_folders",
    "land_matches",
    "landing_status",
    "match_merge_to_bronze",
    "match_raw_to_bronze",
    "republish",
    "select_matches",
    "standings_all_tiers",
    "standings_bronze_to_silver",
    "standings_raw_to_bronze",
    "standings_silver_to_gold",
    "top_match_facts",
    "whole_records_to_bronze",
]
