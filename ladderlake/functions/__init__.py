from ladderlake.functions.columns import (
    canonical_folder,
    canonical_tier,
    decode_json,
    digits,
    encode_json,
    games,
    match_path,
    missing,
    page_number,
    page_path,
    partition_folder,
    percent,
    tier_key,
    tier_names,
    win_rate,
)

__all__ = [
    "canonical_folder",
    "canonical_tier",
    "decode_json",
    "digits",
    "encode_json",
    "games",
    "match_path",
    "missing",
    "page_number",
    "page_path",
    "partition_folder",
    "percent",
    "tier_key",
    "tier_names",
    "win_rate",
]
