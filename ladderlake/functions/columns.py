"""Column expressions; all of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.schemas import TIER_ALIASES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def games(wins: Column | str, losses: Column | str) -> Column:
    return _col(wins) + _col(losses)


def win_rate(wins: Column | str, losses: Column | str) -> Column:
    """Share of games won, in [0, 1]; null without games."""
    return F.try_divide(_col(wins), games(wins, losses))


def percent(part: Column | str, total: Column | str) -> Column:
    """Percentage, null for a total of 0."""
    return F.try_divide(_col(part) * F.lit(100.0), _col(total))


def missing(c: Column | str, data_type: T.DataType) -> Column:
    """Null, or NaN where the type has it. Integers have none, so no cast is made."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return _col(c).isNull() | F.isnan(_col(c))
    return _col(c).isNull()


def canonical_tier(name: str) -> str:
    key = name.strip().lower()
    return TIER_ALIASES.get(key, key).upper()


def tier_names(name: str) -> list[str]:
    """Every lower-case spelling under which a tier may be landed."""
    key = canonical_tier(name).lower()
    return [key] + [alias for alias, target in TIER_ALIASES.items() if target == key]


def tier_key(tier: Column | str) -> Column:
    """Lower-case tier with aliases folded, as used in paths."""
    key = F.lower(F.trim(_col(tier)))
    expr = key
    for alias, name in TIER_ALIASES.items():
        expr = F.when(key == alias, F.lit(name)).otherwise(expr)
    return expr


def partition_folder(tier: Column | str, division: Column | str) -> Column:
    return F.concat_ws("_", tier_key(tier), _col(division))


def canonical_folder(folder: Column | str) -> Column:
    """A ``<tier>_<division>`` folder under the tier's own name instead of an alias."""
    expr = _col(folder)
    for alias, name in TIER_ALIASES.items():
        expr = F.regexp_replace(expr, rf"(?i)^{alias}(?=_|$)", name)
    return expr


def page_path(tier: Column | str, division: Column | str, page: Column | str) -> Column:
    return F.concat(
        partition_folder(tier, division), F.lit("/"), _col(page).cast("string"), F.lit(".json")
    )


def match_path(tier: Column | str, match_id: Column | str) -> Column:
    return F.concat(
        F.lit("matchs/"), tier_key(tier), F.lit("_"), _col(match_id).cast("string"), F.lit(".json")
    )


def digits(text: Column | str) -> Column:
    """All digits of a text as one integer, null without any."""
    return F.regexp_replace(_col(text), r"\D", "").try_cast("bigint")


def page_number(path: Column | str, pattern: str = r"(\d+)\.json$") -> Column:
    """Page number in a landed path, null where the pattern does not match."""
    return F.regexp_extract(_col(path), pattern, 1).try_cast("int")


def encode_json(*cols: Column | str, options: dict | None = None) -> Column:
    """Row as UTF-8 JSON text; characters beyond ASCII stay as they are, nulls are written."""
    options = {"ignoreNullFields": "false", **(options or {})}
    return F.to_json(F.struct(*[_col(c) for c in cols]), options)


def decode_json(text: Column | str, schema, options: dict | None = None) -> Column:
    return F.from_json(_col(text), schema, options or {})
