"""Nested records to flat fact rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderlake.schemas import PARTICIPANT_FIELDS


def explode_fields(
    df: DataFrame,
    array: str,
    fields: Sequence[str],
    keep: Sequence = (),
    outer: bool = False,
) -> DataFrame:
    """One row per array element with the named struct fields of it.

    Null and empty arrays give no row, or one row of nulls with ``outer``.

    A struct of just the named fields, as a declared schema gives, is exploded
    as it is. Out of a wider one only the field arrays are zipped and exploded,
    which keeps a columnar reader to those fields; the whole struct would be
    read otherwise.
    """
    explode = F.explode_outer if outer else F.explode
    elements = df.select(F.col(array).alias("a")).schema["a"].dataType.elementType
    if set(elements.names) == set(fields):
        exploded = F.col(array)
    else:
        exploded = F.arrays_zip(*[F.col(f"{array}.{f}") for f in fields])
    kept = df.select(*keep).columns
    return df.select(*keep, explode(exploded).alias("_e")).select(
        *kept, *[F.col(f"_e.{f}").alias(f) for f in fields]
    )


def match_facts(
    docs: DataFrame,
    fields: Sequence[str] = PARTICIPANT_FIELDS,
    keep: Sequence = (),
    outer: bool = False,
) -> DataFrame:
    """One row per (match, participant): the match id and the participant fields."""
    match_id = F.col("metadata.matchId").alias("matchId")
    return explode_fields(docs, "info.participants", fields, [match_id, *keep], outer)
