"""Scans over landed JSON: files of arrays, of single objects or of lines."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.session import materialize


def scan_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    glob: str = "*.json",
    path_regex: str | None = None,
    metadata: dict[str, str] | None = None,
    options: dict | None = None,
    corrupt: str | None = None,
) -> DataFrame:
    """Rows of all JSON files below ``path`` (a prefix such as ``raw/gold_*`` works).

    With a declared ``schema`` the files are read once, only the declared
    fields are built, and absent fields are null. Without one, the schema is
    inferred from all files of the path, which costs a second pass; narrow it by
    ``path`` or ``glob``. With a schema, ``path_regex`` selects
    files by a search in their full path; others are not opened. ``metadata`` adds columns about the
    file of each row, e.g. ``{"landed_at": "file_modification_time"}``. Folder
    markers and files of other names give no rows.

    A path that does not exist is an error, also as one of several; an existing
    folder without files is an empty result if the schema is declared. ``corrupt``
    names a column for the text of records that are broken or do not fit the schema.
    """
    if schema is None and (path_regex is not None or corrupt is not None):
        raise ValueError("without a schema, select files by path or glob")
    reader = spark.read.options(
        **{"pathGlobFilter": glob, "recursiveFileLookup": "true", **(options or {})}
    )
    if schema is not None:
        if corrupt is not None:
            if isinstance(schema, str):
                schema = T.StructType.fromDDL(schema)
            schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt)
        reader = reader.schema(schema)
    df = reader.json(path)
    columns = df.columns
    if path_regex is not None:
        df = df.filter(F.col("_metadata.file_path").rlike(path_regex))
    if metadata:
        return df.select(
            *columns, *[F.col(f"_metadata.{f}").alias(name) for name, f in metadata.items()]
        )
    return df


def reject_empty(df: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Split off records without any content, as a failed request lands them.

    Returns the kept and the rejected rows. ``keys`` names the columns to look
    at; all by default.
    """
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in (keys or df.columns)])
    return df.filter(~empty), df.filter(empty)


def scan_records(
    spark: SparkSession,
    path: str | list[str],
    glob: str = "*.json",
    whole_files: bool = False,
    metadata: dict[str, str] | None = None,
) -> DataFrame:
    """Records with all their fields, in one pass: a variant column ``record`` and ``_text``.

    Each line of a file (or each file) is an object or an array of them; the records of
    an array become rows. A line that is no JSON is kept as text with a null record.
    """
    lines = spark.read.options(pathGlobFilter=glob, recursiveFileLookup="true").text(
        path, wholetext=whole_files
    )
    about = [F.col(f"_metadata.{f}").alias(name) for name, f in (metadata or {}).items()]
    parsed = lines.filter(F.trim("value") != "").select(
        F.col("value").alias("_text"), F.try_parse_json("value").alias("_json"), *about
    )
    several = F.try_variant_get("_json", F.lit("$"), "array<variant>")
    rows = parsed.withColumn("record", F.explode_outer(F.coalesce(several, F.array("_json"))))
    return rows.drop("_json")


def record_fields(schema: T.StructType, record: str = "record") -> dict[str, Column]:
    """The declared fields of a variant record; a value of another type becomes null."""
    return {
        f.name: F.try_variant_get(record, F.lit(f"$['{f.name}']"), f.dataType.simpleString())
        for f in schema.fields
    }


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def has_misfit(schema: T.StructType, record: str = "record") -> Column:
    """Whether a declared field of a variant record has a value that does not fit its type.

    The value is there, is not null, and becomes null in the declared type; or it is a number
    with a fraction, or beyond the range, where an integer is declared.
    """

    def lost(field: T.StructField) -> Column:
        path = F.lit(f"$['{field.name}']")
        get = lambda kind: F.try_variant_get(record, path, kind)
        value = get(field.dataType.simpleString())
        there = get("variant").isNotNull() & ~F.is_variant_null(get("variant"))
        if isinstance(field.dataType, _INTEGERS):
            return (value.isNull() & there) | F.coalesce(get("double") != value, F.lit(False))
        return value.isNull() & there

    return reduce(lambda a, b: a | b, [lost(f) for f in schema.fields], F.lit(False))


def is_broken(corrupt: str) -> Column:
    """Whether the text of a record that did not fit is more than a bare ``null``."""
    return F.coalesce(F.trim(corrupt) != "null", F.lit(False))


def is_misfit(corrupt: str) -> Column:
    """Whether a record that did not fit is JSON all the same."""
    return is_broken(corrupt) & F.try_parse_json(corrupt).isNotNull()


def why_rejected(keys: list[str], broken: Column, misfit: Column | None = None) -> Column:
    """Null for a usable record, else ``misfit``, ``broken`` or ``empty``.

    Empty are records without any of ``keys``, as a failed request lands them.
    """
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in keys])
    misfit = F.lit(False) if misfit is None else misfit
    return F.when(misfit, "misfit").when(broken, "broken").when(empty, "empty")


def split_records(
    df: DataFrame, keys: list[str], broken: Column, misfit: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """The usable rows, and the others with a ``reason``: see ``why_rejected``.

    Each of the two reads the source by itself. With ``scan_json``, whether a record fits
    depends on the columns that are read: where both are written, use ``parse_once``.
    """
    rows = df.withColumn("reason", why_rejected(keys, broken, misfit))
    return rows.filter("reason is null").drop("reason"), rows.filter("reason is not null")


def parse_once(
    df: DataFrame,
    reason: Column,
    name: str,
    file: str = "_file",
    text: str = "_text",
    page: Column | None = None,
) -> tuple[DataFrame, DataFrame, dict[str, int | None]]:
    """Usable rows, rejected ones (file, reason, text), and counts, out of one pass over the source.

    All columns of the rows are stored with the reason, so both results read what one parse
    decided, and every landed record is in exactly one of them. The text is stored with rejected
    rows only. The counts are observed as the rows are stored: landed, kept, misfit, broken,
    empty, and the first and last ``page``.
    """
    own = F.col("_reason")
    rows = df.withColumn("_reason", reason)
    rows = rows.withColumn(text, F.when(own.isNotNull(), F.col(text)))
    page = F.lit(None).cast("int") if page is None else page
    seen = Observation()
    rows = rows.observe(
        seen,
        F.count(F.lit(1)).alias("landed"),
        F.count_if(own.isNull()).alias("kept"),
        *[F.count_if(own == r).alias(r) for r in ("misfit", "broken", "empty")],
        F.min(page).alias("first_page"),
        F.max(page).alias("last_page"),
    )
    stored = materialize(rows, name)
    rejected = stored.filter(own.isNotNull()).select(
        F.col(file).alias("file"), own.alias("reason"), F.col(text).alias("text")
    )
    return stored.filter(own.isNull()).drop("_reason", text), rejected, dict(seen.get)


LOADS = (
    "load_id string, at timestamp, scope string, landed bigint, kept bigint, misfit bigint, "
    "broken bigint, empty bigint, first_page int, last_page int"
)


def note_load(
    spark: SparkSession, path: str, counts: dict, scope: str = "all", mode: str = "append"
) -> None:
    """Write one row about a load, by default to the others of the table at ``path``."""
    row = spark.createDataFrame([(str(uuid.uuid4()), scope, *counts.values())], _NOTED)
    at = row.select("load_id", F.current_timestamp().alias("at"), "scope", *counts)
    at.coalesce(1).write.mode(mode).parquet(path)


_NOTED = ", ".join(f for f in LOADS.split(", ") if not f.startswith("at "))
