"""Path-addressed tables and CSV export."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.session import delete_path, dropping_shuffles, path_exists


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    merge: bool = False,
) -> DataFrame:
    """Table at a path. Declaring fewer columns or nested fields reads fewer.

    ``merge`` takes the columns of all Parquet files together, which reads every
    footer: partitions that were replaced one by one may have other columns.
    ``fmt="delta"`` needs Delta's own classes and has not been run.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if merge and fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    replace: str = "all",
    rebalance: bool = True,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Overwrite a table, or with ``replace="partitions"`` only those in ``df``.

    With "all", schema and data are both replaced; with "partitions", other partitions
    keep their rows and columns (see ``read_table(merge=True)``). The rebalance makes
    files of the advisory size: hot partitions are split and small ones merged. ``finish``
    makes the stored rows out of those of ``df`` after the rebalance, so what it can derive
    does not travel. Do not write to a path that ``df`` reads. ``fmt="delta"`` has not been run.
    """
    if replace not in ("all", "partitions"):
        raise ValueError(f"replace: {replace}")
    if replace == "partitions" and not partition_by:
        raise ValueError('replace="partitions" needs partition_by')
    laid_out = df.hint("rebalance", *partition_by) if rebalance else df
    laid_out = finish(laid_out) if finish else laid_out
    mode = "dynamic" if replace == "partitions" else "static"
    writer = (
        laid_out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", mode)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "delta" and replace == "all":
        writer = writer.option("overwriteSchema", "true")
    with dropping_shuffles(df.sparkSession):
        writer.save(path)
    return path


def replace_values(
    df: DataFrame,
    path: str,
    column: str,
    values: Sequence[str],
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
) -> str:
    """Replace all partitions in which ``column`` has one of the named values.

    ``column`` is the first of ``partition_by``. Partitions of these values that ``df``
    no longer has are emptied, so a value without rows ends up with none. ``df`` must
    hold no other values; it is evaluated once. Readers see the new partitions of one commit
    before the old ones are gone; a Delta table would replace both in one
    commit, which has not been run.
    """
    spark = df.sparkSession
    if fmt == "delta":
        named = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
        laid_out = df.hint("rebalance", *partition_by) if rebalance else df
        writer = laid_out.write.format(fmt).mode("overwrite").partitionBy(*partition_by)
        writer.option("replaceWhere", f"{column} in ({named})").save(path)
        return path
    old = _one_file_each(spark, path, column, values)
    write_table(df, path, fmt, partition_by, "partitions", rebalance)
    # A folder that still has its old file was not written: its values are gone from df.
    for file in old:
        if path_exists(spark, file):
            delete_path(spark, file.rsplit("/", 1)[0])
    return path


def _one_file_each(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> list[str]:
    """A stored file of every partition of the named values, which bound the list."""
    if not path_exists(spark, path):
        return []
    stored = read_table(spark, path).filter(F.col(column).isin(list(values)))
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1)
    found = stored.groupBy(folder).agg(F.min("_metadata.file_path").alias("file"))
    return [unquote(row.file) for row in found.collect()]


def _flat(df: DataFrame) -> DataFrame:
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema
        ]
    )


# For writing and reading alike: quotes are doubled, texts keep their lines and spaces.
CSV_OPTIONS = {
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    """CSV export with a header; nested and variant columns become JSON text.

    Every task writes its own file. Read texts of several lines with ``CSV_OPTIONS``.
    """
    writer = _flat(df).write.format("csv").mode("overwrite").options(**CSV_OPTIONS)
    writer.option("header", str(header).lower()).save(path)
    return path
