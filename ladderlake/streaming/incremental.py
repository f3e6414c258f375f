"""Incremental pick-up of landed files."""

from __future__ import annotations

from collections.abc import Callable
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ladderlake.functions import page_number
from ladderlake.session import path_exists, staging
from ladderlake.sources import (
    is_broken,
    is_misfit,
    landed_files,
    not_yet_loaded,
    note_load,
    parse_once,
    read_table,
    why_rejected,
)

# A thousand years: longer than any file time can be old.
MAX_FILE_AGE = "365000d"


def unloaded_files(
    spark: SparkSession,
    source: str,
    table: str,
    glob: str = "*.json",
    table_format: str = "parquet",
    file_column: str = "source_file",
) -> DataFrame:
    """Landed files of which neither the table nor its rejects have a row."""
    landed = landed_files(spark, source, glob).withColumnRenamed("path", file_column)
    # Both are paths as Spark writes them, but one may be escaped like an address.
    landed = landed.withColumn(file_column, _plain(file_column))
    loaded = read_table(spark, table, table_format).select(_plain(file_column).alias(file_column))
    rejects = f"{table.rstrip('/')}_rejects"
    if path_exists(spark, rejects):
        rejected = read_table(spark, rejects).withColumnRenamed("file", file_column)
        loaded = loaded.unionByName(rejected.select(_plain(file_column).alias(file_column)))
    return not_yet_loaded(landed, loaded.distinct(), file_column)


def _plain(path: str) -> Column:
    return F.regexp_replace(F.try_url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def load_new_files(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    schema: T.StructType | str,
    glob: str = "*.json",
    fmt: str = "json",
    table_format: str = "parquet",
    files_per_batch: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    file_column: str | None = "source_file",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    options: dict | None = None,
    rejects: str | None = None,
    save: Callable[[DataFrame, str], None] | None = None,
    metadata: dict[str, str] | None = None,
) -> StreamingQuery:
    """Append the files landed since the last run, and return the finished query.

    The checkpoint remembers which files are loaded. Each batch is parsed once and stored; its
    usable rows, its rejects (file, reason, text) and its counts then go to the folder
    ``load_batch=<query>-<batch>`` of ``table``, of ``rejects`` (by default
    ``<table>_rejects``) and of ``<table>_loads``. A batch that is repeated after a failure
    replaces its own folders, so nothing is added twice. Rejected are broken JSON, records with
    a value that does not fit its declared type (of an array, all records) and records without
    any declared value.

    ``files_per_batch`` bounds one batch on a large backlog. A file older than the newest
    one seen by more than ``max_file_age`` is taken as loaded; the default is
    longer than any file time can be old, and a shorter one bounds the list of files that
    the driver remembers. ``unloaded_files`` tells what was left out. ``transform`` works
    on the usable rows of a batch, e.g. to explode landed matches; it must not
    group them, as each batch has only new files. ``save`` takes the place of the append: it
    gets the rows and the batch's name, and must give the same result when it is repeated.
    ``metadata`` adds columns about the file of each row, as in ``scan_json``.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    if fmt == "json":
        schema = T.StructType([*schema.fields, T.StructField("_text", T.StringType())])
    reader = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", max_file_age)
        .option("columnNameOfCorruptRecord", "_text")
        .options(**(options or {}))
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    about = {"_file": "file_path", **(metadata or {})}
    rows = reader.load(source)
    rows = rows.withColumns({name: F.col(f"_metadata.{f}") for name, f in about.items()})
    if fmt != "json":
        rows = rows.withColumn("_text", F.lit(None).cast("string"))
    reason = why_rejected(names, is_broken("_text"), is_misfit("_text"))
    base = table.rstrip("/")
    started, run = Event(), []

    def append(df: DataFrame, path: str, batch: str, kind: str = "parquet") -> None:
        if kind == "delta":
            query, _, number = batch.rpartition("-")
            writer = df.withColumn("load_batch", F.lit(batch)).write.format("delta").mode("append")
            writer.options(txnAppId=query, txnVersion=number).save(path)
        else:
            df.write.format(kind).mode("overwrite").save(f"{path}/load_batch={batch}")

    def store(batch: DataFrame, number: int) -> None:
        started.wait()
        own, name = batch.sparkSession, f"{run[0].id}-{number}"
        with staging(own):
            kept, rejected, counts = parse_once(batch, reason, "batch", page=page_number("_file"))
            kept = kept.withColumnRenamed("_file", file_column) if file_column else kept.drop("_file")
            kept = transform(kept) if transform else kept
            if save:
                save(kept, name)
            else:
                append(kept, base, name, table_format)
            append(rejected, rejects or f"{base}_rejects", name)
            note_load(own, f"{base}_loads/load_batch={name}", counts, mode="overwrite")

    query = (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.append(query)
    started.set()
    query.awaitTermination()
    return query
