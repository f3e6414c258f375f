"""Tables that are changed in part: merged by hash buckets of a key, or published by digest."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.session import delete_path, materialize, path_exists
from ladderlake.sources.landing import latest_per_key
from ladderlake.sources.tables import read_table, write_table

BUCKETS = 64
_BETWEEN, _NONE = "\x01", "\x02"


def bucket_column(buckets: int) -> str:
    """The partition column of a merged table; its name says how many buckets there are."""
    return f"bucket_of_{buckets}"


def _mark(columns: Sequence[str]) -> Column:
    """Partition values as one text, nulls included."""
    return F.concat_ws(_BETWEEN, *[F.coalesce(F.col(c).cast("string"), F.lit(_NONE)) for c in columns])


def _marks(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return sorted(row[0] for row in df.select(_mark(columns)).distinct().collect())


def stored_partitions(spark: SparkSession, path: str, columns: Sequence[str], marks: Sequence[str]) -> DataFrame:
    """The rows of some partitions; the files of others are not listed for the scan."""
    return read_table(spark, path, merge=True).filter(_mark(columns).isin(list(marks)))


def merge_latest(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[Column],
    partition_by: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> list[str]:
    """Merge rows into a table that has one row per key, the first in ``order``.

    The table is partitioned by ``partition_by``, which are among the keys, and by a hash of
    the key in ``buckets`` parts. Only the partitions that the new rows fall in are read, joined
    by their keys and replaced; the result names them. A merge that is repeated, also after a
    failure half way, gives the same table. ``order`` uses stored columns only. A new key costs
    its bucket, so take as many buckets as keep one at some files.
    """
    spark = df.sparkSession
    bucket = bucket_column(buckets)
    layout = [*partition_by, bucket]
    hashed = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")
    new = latest_per_key(df, keys, order).withColumn(bucket, hashed.cast("string"))
    new = materialize(new, "new")
    touched = _marks(new, layout)
    if not touched:
        return touched
    if path_exists(spark, path):
        stored = read_table(spark, path, merge=True)
        if bucket not in stored.columns:
            raise ValueError(f"{path} is not in {buckets} buckets")
        old = stored_partitions(spark, path, layout, touched)
        new = latest_per_key(old.unionByName(new, allowMissingColumns=True), keys, order)
        new = materialize(new, "merged")
    write_table(new, path, partition_by=layout, replace="partitions")
    return touched


_AS_TEXT = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def partition_digests(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """For each partition its rows and a digest that does not depend on their order.

    The digest is the sum and the exclusive or of two 64-bit hashes of each row, so one pass
    with partial aggregates makes it; a repeated row counts. Where a null stands matters.
    """
    own = [f for f in df.schema.fields if f.name not in partition_by]
    options = {"ignoreNullFields": "false"}
    values = [F.to_json(f.name, options) if isinstance(f.dataType, _AS_TEXT) else F.col(f"`{f.name}`") for f in own]
    absent = [F.col(f"`{f.name}`").isNull() for f in own]
    names = F.lit(",".join(sorted(f"{f.name} {f.dataType.simpleString()}" for f in own)))
    ordered = [v for _, v in sorted(zip([f.name for f in own], [*zip(values, absent)]), key=lambda x: x[0])]
    flat = [x for pair in ordered for x in pair]
    total = F.sum(F.xxhash64(F.lit(1), *flat).cast("decimal(38,0)")).cast("string")
    mixed = F.bit_xor(F.xxhash64(F.lit(2), *flat)).cast("string")
    digest = F.concat_ws(":", total, mixed, F.hash(names).cast("string"))
    return df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("row_count"), digest.alias("digest"))


def publish_changed(
    spark: SparkSession, source: DataFrame, target: str, partition_by: Sequence[str]
) -> DataFrame:
    """Make a partitioned table equal to ``source``, rewriting only partitions that differ.

    The digests of what was published are kept at ``<target>_digests``; those of the source
    take one pass, and decide. Partitions that are gone are deleted. A row for each partition
    says what was done: ``written``, ``kept`` or ``deleted``. A run that fails half way is made
    up for by the next one, as the digests of what is about to change are dropped first. The
    table must not be changed by others.
    """
    noted = f"{target.rstrip('/')}_digests"
    now = materialize(partition_digests(source, partition_by), "digests")
    known = path_exists(spark, target) and path_exists(spark, noted)
    if known:
        before = materialize(read_table(spark, noted), "noted")
    else:
        before = now.limit(0)
    keys = [_mark(partition_by).alias("_mark")]
    a = now.select(*partition_by, "row_count", "digest", *keys)
    b = before.select(F.col("digest").alias("_digest"), *keys, *[F.col(c).alias(f"_{c}") for c in partition_by])
    both = a.join(b, "_mark", "full")
    done = F.when(F.col("digest").isNull(), "deleted").when(
        F.col("digest").eqNullSafe(F.col("_digest")), "kept"
    )
    both = both.select(
        *[F.when(F.col("digest").isNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in partition_by],
        F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
        "_mark",
        done.otherwise("written").alias("action"),
    )
    both = materialize(both, "actions")
    # Partition values: as many as the table has folders.
    marks = {kind: [] for kind in ("written", "deleted", "kept")}
    for row in both.select("_mark", "action").collect():
        marks[row.action].append(row["_mark"])

    if marks["written"] or marks["deleted"]:
        still = before.filter(_mark(partition_by).isin(marks["kept"]))
        still.write.mode("overwrite").parquet(noted)
        if not known:
            write_table(source, target, partition_by=partition_by, rebalance=False)
        else:
            _delete_partitions(spark, target, partition_by, marks["deleted"])
            fresh = source.filter(_mark(partition_by).isin(marks["written"]))
            if marks["written"]:
                write_table(fresh, target, partition_by=partition_by, replace="partitions", rebalance=False)
        now.write.mode("overwrite").parquet(noted)
    return both.drop("_mark")


def _delete_partitions(spark: SparkSession, path: str, columns: Sequence[str], marks: Sequence[str]) -> None:
    if not marks:
        return
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1)
    for row in stored_partitions(spark, path, columns, marks).select(folder).distinct().collect():
        delete_path(spark, unquote(row[0]))
