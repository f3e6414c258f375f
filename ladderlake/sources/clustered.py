"""Layouts that later reads profit from: buckets for joins, ranges and bloom filters for filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None
) -> DataFrame:
    """Store a table, known to the catalogue as ``name``, in sorted buckets of a key.

    Joins and groupings by the key then read it in place, without a shuffle, however often it is
    looked up; the other side alone is shuffled, into as many parts. One shuffle here makes one
    file for each bucket, so take as many buckets as keep one at a task's size; a key that
    fills more than its share is left to one bucket.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def _rank(column: str, bounds: Sequence) -> Column:
    """How many of the sorted bounds a value reaches, by halves; nulls come first."""
    c = F.col(column)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low + 1)
        middle = (low + high) // 2
        return F.when(c >= F.lit(bounds[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return F.when(c.isNull(), F.lit(0)).otherwise(search(0, len(bounds)))


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of all ranks in turn, from the highest to the lowest, as one number."""
    out = F.lit(0).cast("bigint")
    for b in range(bits):
        for k, rank in enumerate(ranks):
            bit = F.shiftright(rank.cast("bigint"), b).bitwiseAND(F.lit(1).cast("bigint"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(ranks) + k))
    return out


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    bloom: Sequence[str] = (),
    files: int | None = None,
    bits: int = 6,
    distinct: int = 1 << 20,
    options: dict | None = None,
) -> str:
    """Store a table so that filters on ``cluster_by`` and on ``bloom`` skip most of it.

    The values of each numeric or time column of ``cluster_by`` are ranked among 2^bits
    quantiles, the bits of the ranks are interleaved, and the rows laid out in ranges of that
    number, sorted within their file: rows near each other in all columns are stored together,
    and the bounds in the footers rule row groups out. For the columns of ``bloom``, footers get
    bloom filters, sized for ``distinct`` values in a row group; equality with a value that a
    row group lacks skips it. ``df`` is scanned twice more, for quantiles and for ranges.
    """
    steps = [k / 2**bits for k in range(1, 2**bits - 1)]
    quantiles = df.agg(*[F.percentile_approx(c, steps, 10_000).alias(c) for c in cluster_by]).first()
    ranks = [_rank(c, sorted(set(quantiles[c] or []))) for c in cluster_by]
    order = interleaved(ranks, bits)
    laid_out = df.repartitionByRange(files, order) if files else df.repartitionByRange(order)
    writer = laid_out.sortWithinPartitions(order).write.mode("overwrite").options(**(options or {}))
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    writer.parquet(path)
    return path
