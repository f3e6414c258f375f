"""Two-pass external shuffle of records into shards.

Pass 1 scatters the records by seeded hashes into buckets that fit into memory; pass 2
shuffles each bucket with Fisher-Yates, from a generator seeded with the bucket's number,
and the shuffled records are written. A shard is the row of its buckets, so its order is a
uniform permutation.

Law ``key``: a record's shard follows from its id and the number of shards by jump
consistent hashing; with one shard more, records move into the new shard only. A repeated id
makes its shard larger than the others, so each shard gets as many buckets as its own bytes
need. Within a shard, the bucket follows from a number given to each record in scan order, so
that neither a repeated id nor equal records fill one bucket. The order is the same in every
run over the same files with the same split sizes. A shard is written as a folder of its own,
each file in the order of its slots.

Defined results: a null id is hashed like a value; null texts count no bytes of their own;
repeated rows are records of their own; an empty table gives an empty one; extra columns
travel along, and the added columns evade their names; a record larger than a bucket makes its
bucket larger by itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.llm.text import column_name
from ladderlake.session import staging_path

BUCKET_BYTES = 16 << 20
SEED = 20250711


def jump_hash(keys: np.ndarray, n: int) -> np.ndarray:
    """Jump consistent hash of unsigned 64-bit keys into 0..n-1 (Lamping and Veach)."""
    keys = np.array(keys, np.uint64)
    shard = np.zeros(len(keys), np.int64)
    step = np.zeros(len(keys), np.int64)
    while (open_ := np.flatnonzero(step < n)).size:
        shard[open_] = step[open_]
        keys[open_] = keys[open_] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (keys[open_] >> np.uint64(33)).astype(np.float64) + 1
        step[open_] = ((shard[open_] + 1) * (float(1 << 31) / draw)).astype(np.int64)
    return shard


def shard_of(key: F.Column, n_shards: int, seed: int = SEED) -> F.Column:
    """The shard that an id falls into: the law ``key``."""

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy().view(np.uint64), n_shards).astype(np.int32))

    return shard(F.xxhash64(F.lit(seed), key))


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation of 0..n-1 (numpy shuffles by Fisher-Yates)."""
    order = np.arange(n)
    np.random.Generator(np.random.PCG64(seed)).shuffle(order)
    return order


def scatter(
    df: DataFrame,
    n_shards: int,
    id_col: str,
    text_col: str,
    seed: int,
    bucket_bytes: int,
    names: tuple[str, str, str],
) -> DataFrame:
    """The records with shard, number in scan order, and bucket: columns ``names``."""
    shard_col, record, bucket = names
    size = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("bigint") + 8
    shard = shard_of(F.col(f"`{id_col}`"), n_shards, seed)
    held = df.select(shard.alias("shard"), size.alias("size")).groupBy("shard").agg(F.sum("size"))
    # One row for each shard: its buckets lie between those of its neighbours.
    n_bytes = {row[0]: row[1] for row in held.collect()}
    n_buckets = [max(1, -(-n_bytes.get(k, 0) // bucket_bytes)) for k in range(n_shards)]
    first = np.concatenate([[0], np.cumsum(n_buckets)[:-1]]).tolist()
    own = lambda values: F.element_at(
        F.from_json(F.lit(str(values)), "array<bigint>"), F.col(shard_col) + 1
    )
    in_shard = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(record)), own(n_buckets))
    return df.select(
        "*", shard.alias(shard_col), F.monotonically_increasing_id().alias(record)
    ).withColumn(bucket, own(first) + in_shard)


def shard_records(
    df: DataFrame,
    n_shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    shard_col: str = "shard",
    slot_col: str = "slot",
) -> DataFrame:
    """All records, shuffled and written to the shared folder, with shard and slot.

    ``df`` has to be a stored table: it is scanned to measure the shards, to count the buckets,
    whose sizes give the slots, and to scatter the records. Should the scans differ, the job
    fails.
    """
    shard_col, slot_col, record, bucket = (
        column_name(c, df.columns) for c in (shard_col, slot_col, "record", "bucket")
    )
    numbered = scatter(df, n_shards, id_col, text_col, seed, bucket_bytes, (shard_col, record, bucket))

    sizes = numbered.groupBy(shard_col, bucket).agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy(shard_col).orderBy(bucket)) - F.col("n")
    slots = sizes.select(bucket, "n", earlier.alias("first"))

    names = [*df.columns, shard_col, slot_col]
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField(shard_col, T.IntegerType()),
            T.StructField(slot_col, T.LongType()),
        ]
    )

    def shuffle(key: tuple, held: pa.Table, counted: pa.Table) -> pa.Table:
        if held.num_rows != counted.column("n")[0].as_py():
            raise ValueError("the records are not the ones that were counted")
        held = held.take(pa.array(np.argsort(held.column(record).to_numpy())))
        held = held.take(pa.array(fisher_yates(held.num_rows, [seed, key[0].as_py()])))
        slot = counted.column("first")[0].as_py() + np.arange(held.num_rows)
        return held.append_column(slot_col, pa.array(slot)).select(names)

    groups = numbered.groupBy(bucket).cogroup(slots.groupBy(bucket))
    shuffled = groups.applyInArrow(shuffle, schema).sortWithinPartitions(shard_col, slot_col)
    path = staging_path(df.sparkSession, "shards")
    shuffled.write.partitionBy(shard_col).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path).select(names)
