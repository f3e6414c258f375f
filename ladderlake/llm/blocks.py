"""Blocks of documents that tasks can return to, and compact lists that travel between them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
LAST = np.iinfo(np.int64).max


def in_blocks(
    docs: DataFrame, text_col: str, row_col: str, block_col: str, size: int = BLOCK_BYTES
) -> tuple[DataFrame, int]:
    """The documents with a row number and a block number, and the bytes of all texts.

    Rows are dealt to blocks by a hash of their number in scan order, so neither a repeated
    id nor equal texts meet in one block. Every pass over the blocks is grouped by the same
    column of the same frame: within one query Spark runs that exchange once and reuses it.
    """
    column = F.col(f"`{text_col}`")
    held = F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint")
    total = docs.agg(F.sum(held + 64)).first()[0] or 0
    n_blocks = max(1, -(-total // size))
    numbered = docs.withColumn(row_col, F.monotonically_increasing_id())
    block = F.pmod(F.xxhash64(F.col(row_col)), F.lit(n_blocks))
    return numbered.withColumn(block_col, block), total


def in_order(table: pa.Table, id_col: str, row_col: str) -> pa.Table:
    """The block's documents by (id, row number), null ids last."""
    ids = ids_of(table, id_col)
    return table.take(pa.array(np.lexsort((table.column(row_col).to_numpy(), ids))))


def ids_of(table: pa.Table, id_col: str) -> np.ndarray:
    return table.column(id_col).cast(pa.int64()).fill_null(LAST).to_numpy()


def pack(values: np.ndarray) -> bytes:
    """Increasing numbers as gaps, seven bits a byte."""
    values = values.astype(np.uint64)
    gaps = np.diff(values, prepend=np.uint64(0))
    size = np.ones(len(gaps), np.int64)
    for k in range(1, 10):
        if not (more := gaps >= np.uint64(1) << np.uint64(7 * k)).any():
            break
        size += more
    starts = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        part = (gaps[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[starts[has] + k] = part.astype(np.uint8) | ((size[has] > k + 1).astype(np.uint8) << 7)
    return out.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    starts = np.concatenate([[0], np.flatnonzero(data < 128)[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    parts = (data & 127).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.cumsum(np.add.reduceat(parts, starts), dtype=np.uint64)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)
