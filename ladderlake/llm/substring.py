"""Substring deduplication of word windows behind a count-min prefilter.

Pass 1. Every block of documents hashes its windows of ``window`` words and makes a partition
sketch: for each of ``DEPTH`` rows the cells its windows fall into. A sketch is kept sparse,
as sorted cells, cut into ranges of cells. Tasks merge the sketches range by range in dense
counters, and tell each block which of its cells count two or more. The sketch has 16 cells
or more for each window at any size of the input, so its filter does not wear out.

Pass 2. A window whose least counter is below two occurs once; it is dropped. Of the others,
each block sends the first occurrence of each distinct window, as 128 bits of hash with its
place, and tasks by ranges of the hash group these exactly and tell each block which of its
windows are the first of all. Everything else that was sent or stands behind a sent window in
its block is a repetition, and its words are removed.

No window is lost: counters never underestimate. A window that all documents share reaches
pass 2 once for each block.

Order of occurrences: by id, then row in scan order, then place. Defined results: a null or
empty text has no words; documents shorter than a window lose nothing; a null id sorts last;
documents that share an id count in scan order; a repeated row is a later copy; a very long text
is in one block with the others dealt to it, and whole; an empty table gives an empty one; extra
columns travel along and the added ones evade their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ladderlake.llm import blocks
from ladderlake.llm.text import (
    Words,
    column_name,
    covered,
    hashes,
    mix,
    per_text,
    runs,
    tidy,
    window_hashes,
    words,
)

WINDOW = 20
DEPTH = 2
RANGE_BITS = 26  # cells of one merging task: 64 MB of counters
CELLS_EACH = 16

_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in map(str.split, ddl.split(", "))])


_SEEDS = np.array([0x9AE16A3B2F90404F, 0xC949D7C7509E6557], np.uint64)


def cell_bits(total_bytes: int) -> int:
    """Bits of a cell's number: at least 16 cells for each word of 4 bytes."""
    return max(RANGE_BITS, (CELLS_EACH * total_bytes // 4).bit_length())


class Windows:
    """All windows of a block's documents, in order, and the cells of each."""

    def __init__(self, table: pa.Table, text_col: str, window: int, n_bits: int):
        self.words: Words = words(table.column(text_col))
        codes, dictionary = self.words.codes()
        lanes = hashes(dictionary)[codes]
        of = self.words.of()
        n = max(0, len(of) - window + 1)
        self.starts = np.flatnonzero(of[:n] == of[window - 1 :])
        self.doc = of[self.starts]
        self.one, self.two = (
            window_hashes(np.ascontiguousarray(lanes[:, k]), window)[self.starts] for k in (0, 1)
        )
        self.n_bits = n_bits

    def cells(self, row: int) -> np.ndarray:
        hashed = mix(self.one, np.broadcast_to(_SEEDS[row], self.one.shape))
        return hashed >> np.uint64(64 - self.n_bits)

    def sketch(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(row, range, sorted distinct cells within the range)."""
        for row in range(DEPTH):
            cells = np.sort(self.cells(row))
            cells = cells[np.diff(cells, prepend=cells[:1] - np.uint64(1)) != 0]
            yield from ((row, *part) for part in by_range(cells))

    def repeated(self, counted: dict[tuple[int, int], bytes]) -> np.ndarray:
        """True for windows whose least counter is two or more."""
        out = np.ones(len(self.starts), bool)
        for row in range(DEPTH):
            cells, of, n = np.unique(self.cells(row), return_inverse=True, return_counts=True)
            twice = n > 1
            at = 0
            for place, own in by_range(cells):
                twice[at : at + len(own)] |= blocks.flags(counted[row, place], len(own))
                at += len(own)
            out &= twice[of]
        return out

    def candidates(self, counted: dict[tuple[int, int], bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the windows estimated repeated, and which are the block's first."""
        found = np.flatnonzero(self.repeated(counted))
        one, two = self.one[found], self.two[found]
        order = np.lexsort((found, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        first = np.zeros(len(order), bool)
        first[order[new]] = True
        return found, first


def by_range(cells: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    places = (cells >> np.uint64(RANGE_BITS)).astype(np.int64)
    starts = np.flatnonzero(np.diff(places, prepend=-1))
    for low, high in zip(starts, np.append(starts[1:], len(places))):
        yield int(places[low]), cells[low:high] & np.uint64((1 << RANGE_BITS) - 1)


def merge_sketches(table: pa.Table) -> Iterator[tuple[int, bytes]]:
    """For each block's cells of one range: which of them count two or more."""
    counters = np.zeros(1 << RANGE_BITS, np.uint8)
    lists = [blocks.unpack(raw) for raw in table.column("cells").to_pylist()]
    for cells in lists:
        counters[cells] = np.minimum(counters[cells] + 1, 2)
    for block, cells in zip(table.column("block").to_pylist(), lists):
        yield block, blocks.bits(counters[cells] >= 2)


def first_of_all(rows: list[dict]) -> Iterator[np.ndarray]:
    """For each block's windows of one range of hashes: which occur nowhere earlier."""
    lists = [_Sent(row) for row in rows]
    join = lambda name: np.concatenate([getattr(x, name) for x in lists])
    one, two, ids, row, start = map(join, ("one", "two", "ids", "row", "start"))
    order = np.lexsort((start, row, ids, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    first = np.zeros(len(order), bool)
    first[order[new]] = True
    yield from np.split(first, np.cumsum([len(x.one) for x in lists])[:-1])


class _Sent:
    """Windows as they travel: hashes, and places in the order of the block."""

    def __init__(self, row: dict):
        self.one, self.two = (np.frombuffer(row[k], np.uint64) for k in ("one", "two"))
        n = np.frombuffer(row["n"], np.uint32)
        self.ids = np.repeat(np.frombuffer(row["ids"], np.int64), n)
        self.row = np.repeat(np.frombuffer(row["rows"], np.int64), n)
        self.start = blocks.unpack(row["start"]).astype(np.int64)


def send(own: Windows, ids: np.ndarray, rows: np.ndarray, number: np.ndarray, n_ranges: int):
    """(range, record) of the windows ``number``, which are in the block's order."""
    # The place of a word in the block grows with the document's order, as starts do.
    place = (own.one[number] >> np.uint64(32)).astype(np.int64) * n_ranges >> 32
    for part in np.unique(place):
        here = number[place == part]
        docs, n = np.unique(own.doc[here], return_counts=True)
        yield int(part), {
            "one": own.one[here].tobytes(),
            "two": own.two[here].tobytes(),
            "ids": ids[docs].tobytes(),
            "rows": rows[docs].tobytes(),
            "n": n.astype(np.uint32).tobytes(),
            "start": blocks.pack(own.starts[here]),
        }


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_col: str = "n_words",
    removed_col: str = "n_removed",
    block_bytes: int = blocks.BLOCK_BYTES,
) -> DataFrame:
    """The documents without words covered by a window that also starts earlier.

    A removed run is cut from its first word to the next word that stays; the rest of the
    text keeps its bytes. Two columns tell how many words a text had and lost.
    """
    row_col, block_col, words_col, removed_col = (
        column_name(c, docs.columns) for c in ("row", "block", words_col, removed_col)
    )
    texts, total = blocks.in_blocks(docs, text_col, row_col, block_col, block_bytes)
    n_bits = cell_bits(total)
    n_ranges = max(1, total // (64 << 20))

    def opened(table: pa.Table) -> tuple[pa.Table, Windows]:
        tidy()
        table = blocks.in_order(table, id_col, row_col)
        return table, Windows(table, text_col, window, n_bits)

    def sketch(key: tuple, table: pa.Table) -> pa.Table:
        _, own = opened(table)
        rows = [
            {"sketch": s, "place": p, "block": key[0].as_py(), "cells": blocks.pack(cells)}
            for s, p, cells in own.sketch()
        ]
        return pa.Table.from_pylist(rows, _schema(sketches_ddl))

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        tidy()
        s, p = (k.as_py() for k in key)
        rows = [
            {"block": b, "kind": s, "place": p, "flags": raw} for b, raw in merge_sketches(table)
        ]
        return pa.Table.from_pylist(rows, _schema(answers_ddl))

    def answers(table: pa.Table) -> tuple[dict, dict]:
        counted, first = {}, {}
        for row in table.to_pylist():
            into = first if row["kind"] == DEPTH else counted
            into[(row["kind"], row["place"]) if into is counted else row["place"]] = row["flags"]
        return counted, first

    def candidates(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        if table.num_rows:
            table, own = opened(table)
            found, first = own.candidates(answers(told)[0])
            ids, numbers = blocks.ids_of(table, id_col), table.column(row_col).to_numpy()
            for part, sent in send(own, ids, numbers, found[first], n_ranges):
                rows.append({"place": part, "block": key[0].as_py(), **sent})
        return pa.Table.from_pylist(rows, _schema(sent_ddl))

    def decide(key: tuple, table: pa.Table) -> pa.Table:
        tidy()
        sent, place = table.to_pylist(), key[0].as_py()
        rows = [
            {"block": row["block"], "kind": DEPTH, "place": place, "flags": blocks.bits(first)}
            for row, first in zip(sent, first_of_all(sent))
        ]
        return pa.Table.from_pylist(rows, _schema(answers_ddl))

    names = [*docs.columns, words_col, removed_col]

    def remove(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        table, own = opened(table)
        counted, told_first = answers(told)
        found, first = own.candidates(counted)
        sent = found[first]
        place = (own.one[sent] >> np.uint64(32)).astype(np.int64) * n_ranges >> 32
        stays = np.zeros(len(own.starts), bool)
        for part in np.unique(place):
            here = sent[place == part]
            stays[here] = blocks.flags(told_first[int(part)], len(here))
        gone = found[~stays[found]]
        return cut(table, own.words, covered(own.starts[gone], window, len(own.words)))

    def cut(table: pa.Table, own: Words, gone: np.ndarray) -> pa.Table:
        texts = table.column(text_col).to_pylist()
        starts, ends = runs(gone, own.first)
        doc = np.searchsorted(own.first, starts, "right") - 1
        for d in np.unique(doc):
            raw, at, left = texts[d].encode(), own.offsets[d], []
            for k in np.flatnonzero(doc == d):
                left.append(raw[at - own.offsets[d] : own.starts[starts[k]] - own.offsets[d]])
                last = ends[k] == own.first[d + 1]
                at = own.offsets[d + 1] if last else own.starts[ends[k]]
            texts[d] = b"".join([*left, raw[at - own.offsets[d] :]]).decode()
        place = table.column_names.index(text_col)
        table = table.set_column(place, text_col, pa.array(texts, pa.string()))
        table = table.append_column(words_col, pa.array(np.diff(own.first)))
        table = table.append_column(removed_col, pa.array(per_text(gone, own.first)))
        return table.select(names)

    sketches_ddl = "sketch int, place bigint, block bigint, cells binary"
    answers_ddl = "block bigint, kind int, place bigint, flags binary"
    sent_ddl = (
        "place bigint, block bigint, one binary, two binary, ids binary, rows binary, "
        "n binary, start binary"
    )
    sketches = texts.groupBy(block_col).applyInArrow(sketch, sketches_ddl)
    counted = sketches.groupBy("sketch", "place").applyInArrow(merge, answers_ddl)
    by_block = texts.groupBy(block_col)
    sent = by_block.cogroup(counted.groupBy("block")).applyInArrow(candidates, sent_ddl)
    firsts = sent.groupBy("place").applyInArrow(decide, answers_ddl)
    told = counted.unionByName(firsts)
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField(words_col, T.LongType()),
            T.StructField(removed_col, T.LongType()),
        ]
    )
    return by_block.cogroup(told.groupBy("block")).applyInArrow(remove, schema)
