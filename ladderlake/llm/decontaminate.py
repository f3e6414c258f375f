"""Benchmark decontamination with suffix arrays over the training documents.

Every chunk of documents that a task scans is a shard: its words get a suffix array,
sorted as deep as a window is long, and every suffix of the benchmark items that starts a
window is binary-searched in it. All places found are kept, and neighbouring ones on the
same diagonal are joined into the longest verbatim matches. There is no shuffle.

The benchmark is the stated query set. It is written to the shared folder in blocks of a bounded
number of bytes, and a task reads one at a time; the last ``HELD_BLOCKS`` that were parsed are kept,
so a benchmark of that many blocks is parsed once in a task. Neither the driver nor a worker
holds it whole. A window that many items share is searched once; matches, which are as many as
places and items together, are listed only where they are asked for.

Defined results: a null or empty document has no words and no hit; a null or empty item
never occurs; an item of fewer words than a window is a window of its own; a null item_id
reads as the empty string; rows that repeat an item_id count as one item, whose texts are
all searched; repeated documents are judged one by one; an empty benchmark hits nothing.
Matches never cross a document's or an item's end. A very long document is a chunk of its own,
an empty table of documents gives an empty one, and columns of any name are carried along; the
added one evades them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ladderlake.llm.text import (
    ALNUM,
    chunks,
    column_name,
    covered,
    gather,
    per_text,
    words,
)
from ladderlake.session import reachable, staging_path
from ladderlake.sources.listing import open_path

WINDOW = 10
BLOCK_BYTES = 4 << 20
HELD_BLOCKS = 2

_MATCH = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("item_start", T.LongType()),
        T.StructField("doc_start", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)
LEAKS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("matches", T.ArrayType(_MATCH)),
    ]
)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes, sorted by their first ``depth`` codes at least.

    The first sort takes as many codes as fit into 63 bits; each further round doubles
    the depth and sorts only suffixes that still share a rank with others.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    bits = max(1, int(codes.max()).bit_length())
    known = max(1, min(depth, 63 // bits))
    padded = np.concatenate([codes, np.zeros(known, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(known):
        key = key << bits | padded[k : k + n]
    order = np.argsort(key)
    head = np.ones(n, bool)
    head[1:] = key[order[1:]] != key[order[:-1]]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = slots[head][np.cumsum(head) - 1]
    while known < depth:
        alone = head & np.append(head[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        open_ = order[slots]
        after = np.where(open_ + known < n, rank[np.minimum(open_ + known, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + after
        by = np.argsort(key)
        key, open_ = key[by], open_[by]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        order[slots] = open_
        head[slots] = first
        rank[open_] = slots[first][np.cumsum(first) - 1]
        known *= 2
    return order


class Items:
    """The windows of a block of benchmark items, as suffixes cut to a window's length."""

    def __init__(self, rows: list[tuple[str | None, str | None]], window: int):
        self.ids = [id_ or "" for id_, _ in rows]
        found = words(pa.array([text for _, text in rows], pa.string()), ALNUM, lower=True)
        self.codes, self.dictionary = found.codes()
        n = np.diff(found.first)
        of = found.of()
        place = np.arange(len(found)) - found.first[:-1][of]
        starts = (n[of] - place >= window) | (place == 0)
        self.starts = np.flatnonzero(starts)
        self.item = of[self.starts]
        self.place = place[self.starts]
        self.length = np.minimum(n[self.item], window)
        self.window = window
        self._kinds: tuple[np.ndarray, np.ndarray] | None = None
        self._owners: dict[int, tuple[str, ...]] = {}

    def kinds(self) -> tuple[np.ndarray, np.ndarray]:
        """One window of each distinct sequence of words, and which of these each window is."""
        if self._kinds is None:
            codes = np.append(self.codes, np.full(self.window, -1)).astype(np.int64)
            rows = codes[self.starts[:, None] + np.arange(self.window)]
            rows[np.arange(self.window) >= self.length[:, None]] = -1
            rows = np.ascontiguousarray(rows).view(f"V{8 * self.window}").ravel()
            _, first, own = np.unique(rows, return_index=True, return_inverse=True)
            self._kinds = first, own
            self._order = np.argsort(own, kind="stable")
            self._bounds = np.searchsorted(own[self._order], np.arange(len(first) + 1))
        return self._kinds

    def owners(self, kind: int) -> tuple[str, ...]:
        """The ids of the items that have a window of this kind."""
        if kind not in self._owners:
            held = self._order[self._bounds[kind] : self._bounds[kind + 1]]
            self._owners[kind] = tuple({self.ids[i] for i in self.item[held].tolist()})
        return self._owners[kind]


class Shard:
    """Words of a chunk of documents and their suffix array."""

    def __init__(self, column: pa.ChunkedArray, window: int):
        self.window = window
        self.words = words(column, ALNUM, lower=True)
        codes, self.dictionary = self.words.codes()
        # Code 0 stands behind every document, so that no match crosses its end.
        n_docs = len(self.words.first) - 1
        self.doc = self.words.of()
        self.at = np.arange(len(codes)) + self.doc
        self.codes = np.zeros(len(codes) + n_docs + window, np.int64)
        self.codes[self.at] = codes + 1
        self.suffixes = suffix_array(self.codes, window)

    def bound(self, wanted: np.ndarray, length: np.ndarray, right: bool) -> np.ndarray:
        """For each wanted row of codes the first suffix that is not below (not equal)."""
        low = np.zeros(len(wanted), np.int64)
        high = np.full(len(wanted), len(self.suffixes), np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) // 2
            at = self.suffixes[mid]
            below = np.full(len(open_), right)
            same = np.ones(len(open_), bool)
            for k in range(wanted.shape[1]):
                here = same & (k < length[open_])
                if not here.any():
                    break
                own = self.codes[np.minimum(at + k, len(self.codes) - 1)]
                differs = here & (own != wanted[open_, k])
                below[differs] = own[differs] < wanted[open_, k][differs]
                same &= ~differs
            low[open_] = np.where(below, mid + 1, low[open_])
            high[open_] = np.where(below, high[open_], mid)
        return low

    def search(self, items: Items, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window number, word number) of all places where one of the windows occurs."""
        if not len(which) or not len(self.doc):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = pc.index_in(items.dictionary, value_set=self.dictionary)
        known = known.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = np.append(known[items.codes], np.full(self.window, -1))
        wanted = codes[items.starts[which][:, None] + np.arange(self.window)] + 1
        length = items.length[which]
        inside = np.arange(self.window) < length[:, None]
        whole = np.flatnonzero(((wanted > 0) | ~inside).all(axis=1))
        wanted, length, which = wanted[whole], length[whole], which[whole]
        low = self.bound(wanted, length, right=False)
        counts = self.bound(wanted, length, right=True) - low
        place = self.suffixes[gather(low, counts)]
        return np.repeat(which, counts), np.searchsorted(self.at, place)


def longest(items: Items, window: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, ...]:
    """Join places that follow each other in item and document: (window, word, length)."""
    diagonal = word - items.starts[window]
    order = np.lexsort((word, items.item[window], diagonal))
    window, word, diagonal = window[order], word[order], diagonal[order]
    new = np.ones(len(word), bool)
    new[1:] = (
        (diagonal[1:] != diagonal[:-1])
        | (items.item[window][1:] != items.item[window][:-1])
        | (word[1:] != word[:-1] + 1)
    )
    last = np.append(np.flatnonzero(new)[1:], len(word)) - 1 if len(word) else np.zeros(0, int)
    return window[new], word[new], word[last] + items.length[window[last]] - word[new]


def leaks(shard: Shard, blocks: Iterable[Items], with_matches: bool = True) -> pa.StructArray:
    """One row of ``LEAKS`` for each document of the shard; no matches unless asked for."""
    first, n_docs = shard.words.first, len(shard.words.first) - 1
    hit = np.zeros(len(shard.doc), bool)
    names: dict[int, set[str]] = {}
    matches: dict[int, list[dict]] = {}
    for items in blocks:
        kinds, own = items.kinds()
        window, word = shard.search(items, np.arange(len(items.starts)) if with_matches else kinds)
        for length in np.unique(items.length[window]):
            hit |= covered(word[items.length[window] == length], int(length), len(hit))
        # Which kinds of windows each document holds, and whose they are.
        pairs = np.unique(np.stack([shard.doc[word], own[window]]), axis=1) if len(word) else []
        for doc, kind in np.transpose(pairs).tolist():
            names.setdefault(doc, set()).update(items.owners(kind))
        if not with_matches:
            continue
        for w, start, length in zip(*longest(items, window, word)):
            doc = int(shard.doc[start])
            matches.setdefault(doc, []).append(
                {
                    "item_id": items.ids[items.item[w]],
                    "item_start": int(items.place[w]),
                    "doc_start": int(start - first[doc]),
                    "length": int(length),
                }
            )
    order = lambda m: (m["doc_start"], m["item_id"], m["item_start"])
    fields = [
        pa.array(np.diff(first)),
        pa.array(per_text(hit, first)),
        pa.array([sorted(names.get(d, ())) for d in range(n_docs)], pa.list_(pa.string())),
        pa.array([sorted(matches.get(d, ()), key=order) for d in range(n_docs)], _MATCHES),
    ]
    return pa.StructArray.from_arrays(fields, names=LEAKS.names)


_MATCHES = pa.list_(to_arrow_type(_MATCH))


def store_blocks(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> tuple[str, int]:
    """The distinct items in folders of about ``size`` bytes; the path, and how many these are."""
    items = benchmark.select(
        F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text")
    ).distinct()
    held = F.coalesce(F.octet_length("text"), F.lit(0)) + 32
    total = items.agg(F.sum(held)).first()[0] or 0
    n = -(-total // size)
    path = staging_path(benchmark.sparkSession, "benchmark")
    if n:
        block = F.pmod(F.xxhash64("id", "text"), F.lit(n))
        items.withColumn("block", block).repartition("block").write.partitionBy("block").parquet(path)
    return path, n


class Blocks:
    """The stored blocks, parsed when a task gets to them; the last few are kept."""

    def __init__(self, path: str, n: int, window: int):
        self.path, self.n, self.window = path, n, window
        self.held: dict[int, Items] = {}

    def __iter__(self) -> Iterator[Items]:
        # Kept ones first, so that every round reads only the others.
        for k in sorted(range(self.n), key=lambda k: k not in self.held):
            if k not in self.held:
                while len(self.held) >= HELD_BLOCKS:
                    self.held.pop(next(iter(self.held)))
                self.held[k] = self._read(k)
            yield self.held[k]

    def _read(self, k: int) -> Items:
        system, within, _ = open_path(self.path)
        folder = f"{within}/block={k}"
        if system.get_file_info(folder).type == pyarrow.fs.FileType.NotFound:
            return Items([], self.window)
        table = pq.read_table(folder, columns=["id", "text"], filesystem=system)
        rows = list(zip(table.column("id").to_pylist(), table.column("text").to_pylist()))
        return Items(rows, self.window)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    carry: list[str] | None = None,
    leak_col: str = "leaks",
    with_matches: bool = True,
) -> DataFrame:
    """The documents (columns ``carry``, or all) with a struct of what leaked into them.

    The struct has the fields of ``LEAKS``: words, words inside occurring windows, the ids
    of items with such a window, and the longest matches with their places in words, of which
    there are none without ``with_matches``.
    """
    reachable(docs.sparkSession)
    path, n_blocks = store_blocks(benchmark, item_col, item_text_col, BLOCK_BYTES)
    carry = docs.columns if carry is None else carry
    leak_col = column_name(leak_col, carry)
    kept = docs.select(*[F.col(f"`{c}`") for c in carry])
    names = [*carry, leak_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(path, n_blocks, window)
        for table in chunks(batches, 0):
            found = leaks(Shard(table.column(0), window), blocks, with_matches)
            table = table.remove_column(0).combine_chunks()
            columns = [c.combine_chunks() for c in table.columns]
            yield pa.RecordBatch.from_arrays([*columns, found], names=names)

    schema = T.StructType([*kept.schema.fields, T.StructField(leak_col, LEAKS)])
    text = F.col(f"`{text_col}`").alias(column_name("text", carry))
    return docs.select(text, *kept.columns).mapInArrow(run, schema)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents into which no window of the benchmark leaked, with their own columns."""
    name = column_name("leaks", docs.columns)
    found = find_leaks(docs, benchmark, leak_col=name, with_matches=False, **options)
    return found.filter(F.col(name)["n_hit"] == 0).drop(name)
