"""Ranked lexical search: accumulators of the short lists, then document at a time over the long ones.

The documents are indexed in blocks of some megabytes of text: a row per (block, term) with the
numbers of the documents that hold it, as gaps, and how often. A search joins the lists of the
items' terms to the items that ask for them, and each group, one block and up to ``ITEMS_EACH``
items, finds its best documents by itself:

1. Term at a time: the lists of an item that are short in this block are summed into one
   sorted list of (document, score), with the greatest score as its bound.
2. Document at a time: that list is from then on one iterator beside the long lists. Documents
   go by in ranges of ``RANGE`` numbers. Each iterator has a greatest score in each range. A
   range whose bounds together do not pass the item's threshold, the score of its k-th best
   document so far, is skipped; else the iterators with the least bounds, as many as cannot
   pass it by themselves, are only looked up for the documents the others bring, and no longer
   once a document cannot pass any more.

A document that is passed over has a greater number, hence a greater id, than k documents of at
least its score; so the result is exact. The k best of each block meet in one ranking, cut to k
in each task before its shuffle.

Each pair of block and item group is a task's group, and the lists reach it by a join on the
term; a list of a frequent term is split by blocks, so no group grows with the documents.

Defined results: null and empty texts have no terms, count nowhere and are never found; an item
without terms, or whose terms no document holds, has no rows; equal scores follow the document
id, null ids last; repeated rows are documents (or items) of their own; a very long text makes a
block by itself; an empty table of documents or items gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladderlake.llm import blocks
from ladderlake.llm.text import ALNUM, chunks, tidy, words
from ladderlake.session import materialize

BLOCK_BYTES = 8 << 20
ITEMS_EACH = 512
RANGE = 512
# A list is short up to this share of a block's documents.
SHORT_SHARE = 1 / 32

INDEX = "block bigint, term string, size bigint, docs binary, counts binary, total bigint"
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers, seven bits a byte, and where each starts (one more entry)."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for k in range(1, 10):
        if not (more := values >= np.uint64(1) << np.uint64(7 * k)).any():
            break
        size += more
    starts = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(starts[-1]), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        part = (values[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[starts[:-1][has] + k] = part.astype(np.uint8) | ((size[has] > k + 1) * np.uint8(128))
    return out, starts


def numbers(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(data < 128)[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    parts = (data & 127).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.add.reduceat(parts, starts).astype(np.int64)


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A column of binaries, each the numbers from one of ``starts`` to the next."""
    data, places = varints(values)
    offsets = places[np.append(starts, len(values))].astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )


def block_index(table: pa.Table, block: int) -> Iterator[pa.RecordBatch]:
    """Index rows of one block; the first, without a term, has its documents' ids and lengths."""
    table = table.take(pa.array(np.argsort(blocks.ids_of(table, "id"), kind="stable")))
    found = words(table.column("text"), ALNUM, lower=True)
    lengths = np.diff(found.first)
    held = np.flatnonzero(lengths)
    if not len(held):
        return
    names = [f.split()[0] for f in INDEX.split(", ")]
    ids, sizes = blocks.ids_of(table, "id")[held], lengths[held]
    data, _ = varints(sizes)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([block]),
            pa.array([None], pa.string()),
            pa.array([len(held)]),
            pa.array([ids.tobytes()], pa.binary()),
            pa.array([data.tobytes()], pa.binary()),
            pa.array([int(sizes.sum())]),
        ],
        names=names,
    )
    codes, terms = found.codes()
    number = np.repeat(np.arange(len(held)), sizes)
    pairs = np.sort((codes.astype(np.uint64) << np.uint64(32)) | number.astype(np.uint64))
    new = np.flatnonzero(np.diff(pairs, prepend=pairs[:1] ^ np.uint64(1)))
    counts = np.diff(np.append(new, len(pairs)))
    pairs = pairs[new]
    code, doc = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    gaps = np.diff(doc, prepend=0)
    gaps[starts] = doc[starts]
    n = len(starts)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, block)),
            terms.take(pa.array(code[starts])).cast(pa.large_string()).cast(pa.string()),
            pa.array(np.diff(np.append(starts, len(code)))),
            _lists(gaps, starts),
            _lists(counts, starts),
            pa.nulls(n, pa.int64()),
        ],
        names=names,
    )


def index_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The inverted index of all documents, to be stored before it is searched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for k, table in enumerate(chunks(batches, 1, block_bytes)):
            yield from block_index(table, task + k)

    own = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return own.mapInArrow(run, INDEX)


class Lists:
    """The lists of one group, with scores in place of counts."""

    def __init__(self, table: pa.Table, n_docs: int, norm: np.ndarray):
        sizes = table.column("size").to_numpy()
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        gaps = numbers(b"".join(table.column("docs").to_pylist()))
        sums = np.concatenate([[0], np.cumsum(gaps)])
        self.docs = sums[1:] - np.repeat(sums[self.first[:-1]], sizes)
        tf = numbers(b"".join(table.column("counts").to_pylist()))
        weight = np.repeat(table.column("weight").to_numpy(), sizes)
        self.scores = weight * (1_000_000_000 * tf // (1000 * tf + 8 * norm[self.docs]))
        self.edges = np.arange(0, n_docs + RANGE, RANGE)
        self.long = sizes > max(16, n_docs * SHORT_SHARE)
        self.ranged = {}

    def own(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        here = slice(self.first[k], self.first[k + 1])
        return self.docs[here], self.scores[here]

    def iterator(self, docs: np.ndarray, scores: np.ndarray) -> tuple:
        """Documents, scores, the places of the ranges, and the greatest score of each."""
        cuts = np.searchsorted(docs, self.edges)
        bounds = np.zeros(len(cuts) - 1, np.int64)
        some = cuts[1:] > cuts[:-1]
        if some.any():
            bounds[some] = np.maximum.reduceat(scores, cuts[:-1][some])
        return docs, scores, cuts, bounds

    def long_list(self, k: int) -> tuple:
        if k not in self.ranged:
            self.ranged[k] = self.iterator(*self.own(k))
        return self.ranged[k]

    def accumulated(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term at a time: the sums of some lists, by document."""
        lists = [self.own(k) for k in some]
        docs = np.concatenate([d for d, _ in lists])
        scores = np.concatenate([s for _, s in lists])
        order = np.argsort(docs, kind="stable")
        docs = docs[order]
        starts = np.flatnonzero(np.diff(docs, prepend=-1))
        return docs[starts], np.add.reduceat(scores[order], starts)

    def best(self, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents for the lists ``asked``, with their scores."""
        iterators = [self.long_list(t) for t in asked[self.long[asked]]]
        if len(short := asked[~self.long[asked]]):
            iterators.append(self.iterator(*self.accumulated(short)))
        iterators.sort(key=lambda x: int(x[3].max()))
        bounds = np.cumsum([x[3] for x in iterators], axis=0)
        top_docs, top_scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        sums = np.zeros(RANGE, np.int64)
        for r in range(len(self.edges) - 1):
            passed = bounds[:, r]
            if passed[-1] <= least:
                continue
            needed = int(np.searchsorted(passed, least, "right"))
            base = self.edges[r]
            sums[:] = 0
            for docs, scores, cuts, _ in iterators[needed:]:
                here = slice(cuts[r], cuts[r + 1])
                sums[docs[here] - base] += scores[here]
            found = np.flatnonzero(sums)
            score = sums[found]
            for j in range(needed - 1, -1, -1):
                keep = score + passed[j] > least
                found, score = found[keep], score[keep]
                if not len(found):
                    break
                docs, scores, cuts, _ = iterators[j]
                here = docs[cuts[r] : cuts[r + 1]] - base
                if len(here):
                    at = np.minimum(np.searchsorted(here, found), len(here) - 1)
                    hit = here[at] == found
                    score[hit] += scores[cuts[r] : cuts[r + 1]][at[hit]]
            keep = score > least
            if not keep.any():
                continue
            top_docs = np.concatenate([top_docs, found[keep] + base])
            top_scores = np.concatenate([top_scores, score[keep]])
            order = np.lexsort((top_docs, -top_scores))[:k]
            top_docs, top_scores = top_docs[order], top_scores[order]
            if len(order) == k:
                least = int(top_scores[-1])
        return top_docs, top_scores


def item_terms(items: DataFrame, text_col: str, item_no: str) -> DataFrame:
    """(item, term) for the distinct terms of each item."""
    lower = F.translate(F.col(text_col), UPPER, UPPER.lower())
    terms = F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0)))
    return items.select(item_no, F.explode(terms).alias("term"))


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    query_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest documents with a score above 0 of each item."""
    index = materialize(index_documents(docs, id_col, text_col, block_bytes), "index")
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{query_col}`").alias("query"))
    asked = materialize(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    n_groups = max(1, -(-asked.count() // ITEMS_EACH))
    pairs = item_terms(asked, "query", "item")
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(n_groups)))

    own = index.filter("term is null")
    n_docs, total = own.agg(F.sum("size"), F.sum("total")).first()
    terms = materialize(pairs.groupBy("part", "term").agg(F.collect_list("item").alias("items")), "terms")
    held = index.filter("term is not null").drop("total")
    held = materialize(held.join(terms.select("term").distinct(), "term", "left_semi"), "lists")
    weight = F.floor(1000 * F.log((2.0 * (n_docs or 0) + 2) / (2.0 * F.col("df") + 1)))
    weights = held.groupBy("term").agg(F.sum("size").alias("df")).withColumn("weight", weight)
    weights = materialize(terms.join(weights.drop("df"), "term"), "weights")
    lists = held.join(weights, "term").drop("term")
    parts = F.sequence(*(F.lit(x).cast("bigint") for x in (0, n_groups - 1)))
    headers = own.select("block", "docs", "counts", F.explode(parts).alias("part"))

    def run(key: tuple, table: pa.Table, header: pa.Table) -> pa.Table:
        tidy()
        out = [[], [], []]
        if table.num_rows:
            ids = np.frombuffer(header.column("docs")[0].as_py(), np.int64)
            lengths = numbers(header.column("counts")[0].as_py())
            lists = Lists(table, len(ids), 10 + 90 * lengths * n_docs // total)
            asking = table.column("items").combine_chunks()
            item, of = asking.flatten().to_numpy(), np.repeat(np.arange(len(asking)), asking.value_lengths())
            order = np.argsort(item, kind="stable")
            item, of = item[order], of[order]
            starts = np.flatnonzero(np.diff(item, prepend=-1))
            for at, some in zip(starts, np.split(of, starts[1:])):
                found, scores = lists.best(some, k)
                out[0].append(np.full(len(found), item[at]))
                out[1].append(ids[found])
                out[2].append(scores)
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        nulls = columns[1] == blocks.LAST
        return pa.table(
            {"item": columns[0], "doc_id": pa.array(columns[1], mask=nulls), "score": columns[2]}
        )

    found = (
        lists.groupBy("block", "part")
        .cogroup(headers.groupBy("block", "part"))
        .applyInArrow(run, "item bigint, doc_id bigint, score bigint")
    )
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
