"""MinHash near-deduplication by fast similarity sketching.

A sketch has t coordinates, the bins. In each of the first t rounds every element of a set falls
into one hashed bin with one hashed value; a bin keeps the least value of the first round that
reached it. Round t + i puts every element into bin i, so after 2t rounds every bin is filled,
whatever the size of the set; a set of more than t ln t elements is done after a round or two.
Two sets agree in a coordinate with a chance of their similarity J, and the number of coordinates
that agree is as concentrated around tJ as if each had a hash function of its own. That makes
banding safe: with ``BANDS`` bands of ``ROWS`` coordinates a link at J = 0.85 shares no band with
a chance of (1 - 0.85^4)^24 = 2e-8, a link above it with less.

Documents that share a band are verified on their full sets:

1. Copies collapse: a set has one number, whatever documents have it.
2. The least number of a band's key is its hub. Each set is compared with the hub it shares most
   bands with, by one join: a large group of near copies costs one comparison for each.
3. A key whose sets are all in one component by then is done. The sets of the others meet, in
   squares of blocks of bounded size where they are many, and a search by breadth compares each
   reached set with those not yet reached; links leave as a spanning forest.

So every pair that shares a band is verified or already connected, no pairs of a group are ever
rows, and no group is held whole by a task. Sets are 64-bit hashes of shingles, and equal sets
are known by 128 bits. Texts are read twice, for the sketches and for the candidates' sets.

Defined results: null, empty and blank texts have no shingles, size 0, and are linked with
nothing; fewer words than a shingle are one shingle; repeated rows are documents with equal
sets; null ids never name a component unless all its ids are null, and of these rows none is
``kept`` unless the component has no other id; a very long text is a chunk of its own; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderlake.llm.simhash import components
from ladderlake.llm.text import as_table, chunks, hashes, mix, tidy, window_hashes, words
from ladderlake.session import materialize

SHINGLE = 5
SIMILARITY = 85  # per cent
ROWS = 4
BANDS = 24
COORDINATES = ROWS * BANDS

# Bounds of a block of sets that meet in one task, and of what a task gets of them at once.
BLOCK_SETS = 4096
BLOCK_ELEMENTS = 1 << 20

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = 0x9E3779B97F4A7C15


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seed(k: int) -> np.uint64:
    return np.uint64((k + 1) * _STEP & 0xFFFFFFFFFFFFFFFF)


def shingle_sets(column: pa.ChunkedArray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, increasing in each; text d has ``first[d:d + 2]``."""
    found = words(column, lower=True)
    n_words = np.diff(found.first)
    codes, dictionary = found.codes()
    lane = np.ascontiguousarray(hashes(dictionary)[codes, 0]) if len(found) else np.zeros(0, np.uint64)
    of = found.of()
    values = window_hashes(lane, shingle)
    starts = np.flatnonzero(of[: len(values)] == of[shingle - 1 :]) if len(values) else np.zeros(0, int)
    docs, values = [of[starts]], [values[starts]]
    for n in range(1, shingle):
        short = np.flatnonzero(n_words == n)
        if len(short):
            docs.append(short)
            values.append(_scramble(window_hashes(lane, n)[found.first[short]] ^ _seed(n)))
    doc, value = np.concatenate(docs), np.concatenate(values)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return value, np.searchsorted(doc, np.arange(len(n_words) + 1))


def sketches(elements: np.ndarray, first: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """The t coordinates of each set; those of an empty set are all the same."""
    sizes = np.diff(first)
    n = len(sizes)
    out = np.full(n * t, _EMPTY)
    of = np.repeat(np.arange(n), sizes)
    for r in range(2 * t):
        hashed = _scramble(elements ^ _seed(r))
        if r < t:
            place = of * t + ((hashed >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        else:
            place = of * t + (r - t)
        value = (hashed << np.uint64(32)) | (hashed >> np.uint64(32))
        free = out[place] == _EMPTY
        np.minimum.at(out, place[free], value[free])
        open_ = (out.reshape(n, t) == _EMPTY).any(axis=1)[of]
        if not open_.any():
            break
        elements, of = elements[open_], of[open_]
    return out.reshape(n, t)


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key for each band of each sketch; the band is part of the key."""
    parts = sketch.reshape(len(sketch), -1, rows)
    seeds = np.array([_seed(1000 + b) for b in range(parts.shape[1])], np.uint64)
    key = np.broadcast_to(seeds, parts.shape[:2])
    for k in range(rows):
        key = mix(np.ascontiguousarray(key), np.ascontiguousarray(parts[:, :, k]))
    return _scramble(key)


def digests(elements: np.ndarray, first: np.ndarray) -> pa.Array:
    """128 bits of each set, null for an empty one."""
    raw = [
        xxhash.xxh3_128_digest(elements[a:b].tobytes()) if b > a else None
        for a, b in zip(first[:-1].tolist(), first[1:].tolist())
    ]
    return pa.array(raw, pa.binary())


def _longs(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(first.astype(np.int32), pa.array(values.view(np.int64)))


def with_sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash, the set's digest and size, and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, 2):
            elements, first = shingle_sets(table.column(2), shingle)
            keys = band_keys(sketches(elements, first))
            bounds = np.arange(len(keys) + 1) * keys.shape[1]
            columns = [c.combine_chunks() for c in table.columns[:2]]
            columns += [digests(elements, first), pa.array(np.diff(first)), _longs(keys.ravel(), bounds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "set", "n", "bands"])

    schema = "doc_id bigint, text_hash bigint, set binary, n bigint, bands array<bigint>"
    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, schema)


def full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """The set of each text: its digest and its elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, 0):
            elements, first = shingle_sets(table.column(0), shingle)
            columns = [digests(elements, first), _longs(elements, first)]
            yield pa.RecordBatch.from_arrays(columns, names=["set", "elements"])

    return docs.select("text").mapInArrow(run, "set binary, elements array<bigint>")


def open_links(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links between sets of one group that are in different components, as a spanning forest.

    Where a group is a square of two blocks, only sets of different blocks are compared.
    """
    number, part, block = (table.column(c).to_numpy() for c in ("number", "part", "block"))
    square = (table.column("i").to_numpy() != table.column("j").to_numpy()).any()
    lists = table.column("elements").combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    _, codes = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    first = np.concatenate([[0], np.cumsum(sizes)])
    held = np.zeros(int(codes.max(initial=-1)) + 1, bool)
    found: list[tuple[int, int]] = []
    rest, reached = np.arange(len(number)), []
    while len(rest):
        if not reached:
            reached, rest = [int(rest[0])], rest[1:]
        at = reached.pop()
        same = part[rest] == part[at]
        low, high = np.minimum(sizes[rest], sizes[at]), np.maximum(sizes[rest], sizes[at])
        some = ~same & (100 * low >= percent * high)
        if square:
            some &= block[rest] != block[at]
        near = np.zeros(len(rest), bool)
        if some.any():
            own = codes[first[at] : first[at + 1]]
            held[own] = True
            here = rest[some]
            width = sizes[here]
            begins = np.cumsum(width) - width
            places = np.arange(int(width.sum())) + np.repeat(first[here] - begins, width)
            shared = np.add.reduceat(held[codes[places]].astype(np.int64), begins)
            held[own] = False
            near[some] = 100 * shared >= percent * (width + sizes[at] - shared)
            found += [(int(number[at]), int(x)) for x in number[rest[near]]]
        reached.extend(rest[near | same].tolist())
        rest = rest[~(near | same)]
    return found


def verified_links(prints: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between the numbers of sets; they join what all links between them do."""
    postings = prints.select("number", "n", F.explode("bands").alias("key"))
    keys = postings.groupBy("key").agg(F.count("*").alias("sets"), F.min("number").alias("hub"))
    shared = postings.join(keys.filter("sets > 1").drop("sets"), "key")
    shared = materialize(shared, "shared")

    wanted = prints.join(shared.select("number").distinct(), "number", "left_semi")
    wanted = materialize(wanted.select("number", "set", "least.*"), "wanted").alias("w")
    named = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
    texts = docs.alias("d").join(wanted, named, "left_semi")
    sets = full_sets(texts, shingle).join(wanted.select("number", "set"), "set").drop("set")
    sets = materialize(sets.dropDuplicates(["number"]), "sets")

    # Of the hubs a set shares keys with, the one with most of them.
    hubs = shared.filter("number <> hub").groupBy("number", "hub").agg(F.count("*").alias("keys"))
    best = hubs.groupBy("number").agg(F.max(F.struct("keys", F.negative("hub").alias("hub"))).alias("best"))
    best = best.select("number", F.negative("best.hub").alias("hub"))
    own = F.col("own")
    compared = best.join(sets.withColumnRenamed("elements", "own"), "number").join(
        sets.select(F.col("number").alias("hub"), F.col("elements").alias("other")), "hub"
    )
    compared = compared.select(
        F.col("hub").alias("a"),
        F.col("number").alias("b"),
        (F.size(own) + F.size("other")).cast("bigint").alias("both"),
        F.size(F.array_intersect(own, "other")).cast("bigint").alias("common"),
    )
    linked = compared.filter(f"100 * common >= {percent} * (both - common)").select("a", "b")
    linked = materialize(linked, "hub_links")

    parts = components(linked).withColumnsRenamed({"node": "number", "root": "part"})
    inside = shared.drop("hub").join(materialize(parts, "parts"), "number", "left")
    inside = inside.withColumn("part", F.coalesce("part", "number"))
    mark = F.sum(F.xxhash64("number").cast("decimal(38,0)")).alias("mark")
    left = inside.groupBy("key").agg(
        F.count("*").alias("sets"), F.sum("n").alias("total"), mark, F.min("part").alias("p"), F.max("part").alias("q")
    )
    # Keys with the same sets are one group.
    left = left.filter("p <> q").groupBy("sets", "total", "mark").agg(F.min("key").alias("key"))
    blocks = F.ceil(F.greatest(F.col("sets") / BLOCK_SETS, F.col("total") / BLOCK_ELEMENTS))
    left = left.select("key", blocks.alias("blocks"))
    dealt = inside.join(left, "key").withColumn("block", F.pmod(F.xxhash64("number"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    dealt = dealt.select("key", "number", "part", "n", "block", other.alias("other"))
    dealt = dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")
    dealt = materialize(dealt, "groups")
    n_tasks = max(1, -(-(dealt.agg(F.sum("n")).first()[0] or 0) // BLOCK_ELEMENTS))
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(n_tasks)))

    def search(key: tuple, data: pa.Table) -> pa.Table:
        tidy()
        table = as_table(data).sort_by([("key", "ascending"), ("i", "ascending"), ("j", "ascending")])
        marks = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
        starts = np.flatnonzero(np.append(True, (marks[:, 1:] != marks[:, :-1]).any(axis=0)))
        found = []
        for a, b in zip(starts, np.append(starts[1:], table.num_rows)):
            found += open_links(table.slice(a, b - a), percent)
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": ends[:, 0], "b": ends[:, 1]})

    more = dealt.join(sets, "number").groupBy("task").applyInArrow(search, "a bigint, b bigint")
    return materialize(linked.unionByName(more).distinct(), "links")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id (its smallest doc_id), kept."""
    text = F.col(f"`{text_col}`")
    own = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    members = materialize(with_sketches(own, shingle), "sketches")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    prints = members.filter("set is not null").groupBy("set").agg(
        least.alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    prints = materialize(prints.withColumn("number", F.monotonically_increasing_id()), "prints")
    links = verified_links(prints, own, shingle, percent)

    # A node starts with its least id, so a component's root names it.
    node = F.struct("least.no_id", "least.doc_id", "number")
    nodes = prints.select("number", node.alias("node"))
    for end in ("a", "b"):
        links = links.join(nodes.withColumnsRenamed({"number": end, "node": f"{end}_"}), end).drop(end)
    links = links.select(F.least("a_", "b_").alias("a"), F.greatest("a_", "b_").alias("b"))
    roots = materialize(components(links), "roots")
    named = prints.select("set", node.alias("node")).join(roots, "node", "left")
    named = named.select("set", F.coalesce("root", "node").doc_id.alias("component_id"), F.lit(True).alias("some"))
    found = members.select("doc_id", "n", "set").join(named, "set", "left")
    component = F.when(F.col("some"), F.col("component_id")).otherwise(F.col("doc_id"))
    found = found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
