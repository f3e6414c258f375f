"""SimHash near-deduplication by an inverted index of positional bytes.

A fingerprint has eight bytes. If two differ in at most ``max_bits`` bits, they agree in at
least ``8 - max_bits`` of their bytes, place by place: the guaranteed minimum of matches.
Tallying single bytes would compare a 256th of all pairs for each place, so the index is over
sets of places: a posting's key is one choice of that many places with their bytes. Two
fingerprints share C(m, minimum) postings if m bytes match, so sharing one posting is the
same as a tally that reaches the minimum, and no other pair is ever looked at. Every such
pair is verified by its bit distance.

Copies are collapsed first: the index holds distinct fingerprints. A task that holds some
postings of one choice of places keeps links as a spanning forest, which joins the same
fingerprints as all links do, so the links sent on are fewer than the postings. A posting with
many fingerprints is searched by breadth, each reached one leaving the rest, so a dense group
costs about its size; one with very many is first split in the same way by half bytes of the
other places. Components come from the forests by alternating large-star and
small-star steps, all joins and sums over stored tables.

Defined results: null and empty texts have the fingerprint zero and are linked like others;
fewer words than a shingle give one shingle of all words; repeated rows are documents with
equal fingerprints; null ids never name a component unless all its ids are null; a very long
text is a chunk of its own, and all its shingles count; an empty table gives an empty one; other
columns are carried along, and added ones evade their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.llm.text import CHUNK_BYTES, chunks, column_name, gather, words
from ladderlake.session import materialize

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SMALL_POSTING = 64
LARGE_POSTING = 8192
POSTINGS_EACH = 1 << 20


def fingerprints(column: pa.ChunkedArray, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text of a chunk."""
    found = words(column, lower=True)
    n_words = np.diff(found.first)
    out = np.zeros(len(n_words), np.uint64)
    if not len(found):
        return out
    sizes = found.ends - found.starts
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    joined = np.full(int(starts[-1] + sizes[-1]), 0x20, np.uint8)
    joined[gather(starts, sizes)] = found.data[found.inside]
    joined = joined.tobytes()

    n = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    first = gather(found.first[:-1], n)
    last = first + np.repeat(np.minimum(n_words, shingle), n) - 1
    low, high = starts[first].tolist(), (starts[last] + sizes[last]).tolist()
    digest = xxhash.xxh64_intdigest
    values = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(low, high)), np.uint64, len(low))
    raw = values.astype(">u8").view(np.uint8).reshape(-1, 8)
    at = np.concatenate([[0], np.cumsum(n)])
    for d in np.flatnonzero(n):
        ones = np.zeros(64, np.int64)
        for k in range(at[d], at[d + 1], 1 << 16):
            part = raw[k : min(k + (1 << 16), at[d + 1])]
            ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        out[d] = np.packbits(2 * ones > n[d]).view(">u8")[0]
    return out


def with_fingerprints(
    docs: DataFrame,
    shingle: int = SHINGLE,
    text_col: str = "text",
    carry: list[str] | None = None,
    print_col: str = "fingerprint",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The documents (columns ``carry``, or all) with their fingerprint as a signed long."""
    carry = docs.columns if carry is None else carry
    print_col = column_name(print_col, carry)
    kept = docs.select(*[F.col(f"`{c}`") for c in carry])
    names = [*carry, print_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, 0, chunk_bytes):
            found = pa.array(fingerprints(table.column(0), shingle).view(np.int64))
            columns = [c.combine_chunks() for c in table.remove_column(0).columns]
            yield pa.RecordBatch.from_arrays([*columns, found], names=names)

    schema = T.StructType([*kept.schema.fields, T.StructField(print_col, T.LongType())])
    text = F.col(f"`{text_col}`").alias(column_name("text", carry))
    return docs.select(text, *kept.columns).mapInArrow(run, schema)


def place_masks(max_bits: int) -> np.ndarray:
    """A mask for each choice of as many bytes as must match."""
    if not 0 <= max_bits < 8:
        raise ValueError("eight bytes have one in common for certain up to 7 bits")
    least = 8 - max_bits
    return np.array(
        [sum(0xFF << (8 * k) for k in chosen) for chosen in combinations(range(8), least)],
        np.uint64,
    )


def half_masks(mask: np.uint64, max_bits: int) -> list[np.uint64]:
    """``mask`` with each choice of as many half bytes of the other places as must match."""
    halves = [4 * k for k in range(16) if not int(mask) >> 4 * k & 0xF]
    least = len(halves) - max_bits
    return [
        mask | np.uint64(sum(0xF << k for k in chosen)) for chosen in combinations(halves, least)
    ]


class Forest:
    """Spanning forest of the links seen so far, over numbered fingerprints."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        for a, b in zip(left.tolist(), right.tolist()):
            x, y = self.find(a), self.find(b)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.edges.append((a, b))


def posting_links(prints: np.ndarray, mask: np.uint64, max_bits: int) -> list[tuple[int, int]]:
    """Links between fingerprints that agree on the masked bytes, as a spanning forest."""
    forest = Forest(len(prints))
    search_postings(prints, np.arange(len(prints)), mask, max_bits, forest, split=max_bits > 0)
    return [(int(prints[a]), int(prints[b])) for a, b in forest.edges]


def search_postings(
    prints: np.ndarray,
    number: np.ndarray,
    mask: np.uint64,
    max_bits: int,
    forest: Forest,
    split: bool,
) -> None:
    """Adds the links between ``prints``, known to the forest by ``number``."""
    key = prints & mask
    order = np.argsort(key)
    key, prints, number = key[order], prints[order], number[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(key)))

    left = np.repeat(np.where(sizes <= SMALL_POSTING, sizes, 0), sizes)
    left -= np.arange(len(key)) - np.repeat(starts, sizes) + 1  # fingerprints behind in the posting
    lag = 1
    while (at := np.flatnonzero(left >= lag)).size:
        near = np.bitwise_count(prints[at] ^ prints[at + lag]) <= max_bits
        forest.link(number[at[near]], number[at[near] + lag])
        lag += 1

    for k in np.flatnonzero(sizes > SMALL_POSTING):
        rest = np.arange(starts[k], starts[k] + sizes[k])
        if split and sizes[k] > LARGE_POSTING:
            for finer in half_masks(mask, max_bits):
                search_postings(prints[rest], number[rest], finer, max_bits, forest, False)
            continue
        reached: list[int] = []
        while rest.size:
            if not reached:
                reached, rest = [int(rest[0])], rest[1:]
            at = reached.pop()
            near = np.bitwise_count(prints[rest] ^ prints[at]) <= max_bits
            found, rest = rest[near], rest[~near]
            forest.link(np.full(len(found), number[at]), number[found])
            reached.extend(found.tolist())


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that join the distinct fingerprints of column ``fingerprint``."""
    masks = place_masks(max_bits)
    n_parts = max(1, -(-prints.count() // POSTINGS_EACH))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            rows = []
            for choice, mask in enumerate(masks):
                mixed = (own & mask) * np.uint64(0x9E3779B97F4A7C15)
                part = (mixed >> np.uint64(32)).astype(np.int64) * n_parts >> 32
                rows += [(choice, int(p), own[part == p].tobytes()) for p in np.unique(part)]
            fields = (pa.int32(), pa.int64(), pa.binary())
            columns = [pa.array(list(c), f) for c, f in zip(zip(*rows), fields)] if rows else None
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names=["choice", "part", "prints"])

    def search(key: tuple, table: pa.Table) -> pa.Table:
        own = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("prints").to_pylist()])
        found = posting_links(own, masks[key[0].as_py()], max_bits)
        ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": ends.min(axis=1), "b": ends.max(axis=1)})

    postings = prints.select("fingerprint").mapInArrow(
        post, "choice int, part bigint, prints binary"
    )
    found = postings.groupBy("choice", "part").applyInArrow(search, "a bigint, b bigint")
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node.

    Large-star and small-star steps alternate until the edges stay the same; then each node
    has one edge, to its root. A node's neighbours are only ever summed, never collected.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        ends = ends.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = ends.join(least, "u")
        if large:  # the larger neighbours move to the least
            moved = joined.filter("v > u").select("v", "m")
        else:  # the smaller neighbours and the node itself do
            moved = joined.filter("v < u").select("v", "m")
            moved = moved.unionByName(least.select(F.col("u").alias("v"), "m"))
        moved = moved.filter("v <> m")
        return moved.select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()

    def mark(edges: DataFrame) -> tuple:
        hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())

    edges = materialize(edges, "links")
    before = mark(edges)
    while before[0]:
        edges = materialize(star(star(edges, large=True), large=False), "links")
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def grouped(members: DataFrame, order_cols: list[str], max_bits: int = MAX_BITS) -> DataFrame:
    """(fingerprint, component): the least struct of ``order_cols`` in its component.

    ``members`` is a stored table with a row per document.
    """
    # Nulls last: a struct starts with whether its id is null.
    order = F.struct(F.col(order_cols[0]).isNull().alias("no_id"), *order_cols)
    prints = members.groupBy("fingerprint").agg(F.min(order).alias("least"))
    prints = materialize(prints, "prints")
    roots = materialize(components(links(prints, max_bits)), "roots")
    rooted = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    best = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rooted.select("fingerprint", "root").join(best, "root").drop("root")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per document: doc_id, fingerprint (hex), component_id (its smallest doc_id)."""
    members = with_fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), shingle, carry=["doc_id"])
    members = materialize(members, "fingerprints")
    found = grouped(members, ["doc_id"], max_bits)
    return members.join(found, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component.doc_id").alias("component_id"),
    )


def keep_one(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One document of each component, the one with the smallest id, with its own columns.

    Of documents that share this id, the one with the smallest hash of its text stays, and
    of repeated rows one. ``docs`` is scanned twice.
    """
    taken = docs.columns
    text_hash = column_name("text_hash", taken)
    hashed = docs.withColumn(text_hash, F.xxhash64(F.col(f"`{text_col}`")))
    slim = hashed.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(text_hash).alias("text_hash"),
        F.col(f"`{text_col}`").alias("text"),
    )
    members = with_fingerprints(slim, shingle, carry=["doc_id", "text_hash"], chunk_bytes=chunk_bytes)
    members = materialize(members, "fingerprints")
    best = grouped(members, ["doc_id", "text_hash"], max_bits).select("component.*").distinct()
    same = F.expr("m.doc_id <=> b.doc_id and m.text_hash = b.text_hash")
    best = (
        members.alias("m")
        .join(best.alias("b"), same, "left_semi")
        .groupBy("doc_id", "text_hash")
        .agg(F.count("*").alias("n"))
    )
    best = materialize(best, "kept").alias("b")

    def chosen(which: str) -> DataFrame:
        left = hashed.alias("d")
        on = F.col(f"d.`{id_col}`").eqNullSafe(F.col("b.doc_id")) & (
            F.col(f"d.{text_hash}") == F.col("b.text_hash")
        )
        return left.join(best.filter(which), on, "left_semi")

    repeated = chosen("n > 1").dropDuplicates([id_col, text_hash])
    return chosen("n = 1").unionByName(repeated).drop(text_hash)
