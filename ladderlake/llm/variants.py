"""Spelling variants: words one edit apart, by an index of variable-length grams.

A word stands between two marks. The gram dictionary is pruned by frequency: a gram of ``Q_MIN``
letters is extended, up to ``Q_MAX``, as long as it is frequent among the words; so where a gram
ends depends on nothing behind it. A word is decomposed into the grams at its places, without
those that lie inside an earlier one.

For every word there is a bound on how many of its grams one deletion or replacement can affect:
those that hold the changed letter, and those behind it that a longer new gram could swallow,
which takes a frequent gram with the same letters at its end. With a bound of b, a near word's
decomposition has all but b of the grams, so it has one of any b + 1 of them. The lists of the
b + 1 rarest grams are merged, the others are never read. As a word has at least 2 * Q_MAX - 2
letters, its first and last gram have no letter in common, and a bound never covers all grams.

A gram keeps its place: a replacement leaves it where it is, a deletion leaves it or moves it by
one. So lists are kept by gram, place and length of the word, and every word looks for words of
its own length and of one letter less; words of one letter more look for it. What the lists
yield is verified. Lists are dealt to tasks by a hash; a list of very many words is cut into
blocks, and squares of blocks go to different tasks. Only verified pairs leave a task.

The dictionary has at most ``DICTIONARY`` grams of each length, and is all that is broadcast.

Defined results: null, empty and letterless texts have no words; a null id counts as an empty
one where words are altered; repeated rows count each; a word of any length is compared whole;
equal counts are ordered by code points; an empty table, or one without a frequent word, gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderlake.llm.text import LOWER, Words, as_table, chunks, runs, tidy, utf8
from ladderlake.session import materialize

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
Q_MIN, Q_MAX = 2, 4
DICTIONARY = 1 << 14
OPEN, CLOSE = "^", "$"

LIST_ROWS = 1 << 16
TASK_ROWS = 1 << 18
PAIRS_EACH = 1 << 17
WIDE = 48

_SMALL = np.zeros(256, bool)
_SMALL[0x61:0x7B] = True


def letter_runs(column: pa.ChunkedArray, least: int = 1) -> Words:
    """Runs of a-z, A-Z and U+00C0 to U+00FF with ``least`` code points, A-Z in lower case."""
    data, offsets = utf8(column)
    data = LOWER[data]
    lead = data == 0xC3  # the first byte of exactly these code points
    inside = _SMALL[data] | lead
    inside[1:] |= lead[:-1]
    starts, ends = runs(inside, offsets)
    leads = np.concatenate([[0], np.cumsum(lead)])
    keep = ends - starts - (leads[ends] - leads[starts]) >= least
    starts, ends = starts[keep], ends[keep]
    change = np.bincount(starts, minlength=len(data) + 1) - np.bincount(ends, minlength=len(data) + 1)
    return Words(data, offsets, np.cumsum(change[:-1]) > 0, starts, ends, np.searchsorted(starts, offsets))


def joined_crc(before: np.ndarray, after: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings in a row, from the CRC of each and the size of the second."""
    out = np.zeros(len(before), np.uint32)
    for n in np.flatnonzero(np.bincount(size)) if size.max(initial=0) < 1 << 20 else sorted(set(size.tolist())):
        here = size == n
        zeros = bytes(int(n))
        at_zero = zlib.crc32(zeros, 0)
        bits = [zlib.crc32(zeros, 1 << k) ^ at_zero for k in range(32)]
        moved = np.zeros(int(here.sum()), np.uint32)
        value = before[here]
        for k, x in enumerate(bits):
            moved ^= ((value >> np.uint32(k)) & np.uint32(1)) * np.uint32(x)
        out[here] = moved ^ after[here]
    return out


def chunk_words(ids: list, column: pa.ChunkedArray, noise: int | None, least: int) -> tuple[list, list]:
    """Words of ``least`` code points at least, and how often each occurs in a chunk of texts."""
    found = letter_runs(column, least)
    codes, dictionary = found.codes()
    distinct = [w.decode() for w in dictionary.to_pylist()]
    counts = np.bincount(codes, minlength=len(distinct))
    altered: Counter[str] = Counter()
    if noise and len(codes):
        before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        after = np.array([zlib.crc32(w) for w in dictionary.to_pylist()], np.uint32)
        size = np.array([len(w) for w in dictionary.to_pylist()])
        pairs = np.sort(found.of() * len(distinct) + codes)
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        n = np.diff(np.append(first, len(pairs)))
        doc, code = np.divmod(pairs[first], len(distinct))
        crc = joined_crc(before[doc], after[code], size[code])
        for k in np.flatnonzero(crc % np.uint32(noise) == 0):
            word = distinct[code[k]]
            counts[code[k]] -= n[k]
            place = int(crc[k]) % len(word)
            altered[word[:place] + word[place + 1 :]] += int(n[k])
    left = np.flatnonzero(counts)
    more = [(w, n) for w, n in altered.items() if len(w) >= least]
    return [distinct[k] for k in left] + [w for w, _ in more], counts[left].tolist() + [n for _, n in more]


def count_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    noise: int | None = None,
) -> DataFrame:
    """(word, n): lower-cased letter runs of all texts, by how often they occur.

    ``noise`` plants variants: a run whose CRC-32, behind its document's id and a colon, is
    divided by it loses the code point at the CRC modulo its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, 1):
            words, counts = chunk_words(table.column(0).to_pylist(), table.column(1), noise, min_length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"]
            )

    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return own.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """The frequent grams with their frequencies: no more than ``DICTIONARY`` of each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for word in batch.column(0).to_pylist():
                marked = OPEN + word + CLOSE
                for q in range(Q_MIN, Q_MAX + 1):
                    counts.update([marked[p : p + q] for p in range(len(marked) - q + 1)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["gram", "n"],
            )

    counted = words.select("word").mapInArrow(run, "gram string, n bigint")
    counted = materialize(counted.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    # More than this often, so there are fewer than DICTIONARY of a length.
    total = counted.filter(F.length("gram") == Q_MIN).agg(F.sum("n")).first()[0] or 0
    frequent = counted.filter(F.col("n") > max(16, total // DICTIONARY))
    return {row.gram: row.n for row in frequent.collect()}


def ends_of(frequent: dict[str, int]) -> set[str]:
    """What frequent grams that are extended end with, behind their first letter."""
    return {g[k:] for g in frequent if len(g) < Q_MAX for k in range(1, len(g))}


def decompose(marked: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """Start and end of each gram of a word between its marks."""
    out, reach = [], 0
    for p in range(len(marked) - Q_MIN + 1):
        end = p + Q_MIN
        while end - p < Q_MAX and end < len(marked) and marked[p:end] in frequent:
            end += 1
        if end > reach:
            out.append((p, end))
            reach = end
    return out


def affected(marked: str, grams: list[tuple[int, int]], ends: set[str]) -> int:
    """The most grams that one deletion or replacement of a letter can affect."""
    most = 0
    for i in range(1, len(marked) - 1):
        n = 0
        for p, end in grams:
            if p <= i:
                n += i < end
            elif end - i > Q_MAX:  # no new gram reaches over this one, nor over any later
                break
            else:
                n += marked[i + 1 : end - 1] in ends
        most = max(most, n)
    return most


HELD, SAME, SHORTER = 0, 1, 2


def list_key(gram: str, place: int, length: int) -> int:
    return xxhash.xxh64_intdigest(f"{place} {length} {gram}".encode()) - (1 << 63)


def list_rows(word: str, frequent: dict[str, int], ends: set[str]) -> Iterator[tuple[int, int]]:
    """(list, kind): the lists that hold the word, and those in which it looks for others."""
    marked = OPEN + word + CLOSE
    grams = decompose(marked, frequent)
    bound = affected(marked, grams, ends)
    for p, end in grams:
        yield list_key(marked[p:end], p, len(word)), HELD
    rarest = sorted(grams, key=lambda g: frequent.get(marked[g[0] : g[1]], 0))
    for p, end in rarest[: bound + 1]:
        yield list_key(marked[p:end], p, len(word)), SAME
        for place in (p, p - 1):
            yield list_key(marked[p:end], place, len(word) - 1), SHORTER


def one_less(longer: str, shorter: str) -> bool:
    k = next((k for k, (a, b) in enumerate(zip(longer, shorter)) if a != b), len(shorter))
    return longer[k + 1 :] == shorter[k:]


def merged(table: pa.Table) -> set[tuple[str, str]]:
    """Verified pairs of the lists of one task: (longer or greater word, the other)."""
    words = table.column("word").combine_chunks().dictionary_encode()
    order = np.argsort(np.array(words.dictionary.to_pylist(), object), kind="stable")
    names = [words.dictionary[int(k)].as_py() for k in order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    word = rank[words.indices.to_numpy()]
    kind = table.column("kind").to_numpy()
    marks = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
    by = np.lexsort((kind, *marks[::-1]))
    word, kind, marks = word[by], kind[by], marks[:, by]
    new = np.append(True, (marks[:, 1:] != marks[:, :-1]).any(axis=0))
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    held = np.bincount(group, weights=kind == HELD).astype(np.int64)

    size = np.array([len(w) for w in names])
    wide = min(WIDE, int(size.max(initial=0))) + 1
    letters = np.frombuffer(
        b"".join(w[:wide].encode("latin-1").ljust(wide, b"\0") for w in names), np.uint8
    ).reshape(len(names), wide)
    columns = np.arange(wide - 1)
    asking = np.flatnonzero(kind != HELD)
    asking = asking[held[group[asking]] > 0]
    n = held[group[asking]]
    found: list[np.ndarray] = []
    cuts = np.searchsorted(np.cumsum(n), np.arange(PAIRS_EACH, int(n.sum()) + PAIRS_EACH, PAIRS_EACH))
    for at in np.split(asking, np.unique(cuts[cuts < len(asking)])):
        width = held[group[at]]
        begins = np.cumsum(width) - width
        other = word[np.arange(int(width.sum())) + np.repeat(starts[group[at]] - begins, width)]
        own, same = np.repeat(word[at], width), np.repeat(kind[at] == SAME, width)
        pairs = np.stack([own, other])
        equal = pairs[:, same & (size[own] == size[other]) & (own > other)]
        less = pairs[:, ~same & (size[own] == size[other] + 1)]
        for kept, is_equal in ((equal, True), (less, False)):
            narrow = size[kept[0]] < wide
            a, b = letters[kept[0][narrow]], letters[kept[1][narrow]]
            if is_equal:
                good = (a != b).sum(axis=1) == 1
            else:
                first = np.argmax(a != b, axis=1)
                good = ~((a[:, 1:] != b[:, :-1]) & (columns >= first[:, None])).any(axis=1)
            found.append(kept[:, narrow][:, good])
            for x, y in kept[:, ~narrow].T.tolist():
                s, t = names[x], names[y]
                if sum(map(str.__ne__, s, t)) == 1 if is_equal else one_less(s, t):
                    found.append(np.array([[x], [y]]))
    if not found:
        return set()
    distinct = np.unique(np.concatenate(found, axis=1), axis=1)
    return {(names[a], names[b]) for a, b in distinct.T.tolist()}


def near_words(words: DataFrame) -> DataFrame:
    """(a, b): all pairs of distinct words one inserted, deleted or replaced code point apart.

    ``words`` is a stored table of distinct words of at least ``MIN_LENGTH`` code points.
    """
    frequent = gram_dictionary(words)
    ends = ends_of(frequent)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0)
            rows = [list(list_rows(w, frequent, ends)) for w in own.to_pylist()]
            of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            flat = np.array([x for r in rows for x in r], np.int64).reshape(-1, 2)
            columns = [pa.array(flat[:, 0]), pa.array(flat[:, 1].astype(np.int8)), own.take(pa.array(of))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "kind", "word"])

    rows = words.select("word").mapInArrow(index, "key bigint, kind tinyint, word string")
    rows = materialize(rows, "lists")
    sizes = rows.groupBy("key").agg(F.count("*").alias("rows"))
    many = F.ceil(F.col("rows") / LIST_ROWS).alias("blocks")
    large = materialize(sizes.filter(F.col("rows") > LIST_ROWS).select("key", many), "large_lists")
    dealt = rows.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("bigint")))
    own = F.pmod(F.xxhash64("word"), F.col("blocks"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    dealt = dealt.select("key", "kind", "word", own.alias("own"), every.alias("other"))
    dealt = dealt.select(
        "key", "kind", "word",
        F.when(F.col("kind") == HELD, F.col("own")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("kind") == HELD, F.col("other")).otherwise(F.col("own")).alias("j"),
    )
    n_tasks = max(1, -(-rows.count() // TASK_ROWS))
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(n_tasks)))

    def search(key: tuple, data: pa.Table) -> pa.Table:
        tidy()
        found = list(merged(as_table(data)))
        return pa.table(
            {"a": pa.array([a for a, _ in found], pa.string()), "b": pa.array([b for _, b in found], pa.string())}
        )

    return dealt.groupBy("task").applyInArrow(search, "a string, b string").distinct()


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Each word with its form, the most frequent near word if ``ratio`` times as frequent.

    ``words`` has distinct words and their counts n. ``root`` is the end of a word's chain of
    forms. Counts grow along a chain, so it has at most log(greatest n) links.
    """
    words = materialize(words.select("word", "n"), "words")
    pairs = materialize(near_words(words), "near")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("form_n"))
    best = F.min(F.struct(F.negative("form_n").alias("less"), "b"))
    near = both.join(counts, "b").groupBy("a").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near.withColumnRenamed("a", "word"), "word", "left")
    is_form = F.negative("best.less") >= ratio * F.col("n")
    joined = joined.select(
        "word",
        F.when(is_form, F.col("best.b")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.negative("best.less")).alias("form_n"),
    )
    joined = materialize(joined, "forms")

    ends = materialize(joined.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    greatest = words.agg(F.max("n")).first()[0] or 1
    links = int(math.log(greatest, ratio)) + 1 if ratio > 1 else greatest
    for _ in range(max(1, math.ceil(math.log2(links + 1)))):
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ends = ends.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        ends = materialize(ends, "roots")
    out = joined.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    noise: int | None = None,
) -> DataFrame:
    """``spelling_variants`` of the words that occur ``min_count`` times in all texts together."""
    counted = count_words(docs, id_col, text_col, MIN_LENGTH, noise)
    return spelling_variants(counted.filter(F.col("n") >= min_count))
