"""Packing of documents into fixed windows by minimum bin slack.

``pack`` cuts the token ids of every document into full windows and one rest, and fills
windows with rests. Rests are known by length alone: a histogram over 1..window-1, which
has a fixed size whatever the table holds, decides how many of which length share a
window (``fill_windows``). The pieces are then dealt out by arithmetic: the i-th piece of
its length lies at a computed place.

Defined results: a null text has no tokens of its own, so only the closing id; repeated
rows and ids are packed one by one; an empty table gives no piece; other columns of the
input are not looked at. A text of any length is tokenized whole, in units that end where the
pre-tokenizer of the byte-level vocabulary always cuts.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladderlake.llm.text import Known, chunks, gather, utf8
from ladderlake.session import staging_path

WINDOW = 1024
END_ID = 0

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "part int, place bigint"
)


def fill_windows(counts: np.ndarray, window: int) -> list[tuple[dict[int, int], int]]:
    """Minimum bin slack: (how many of each length, how many windows alike).

    ``counts[l]`` rests of length l wait. The longest one opens a window; a bitset of
    reachable sums over the other rests (each length at most as often as it is left)
    gives the fullest window, and walking back through the bitsets gives the counts.
    The same choice is repeated while all its rests last.
    """
    left = {length: int(n) for length, n in enumerate(counts) if n and length}
    plan: list[tuple[dict[int, int], int]] = []
    while left:
        first = max(left)
        room = window - first
        mask = (1 << (room + 1)) - 1
        reach, steps = 1, []
        for length in sorted(left, reverse=True):
            most = min(left[length] - (length == first), room // length)
            taken = 1
            while most > 0:  # 1, 2, 4, ... copies: any number up to most
                taken = min(taken, most)
                new = (reach | (reach << (taken * length))) & mask
                if new != reach:
                    steps.append((length, taken, reach))
                    reach = new
                most -= taken
                taken *= 2
            if reach >> room:
                break
        total = reach.bit_length() - 1
        chosen = {first: 1}
        for length, taken, before in reversed(steps):
            if not before >> total & 1:
                total -= taken * length
                chosen[length] = chosen.get(length, 0) + taken
        times = min(left[length] // n for length, n in chosen.items())
        plan.append((chosen, times))
        for length, n in chosen.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return plan


def layout(plan: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """Rows (length, from_place, sequence, offset, each): where the pieces of a length go.

    Piece number ``place`` of its length, counted from 0, with from_place the largest not
    above it, is in window ``sequence + (place - from_place) // each`` at
    ``offset + (place - from_place) % each * length``.
    """
    rows, sequence, used = [], 0, {}
    for chosen, times in plan:
        offset = 0
        for length, n in chosen.items():
            rows.append((length, used.get(length, 0), sequence, offset, n))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return pd.DataFrame(
        rows, columns=["length", "from_place", "sequence", "offset", "each"], dtype="int64"
    )


def _bytes(*codes: int) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes)] = True
    return out


_SPACE = _bytes(0x20, *range(0x09, 0x0E))
_LETTER = _bytes(*range(0x41, 0x5B), *range(0x61, 0x7B))
_SIGN = _bytes(*range(0x21, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F))
# White space beyond ASCII ends in these two bytes; no unit is cut behind them.
_WIDE_LEAD = _bytes(0xC2, 0x80, 0x81, 0x9A)
_WIDE_END = _bytes(*range(0x80, 0x8B), 0xA0, 0xA8, 0xA9, 0xAF, 0x9F)


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of units, which can be tokenized alone.

    They are at a text's start, at white space behind anything else, and at an ASCII digit
    or sign behind an ASCII letter: the pre-tokenizer always cuts there, whatever surrounds
    the place. Behind what may be the last byte of wide white space no cut is made, and
    none inside the name of the special token.
    """
    n = len(data)
    cut = np.zeros(n, bool)
    cut[1:] = _SPACE[data[1:]] & ~_SPACE[data[:-1]]
    cut[2:] &= ~(_WIDE_END[data[1:-1]] & _WIDE_LEAD[data[:-2]])
    cut[1:] |= _LETTER[data[:-1]] & _SIGN[data[1:]] & (data[1:] != ord("|"))
    cut[offsets[offsets < n]] = True
    return np.flatnonzero(cut)


# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is
    printable, else the next one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """Ranks of a byte-level vocabulary file whose ids follow the order of its merges."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    model, cutter = held["model"], held.get("pre_tokenizer") or {}
    plain = cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space")
    if not plain or held.get("normalizer") or model.get("type") != "BPE":
        return None
    vocab, merges = model["vocab"], model["merges"]
    added = {x["content"] for x in held.get("added_tokens", [])}
    joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
    if any(vocab.get(token) != 256 + k for k, token in enumerate(joined)):
        return None
    letters = byte_letters()
    return {
        bytes(letters[c] for c in token): id_ for token, id_ in vocab.items() if token not in added
    }


class UnitTokenizer:
    """Ids of many texts: distinct units are tokenized once a chunk, or known from before.

    Where a vocabulary's ids follow the order of its merges, merging by ids gives the
    tokenizer's own result and is much quicker; any other is left to the tokenizer.
    """

    KNOWN = 150_000
    BATCH = 10_000
    _opened: dict[str, UnitTokenizer] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = merge_ranks(path)
        self.merging = ranks and tiktoken.Encoding(
            "units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.known = Known(self.KNOWN)

    @classmethod
    def open(cls, path: str) -> UnitTokenizer:
        """One for each worker process."""
        if path not in cls._opened:
            cls._opened[path] = cls(path)
        return cls._opened[path]

    def ids_of(self, units: list[str]) -> list[bytes]:
        """The ids of each of some distinct units, four bytes each."""
        out = [self.known.get(unit) for unit in units]
        new = [k for k, ids in enumerate(out) if ids is None]
        for start in range(0, len(new), self.BATCH):
            some = new[start : start + self.BATCH]
            for k, ids in zip(some, self.encode([units[k] for k in some])):
                out[k] = array("I", ids).tobytes()
                if len(units[k]) <= 64:
                    self.known.put(units[k], out[k])
        return out

    def encode(self, units: list[str]) -> list[list[int]]:
        if not self.merging or any(s in u for s in self.special for u in units):
            found = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
            return [x.ids for x in found]
        return list(map(self.merging.encode_ordinary, units))

    def ids(self, column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        data, offsets = utf8(column)
        starts = unit_starts(data, offsets)
        places = np.append(starts, len(data)).astype(np.int64)
        units = pa.Array.from_buffers(
            pa.large_string(),
            len(starts),
            [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))],
        ).dictionary_encode()
        codes = units.indices.to_numpy(zero_copy_only=False)
        raw = self.ids_of(units.dictionary.to_pylist())
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        flat = np.frombuffer(b"".join(raw), np.uint32)
        lengths = sizes[codes]
        ids = flat[gather((np.cumsum(sizes) - sizes)[codes], lengths)]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(sums[np.searchsorted(starts, offsets)])


def cut_pieces(docs: DataFrame, path: str, window: int, id_col: str, text_col: str) -> DataFrame:
    """A row per piece; ``place`` counts the pieces of its length within the scan task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = UnitTokenizer.open(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for table in chunks(batches, 1):
            ids, own = tokenizer.ids(table.column(1))
            total = own + 1
            whole = np.empty(int(total.sum()), "<u4")
            ends = np.cumsum(total)
            whole[ends - 1] = END_ID
            is_id = np.ones(len(whole), bool)
            is_id[ends - 1] = False
            whole[is_id] = ids
            n_pieces = -(-total // window)
            doc = np.repeat(np.arange(len(total)), n_pieces)
            start = gather(np.zeros(len(total), np.int64), n_pieces) * window
            length = np.minimum(total[doc] - start, window)
            begin = (ends - total)[doc] + start
            raw = whole.view(np.uint8)
            crc = np.fromiter(
                (zlib.crc32(raw[4 * b : 4 * (b + n)]) for b, n in zip(begin, length)),
                np.int64,
                len(begin),
            )
            order = np.argsort(length, kind="stable")
            in_order = length[order]
            first = np.searchsorted(in_order, in_order)
            place = np.empty(len(length), np.int64)
            place[order] = np.arange(len(length)) - first + seen[in_order]
            seen += np.bincount(length, minlength=window + 1)
            yield pa.record_batch(
                [
                    table.column(0).combine_chunks().take(pa.array(doc)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc),
                    pa.array(total[doc]),
                    pa.array(np.full(len(doc), part, np.int32)),
                    pa.array(place),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "place"],
            )

    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col))
    return docs.mapInArrow(run, PIECES)


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every piece of every document with its window (sequence_id) and offset there.

    The pieces are written once to the shared folder, so that their numbers cannot change
    when a task is repeated. Only the histogram of lengths (at most ``window`` rows)
    reaches the driver; numbers within a length come from counts per scan task.
    """
    spark = docs.sparkSession
    path = staging_path(spark, "pieces")
    cut_pieces(docs, tokenizer, window, id_col, text_col).write.parquet(path)
    pieces = spark.read.schema(PIECES).parquet(path)

    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = np.zeros(window + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    rows = layout(fill_windows(counts, window))

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    shifts = sizes.select("length", "part", before.alias("shift"))
    placed = pieces.join(shifts, ["length", "part"]).withColumn("place", F.expr("place + shift"))

    by_length = {k: g.reset_index(drop=True) for k, g in rows.groupby("length")}

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            place = batch.column("place").to_numpy()
            sequence, offset = np.empty_like(length), np.empty_like(length)
            for n in np.unique(length):
                here, own = by_length[n], np.flatnonzero(length == n)
                k = np.searchsorted(here["from_place"].to_numpy(), place[own], "right") - 1
                row = here.iloc[k]
                nth = place[own] - row["from_place"].to_numpy()
                each = row["each"].to_numpy()
                sequence[own] = row["sequence"].to_numpy() + nth // each
                offset[own] = row["offset"].to_numpy() + nth % each * n
            kept = [batch.column(c) for c in _KEPT]
            yield pa.record_batch(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=[*_KEPT, "sequence_id", "offset"],
            )

    return placed.select(*_KEPT, "place").mapInArrow(
        locate,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )


_KEPT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
