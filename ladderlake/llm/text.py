"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

All functions take whole texts; null texts count as empty. A chunk of texts is bounded
by the caller (``chunks``), so no array here grows with the table.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 4 << 20

# Bytes of words [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

# Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def as_table(data: pa.RecordBatch | pa.Table) -> pa.Table:
    return data if isinstance(data, pa.Table) else pa.Table.from_batches([data])


def chunks(
    batches: Iterable[pa.RecordBatch], column: int | str, size: int = CHUNK_BYTES
) -> Iterator[pa.Table]:
    """The rows as tables of about ``size`` bytes of text; a longer text stands alone."""
    tidy()
    held: list[pa.RecordBatch] = []
    room = size
    for batch in batches:
        lengths = np.diff(utf8(batch.column(column))[1])
        start = 0
        while start < batch.num_rows:
            ends = np.cumsum(lengths[start:])
            n = max(1, int(np.searchsorted(ends, room, side="right")))
            if ends[0] > room and held:
                yield pa.Table.from_batches(held)
                held, room = [], size
                continue
            held.append(batch.slice(start, n))
            room -= int(ends[n - 1])
            start += n
            if room <= 0:
                yield pa.Table.from_batches(held)
                held, room = [], size
    if held:
        yield pa.Table.from_batches(held)
    held = []
    tidy()


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def tidy() -> None:
    """Give freed memory back: Python workers live on between tasks of all kinds."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text starts (one more entry)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """``starts[i]:ends[i]`` are the bytes of word i; text d has words ``first[d]:first[d + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    inside: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def array(self) -> pa.Array:
        """All words as an Arrow column of bytes."""
        places = np.concatenate([[0], np.cumsum(self.ends - self.starts)]).astype(np.int64)
        kept = np.ascontiguousarray(self.data[self.inside])
        return pa.Array.from_buffers(
            pa.large_binary(), len(self), [None, pa.py_buffer(places), pa.py_buffer(kept)]
        )

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, and the distinct words in the order of these numbers."""
        coded = self.array().dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values, which never cross a text's bound."""
    n = len(inside)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    bounds = offsets[(offsets > 0) & (offsets < n)]
    before[bounds], after[bounds - 1] = False, False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def words(column, letters: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    data, offsets = utf8(column)
    if lower:
        data = LOWER[data]
    inside = letters[data]
    starts, ends = runs(inside, offsets)
    return Words(data, offsets, inside, starts, ends, np.searchsorted(starts, offsets))


def hashes(column: pa.Array) -> np.ndarray:
    """128 bits (two 64-bit lanes) of each value of a column of bytes."""
    values = column.to_pylist()
    raw = b"".join(map(xxhash.xxh3_128_digest, values))
    return np.frombuffer(raw, np.uint64).reshape(len(values), 2)


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One 64-bit hash of an ordered pair of hashes."""
    out = (left ^ (left >> np.uint64(31))) * _K1 + (right ^ (right >> np.uint64(29))) * _K2
    return out ^ (out >> np.uint64(32))


def window_hashes(lane: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n neighbours; a window's hash depends on its n values alone."""
    if len(lane) < n:
        return np.zeros(0, np.uint64)
    doubled, width, out, done = lane, 1, None, 0
    left = n
    while True:
        if left & 1:
            if out is None:
                out = doubled
            else:
                size = len(lane) - done - width + 1
                out = mix(out[:size], doubled[done : done + size])
            done += width
        left >>= 1
        if not left:
            return out[: len(lane) - n + 1]
        doubled = mix(doubled[:-width], doubled[width:])
        width *= 2


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """True for the places 0..size that lie in any window starting at ``starts``."""
    change = np.bincount(starts, minlength=size + 1)
    change = change - np.bincount(np.minimum(starts + width, size), minlength=size + 1)
    return np.cumsum(change[:-1]) > 0


def per_text(counted: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``counted`` over ``first[d] : first[d + 1]`` for every text d."""
    sums = np.concatenate([[0], np.cumsum(counted, dtype=np.int64)])
    return np.diff(sums[first])


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all runs ``starts[i] : starts[i] + lengths[i]``, one after another."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return np.arange(total) + shift


def column_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, with underscores as long as the (case-insensitive) name is taken."""
    names = {x.lower() for x in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


class Known:
    """What was learnt lately: up to ``size`` keys, and the ``size`` before them.

    A key that is used again moves to the newer half, so frequent keys stay.
    """

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key: str):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key: str, value) -> None:
        if len(self.new) >= self.size:
            self.new, self.old = {}, self.new
        self.new[key] = value
