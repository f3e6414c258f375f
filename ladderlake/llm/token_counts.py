"""Token counts of a unigram vocabulary by Viterbi, without building tokens.

An Aho-Corasick automaton enumerates all vocabulary pieces that end at each character; the
dynamic programme carries two numbers per position: the best score of a segmentation up to
there and how many tokens it has. Rules of the unigram tokenizer: at equal scores the piece
that starts earlier wins; a character no single piece covers may be taken as unknown, at the
lowest score of the vocabulary less 10, and then counts one byte token per UTF-8 byte.

The text is normalised as the vocabulary's own model does: a marker before the text and for
each space. Where no piece holds a marker behind another character, no token can span such
a place, so that the text falls into units there and each distinct unit is counted once per
chunk. Otherwise the whole text is one unit.

Defined results: null and empty texts have no tokens; repeated rows are counted each; a very
long text is a chunk of its own and counted whole; of pieces with equal scores the tokenizer's own
rule decides; an empty table gives an empty one; other columns are carried along, and the added
one evades their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.llm.text import Known, chunks, column_name, per_text, utf8

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_MARK_END = MARK.encode()[-1]


@dataclass
class Vocabulary:
    """Pieces with their scores; bytes stand in for unknown characters."""

    scores: dict[str, float]
    lowest: float

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = range(model.vocab_size())
        special = [model.is_control, model.is_unknown, model.is_byte, model.is_unused]
        scores = {
            model.id_to_piece(i): model.get_score(i)
            for i in pieces
            if not any(of(i) for of in special)
        }
        return cls(scores, min(model.get_score(i) for i in pieces))


class Counter:
    KNOWN = 250_000
    _opened: dict[str, Counter] = {}

    def __init__(self, vocabulary: Vocabulary):
        self.known = Known(self.KNOWN)
        self.unknown = vocabulary.lowest - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.cuts = all(MARK not in piece.lstrip(MARK) for piece in vocabulary.scores)

    def count(self, text: str) -> int:
        """Tokens of the best segmentation of one normalised unit."""
        n = len(text)
        best = [0.0] * (n + 1)
        count = [0] * (n + 1)
        done = 0  # positions up to here are final
        covered = [False] * n
        found: list[tuple[int, float]] = []
        end = 0

        def close(end: int, found: list[tuple[int, float]]) -> None:
            """Settle position ``end``; pieces are listed from the longest, the tie rule."""
            single = any(length == 1 for length, _ in found)
            if not single:
                found = [*found, (0, self.unknown)]
            top = None
            for length, score in found:
                start = end - (length or 1)
                total = best[start] + score
                if top is None or total > top:
                    top = total
                    own = 1 if length else len(text[start].encode())
                    count[end] = count[start] + own
            best[end] = top

        for last, piece in self.automaton.iter(text):
            while done < last:
                done += 1
                close(done, found if end == done else [])
            if end != last + 1:
                end, found = last + 1, []
            found.append(piece)
        while done < n:
            done += 1
            close(done, found if end == done else [])
        return count[n]

    def known_count(self, unit: str) -> int:
        """``count``, or what is known of a short unit."""
        count = self.known.get(unit)
        if count is None:
            count = self.count(unit)
            if len(unit) <= 64:
                self.known.put(unit, count)
        return count

    @classmethod
    def open(cls, path: str) -> Counter:
        """One for each worker process."""
        if path not in cls._opened:
            cls._opened[path] = cls(Vocabulary.load(path))
        return cls._opened[path]

    def column(self, column: pa.ChunkedArray) -> np.ndarray:
        """Token counts of all texts of a chunk."""
        data, offsets = utf8(column)
        if not self.cuts:
            return np.fromiter(
                (self.count(normalise(t)) if t else 0 for t in column.to_pylist()), np.int64
            )
        # Units start at a text's start and at a run of spaces, but not behind what may be
        # the last byte of a marker that stands in the text itself.
        space = data == 0x20
        cut = np.zeros(len(data), bool)
        cut[1:] = space[1:] & ~space[:-1] & (data[:-1] != _MARK_END)
        cut[offsets[offsets < len(data)]] = True
        starts = np.flatnonzero(cut)
        opening = np.isin(starts, offsets)
        places = np.append(starts, len(data)).astype(np.int64)
        units = pa.Array.from_buffers(
            pa.large_string(),
            len(starts),
            [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))],
        ).dictionary_encode()
        codes = units.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        distinct, of = np.unique(codes * 2 + opening, return_inverse=True)
        texts = units.dictionary.to_pylist()
        counts = np.fromiter(
            (
                self.known_count((MARK if key & 1 else "") + texts[key >> 1].replace(" ", MARK))
                for key in distinct.tolist()
            ),
            np.int64,
            len(distinct),
        )
        return per_text(counts[of], np.searchsorted(starts, offsets))


def normalise(text: str) -> str:
    return MARK + text.replace(" ", MARK)


def count_tokens(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    carry: list[str] | None = None,
    count_col: str = "n_tokens",
) -> DataFrame:
    """The documents (columns ``carry``, or all) with their number of tokens."""
    carry = docs.columns if carry is None else carry
    count_col = column_name(count_col, carry)
    kept = docs.select(*[F.col(f"`{c}`") for c in carry])
    names = [*carry, count_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.open(path)
        for table in chunks(batches, 0):
            counts = pa.array(counter.column(table.column(0)))
            columns = [c.combine_chunks() for c in table.remove_column(0).columns]
            yield pa.RecordBatch.from_arrays([*columns, counts], names=names)

    schema = T.StructType([*kept.schema.fields, T.StructField(count_col, T.LongType())])
    text = F.col(f"`{text_col}`").alias(column_name("text", carry))
    return docs.select(text, *kept.columns).mapInArrow(run, schema)
