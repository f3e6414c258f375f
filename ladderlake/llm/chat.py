"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context,
and only that reply is trained. Written out, the contexts of one conversation grow with the
square of its turns, and one conversation may hold a third of all rows; so each turn's formatted
text is written once (``format_turns``), and an example is a row with the ranges of its context
and of its reply in the conversation's text (``prefix_examples``). ``expand_examples`` writes
chosen examples out.

Template of a turn: ``<|role|>`` newline, text, ``</s>`` newline. A backslash is put before
every backslash and every control string inside roles and texts; taking it away again
restores them exactly.

Turns are dealt out in ranges of (conversation, turn, role) and sorted by these and the text, so
a long conversation is formatted by many tasks. Each task numbers the turns, characters and
examples of its slice, which is stored; what the earlier slices of a conversation have is
summed over slices and added. A task keeps one Arrow batch and a few numbers.

``read_back`` parses the stored turns and goes through the example rows beside them: an example
has to start where all turns before it end, and its reply alone is hashed. A hash over a
conversation's sequence cannot be divided, so there, and nowhere else, the turns of one
conversation pass through one task, as a stream.

Defined results: a null text or role is empty; turns without a conversation id form one
conversation; a null turn number comes first; turns of one number follow their role and text,
and repeated rows are turns of their own; the last turns behind the last reply are formatted too,
without an example; a very long text is one turn like others; an empty table gives nothing;
other columns, of whatever name, are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladderlake.session import materialize

# Control strings of the template and of common chat formats.
CONTROL = (
    "<|",
    "|>",
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
)
TRAINED_ROLE = "assistant"

_ESCAPED = re.compile(r"\\|(?=" + "|".join(map(re.escape, CONTROL)) + r").", re.S)
_BACK = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<\|((?:[^\\]|\\.)*?)\|>\n((?:[^\\]|\\.)*?)</s>\n", re.S)

# Turns as a task writes them: places count from the start of the conversation's slice.
SLICED = (
    "slice bigint, conv_id bigint, turn bigint, nth bigint, formatted string, width bigint, "
    "start bigint, example bigint, loss_start bigint, loss_end bigint"
)


def escape(text: str) -> str:
    return _ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its text starts and ends there."""
    head = f"<|{escape(role)}|>\n"
    body = escape(text)
    return f"{head}{body}</s>\n", len(head), len(head) + len(body)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted text; fails on anything else."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def format_turns(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """A row per turn: its formatted text, where that starts in the conversation's text
    (code points), and for assistant turns the example's number and its trained range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, current, nth, at, example = TaskContext.get().partitionId(), object(), 0, 0, 0
        for batch in batches:
            rows = []
            for conv, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != current:
                    current, nth, at, example = conv, 0, 0, 0
                formatted, low, high = format_turn(role, text)
                trained = role == TRAINED_ROLE
                loss = (example, at + low, at + high) if trained else (None, None, None)
                rows.append((own, conv, turn, nth, formatted, len(formatted), at, *loss))
                nth, at, example = nth + 1, at + len(formatted), example + trained
            yield _batch(rows, _SLICE_TYPES)

    ordered = turns.select(
        F.col(conv_col).cast("bigint").alias("c"),
        F.col(turn_col).cast("bigint").alias("t"),
        F.coalesce(F.col(role_col), F.lit("")).alias("r"),
        F.coalesce(F.col(text_col), F.lit("")).alias("x"),
    )
    ordered = ordered.repartitionByRange("c", "t", "r").sortWithinPartitions("c", "t", "r", "x")
    sliced = materialize(ordered.mapInArrow(run, SLICED), "turns")

    held = sliced.groupBy("conv_id", "slice").agg(
        F.count("*").alias("turns"), F.sum("width").alias("chars"), F.count("example").alias("examples")
    )
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    earlier = held.select(
        F.col("conv_id").alias("c"),
        F.col("slice").alias("s"),
        *[F.sum(n).over(before).alias(n) for n in ("turns", "chars", "examples")],
    )
    # Only the first conversation of a slice can go on from an earlier one.
    earlier = materialize(earlier.filter("turns is not null"), "earlier")
    placed = sliced.join(earlier, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("slice") == F.col("s")), "left")
    shift = {"nth": "turns", "start": "chars", "example": "examples", "loss_start": "chars", "loss_end": "chars"}
    columns = ("conv_id", "turn", "nth", "formatted", "start", "example", "loss_start", "loss_end")
    return placed.select(
        *[(F.col(c) + F.coalesce(shift[c], F.lit(0))).alias(c) if c in shift else c for c in columns]
    )


def prefix_examples(segments: DataFrame) -> DataFrame:
    """A row per assistant turn, the example that trains it: its context is the conversation's
    text up to ``context_end``, of all turns before; the reply is ``loss_start`` to ``loss_end``.
    """
    return segments.filter("example is not null").select(
        "conv_id", "example", "nth", F.col("start").alias("context_end"), "loss_start", "loss_end"
    )


def read_back(segments: DataFrame) -> DataFrame:
    """A row per conversation, parsed from its formatted turns and its examples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None
        for batch in batches:
            rows = []
            for conv, formatted, start, example, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is None or digest.conv != conv:
                    if digest:
                        rows.append(digest.row())
                    digest = _Digest(conv)
                if formatted is not None:
                    digest.add_turn(formatted, start)
                else:
                    digest.add_example(example, start, low, high)
            yield _batch(rows, _DIGEST_TYPES)
        if digest:
            yield _batch([digest.row()], _DIGEST_TYPES)

    turns = segments.select("conv_id", "nth", "formatted", "start")
    examples = prefix_examples(segments).withColumnRenamed("context_end", "start")
    rows = turns.unionByName(examples, allowMissingColumns=True)
    # An example follows the turn that it trains.
    kind = F.col("formatted").isNull()
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "nth", kind)
    ordered = ordered.select("conv_id", "formatted", "start", "example", "loss_start", "loss_end")
    return ordered.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )


class _Digest:
    def __init__(self, conv: int | None):
        self.conv, self.n, self.examples, self.loss_chars, self.chars = conv, 0, 0, 0, 0
        self.last, self.last_start = "", 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add_turn(self, formatted: str, start: int) -> None:
        if start != self.chars:
            raise ValueError(f"conversation {self.conv}: a turn is not where it should be")
        for role, text in parse_turns(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        self.last, self.last_start = formatted, start
        self.chars += len(formatted)

    def add_example(self, example: int, context_end: int, low: int, high: int) -> None:
        if (example, context_end) != (self.examples, self.last_start):
            raise ValueError(f"conversation {self.conv}: an example lacks turns before its reply")
        trained = unescape(self.last[low - context_end : high - context_end])
        self.loss.update(trained.encode())
        self.loss_chars += len(trained)
        self.examples += 1

    def row(self) -> tuple:
        turns, loss = self.turns.hexdigest(), self.loss.hexdigest()
        return self.conv, self.n, turns, self.loss_chars, loss, self.chars


def expand_examples(segments: DataFrame) -> DataFrame:
    """Examples written out: (conv_id, example, text, loss_start, loss_end).

    The size of the result grows with the square of a conversation's turns; select the
    conversations beforehand.
    """
    context = segments.select(
        F.col("conv_id").alias("c"), F.col("nth").alias("n"), F.col("formatted").alias("f")
    )
    targets = segments.filter("example is not null").select(
        "conv_id", "example", "nth", "loss_start", "loss_end"
    )
    parts = targets.join(context, F.expr("conv_id <=> c and n <= nth"))
    keys = ["conv_id", "example", "loss_start", "loss_end"]
    return parts.groupBy(*keys).agg(
        F.expr("array_join(transform(array_sort(collect_list(struct(n, f))), x -> x.f), '')").alias(
            "text"
        )
    )


_SLICE_TYPES = pa.schema(
    [
        ("slice", pa.int64()),
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("nth", pa.int64()),
        ("formatted", pa.string()),
        ("width", pa.int64()),
        ("start", pa.int64()),
        ("example", pa.int64()),
        ("loss_start", pa.int64()),
        ("loss_end", pa.int64()),
    ]
)
_DIGEST_TYPES = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
    )
