"""Quality rules with risk-controlled thresholds.

``measure`` counts, for every whole text, what the rules look at. Base rules are fixed.
The method's rules reject a document whose share exceeds a cutoff of its stratum. The holdout
is the documents labelled good. The cutoffs of all rules tighten along one sequence of
steps, and an exact binomial test on the holdout decides at each step whether at most ``risk``
of the stratum's good documents are rejected by any rule. Testing ends at the first step that
fails, which needs no correction for the number of steps; the error probability ``delta`` is
divided over the strata and one pooled stratum (Bonferroni).

The sequence is fixed by documents outside the holdout, so those that certify a cutoff have no
part in choosing it. Unlabelled documents are a mixture of good ones and others, and those
labelled but not good show what the others look like; so the share of good documents that a
rule rejects above a value is estimated by the difference. At a step, every rule is tightened
to the same estimate, to which a tenth of the share of all unlabelled documents above the value
is added, so that the most extreme go first where the estimate is zero. A share of zero is
never rejected. Only counts by rule and thousandth are kept of them, 1,001 for each rule.

One of the rules looks at terms that mark toxic documents, which are learnt. Candidates are
terms of at least a twentieth of the documents labelled toxic, fitted on ``FIT_DOCS`` of these at
most and on ``CANDIDATES`` terms at most. All documents without a label are then counted: a
candidate marks toxicity if at least half of those that hold it are toxic, as estimated from
the labels' share of toxic documents. The holdout has no part in it.

A stratum with too few good labels for any cutoff takes those of the pooled stratum, of all
languages together. Their guarantee is weaker: at most ``risk`` of the good documents of all
strata are rejected by them. Where even the pool has too few, only the base rules reject.

All labelled documents count. Only a row for each stratum and step is kept of them.

Defined results: null or empty texts have zero counts and fail the base rule; a null stratum
is a stratum; a document without a label, or with a null one, is outside the holdout; of several
labels for one doc_id the worst counts; labels of a null doc_id are left out; repeated rows are
judged one by one, and are all in the holdout or all outside; a very long text is a chunk of its
own; with empty labels, or no document outside the holdout, only the base rule rejects; without
unlabelled documents no term marks toxicity; an empty
table of documents gives an empty one; columns of clashing names are kept, and the added ones
evade them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.llm.text import (
    ALNUM,
    chunks,
    column_name,
    covered,
    hashes,
    mix,
    per_text,
    runs,
    window_hashes,
    words,
)
from ladderlake.session import materialize

RISK = 0.02
DELTA = 0.05
REPEAT_WINDOW = 5

COUNTS = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in (
            "n_words",
            "word_chars",
            "n_symbols",
            "n_lines",
            "n_dup_lines",
            "n_repeat_words",
        )
    ]
    # Which candidate terms a text holds, and how often each.
    + [T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.LongType()))]
)

# Rule: share in thousandths, rejected above a cutoff.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "toxic_terms": ("n_toxic_words", "n_words"),
}

FIT_DOCS = 20_000
CANDIDATES = 20_000
LEAST_DOCS = 10

STEPS = 10_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def repeated(lanes: np.ndarray, of: np.ndarray, width: int) -> np.ndarray:
    """True for each word inside a window that its text holds twice or more."""
    n = len(of)
    if n < width:
        return np.zeros(n, bool)
    one, two = (window_hashes(np.ascontiguousarray(lanes[:, k]), width) for k in (0, 1))
    starts = np.flatnonzero(of[: n - width + 1] == of[width - 1 :])
    one, two, text = one[starts], two[starts], of[starts]
    order = np.argsort(mix(one, text.astype(np.uint64)))
    one, two, text = one[order], two[order], text[order]
    same = (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & (text[1:] == text[:-1])
    twice = np.zeros(len(starts), bool)
    twice[1:] |= same
    twice[:-1] |= same
    return covered(starts[order[twice]], width, n)


def counts(column: pa.ChunkedArray) -> dict[str, np.ndarray]:
    """The fields of ``COUNTS`` for each text of a chunk."""
    found = words(column)
    data, offsets = found.data, found.offsets
    letter = found.inside & ((data & 0xC0) != 0x80)

    in_line = data != 0x0A
    starts, ends = runs(in_line, offsets)
    filled = np.concatenate([[0], np.cumsum(found.inside)])
    has_word = filled[ends] > filled[starts]
    places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    lines = pa.Array.from_buffers(
        pa.large_binary(),
        len(starts),
        [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[in_line]))],
    ).dictionary_encode()
    first_line = np.searchsorted(starts, offsets)
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(first_line))
    key = of * (len(lines.dictionary) + 1) + lines.indices.to_numpy(zero_copy_only=False)
    again = np.ones(len(key), bool)
    again[np.unique(key, return_index=True)[1]] = False

    codes, dictionary = found.codes()
    lanes = hashes(dictionary)[codes]
    return {
        "n_words": np.diff(found.first),
        "word_chars": per_text(letter, offsets),
        "n_symbols": per_text(_SYMBOL[data], offsets),
        "n_lines": per_text(has_word, first_line),
        "n_dup_lines": per_text(has_word & again, first_line),
        "n_repeat_words": per_text(repeated(lanes, found.of(), REPEAT_WINDOW), found.first),
    }


def terms_held(column: pa.ChunkedArray, candidates: pa.Array) -> tuple[pa.Array, pa.Array]:
    """For each text the numbers of the candidates it holds, increasing, and how often."""
    n_texts = len(column)
    if len(candidates):
        found = words(column, ALNUM, lower=True)
        codes, dictionary = found.codes()
        own = pc.fill_null(pc.index_in(dictionary, candidates), -1).to_numpy()[codes]
        held = own >= 0
        keys = np.sort(found.of()[held] * len(candidates) + own[held])
    else:
        keys = np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    times = np.diff(np.append(first, len(keys)))
    doc, term = np.divmod(keys[first], max(1, len(candidates)))
    bounds = pa.array(np.searchsorted(doc, np.arange(n_texts + 1)).astype(np.int32))
    return (
        pa.ListArray.from_arrays(bounds, pa.array(term.astype(np.int32))),
        pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int64))),
    )


def measure(
    docs: DataFrame,
    text_col: str = "text",
    carry: list[str] | None = None,
    counts_col: str = "counts",
    candidates: list[str] | None = None,
) -> DataFrame:
    """The documents (columns ``carry``, or all) with a struct of their counts."""
    wanted = pa.array([t.encode() for t in candidates or []], pa.large_binary())
    carry = docs.columns if carry is None else carry
    counts_col = column_name(counts_col, carry)
    kept = docs.select(*[F.col(f"`{c}`") for c in carry])
    names = [*carry, counts_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, 0):
            found = counts(table.column(0))
            found["terms"], found["times"] = terms_held(table.column(0), wanted)
            struct = pa.StructArray.from_arrays(
                [pa.array(found[c]) for c in COUNTS.names], names=COUNTS.names
            )
            columns = [c.combine_chunks() for c in table.remove_column(0).columns]
            yield pa.RecordBatch.from_arrays([*columns, struct], names=names)

    schema = T.StructType([*kept.schema.fields, T.StructField(counts_col, COUNTS)])
    text = F.col(f"`{text_col}`").alias(column_name("text", carry))
    return docs.select(text, *kept.columns).mapInArrow(run, schema)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P[Binomial(n, p) <= k], exact up to rounding, by the incomplete beta function."""
    if k < 0:
        return 0.0
    if k >= n:
        return 1.0
    return incomplete_beta(n - k, k + 1, 1 - p)


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b)
        - math.lgamma(a)
        - math.lgamma(b)
        + a * math.log(x)
        + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    value, m = d, 0
    while True:
        m += 1
        change = 1.0
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + term * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + term / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
            change = max(abs(d * c - 1), change if change < 1 else 0.0)
        if change < 1e-14 or m > 1_000_000:
            return front * value / a


def allowed(n: int, risk: float, delta: float) -> int:
    """Most false rejections among n good documents that still show a rate of at most
    ``risk`` with error ``delta``; -1 if even none would not."""
    low, high = -1, n
    while high - low > 1:
        mid = (low + high) // 2
        if binomial_cdf(mid, n, risk) <= delta:
            low = mid
        else:
            high = mid
    return low


def share(top: str, bottom: str, counts_col: str) -> F.Column:
    """Thousandths, rounded down; zero where there is nothing to divide by."""
    part, whole = F.col(counts_col)[top], F.col(counts_col)[bottom]
    return F.when(whole > 0, F.floor(part * 1000 / whole)).otherwise(0).cast("bigint")


def good_labels(labels: DataFrame, id_col: str) -> DataFrame:
    """A ``label_id`` for each document labelled with quality 1 and not toxic."""
    return (
        labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .filter("quality = 1 and coalesce(toxic, 0) = 0")
    )


def base_failed(counts_col: str) -> F.Column:
    c = F.col(counts_col)
    return (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])


def labelled_toxic(labels: DataFrame, id_col: str) -> DataFrame:
    """(label_id, toxic) for each labelled document."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
    worst = F.coalesce(F.max("toxic"), F.lit(0)) == 1
    return known.groupBy(F.col(id_col).alias("label_id")).agg(worst.alias("toxic"))


def candidate_terms(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[dict[str, int], int]:
    """Terms of at least a twentieth of a sample of toxic documents, in how many each is, and
    the sample's size. The sample's ids, ``FIT_DOCS`` of them, are broadcast."""
    ids = labelled_toxic(labels, id_col).filter("toxic").select("label_id")
    ids = materialize(ids.orderBy(F.xxhash64("label_id"), "label_id").limit(FIT_DOCS), "toxic_ids")
    own = docs.select(F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{text_col}`").alias("text"))
    sample = own.join(F.broadcast(ids), "label_id", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, 0):
            found = words(table.column(0), ALNUM, lower=True)
            codes, terms = found.codes()
            pairs = np.unique(found.of() * max(1, len(terms)) + codes, return_index=True)[0]
            n = np.bincount(pairs % max(1, len(terms)), minlength=len(terms))
            names = pa.concat_arrays([terms.cast(pa.large_string()).cast(pa.string()), pa.nulls(1, pa.string())])
            columns = [names, pa.array(np.append(n, table.num_rows).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "n"])

    held = sample.mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    held = materialize(held, "toxic_words")
    n_docs = held.filter("term is null").agg(F.sum("n")).first()[0] or 0
    often = held.filter(f"term is not null and n >= {LEAST_DOCS} and 20 * n >= {n_docs}")
    rows = often.orderBy(F.desc("n"), "term").limit(CANDIDATES).collect()
    return {r.term: r.n for r in rows}, n_docs


def toxic_terms(
    measured: DataFrame,
    labels: DataFrame,
    candidates: dict[str, int],
    n_sample: int,
    id_col: str,
    counts_col: str,
) -> list[int]:
    """The numbers of the candidates that mark toxic documents, by all unlabelled documents."""
    slim = measured.select(F.col(f"`{id_col}`").alias("label_id"), F.col(counts_col)["terms"].alias("terms"))
    slim = slim.join(labelled_toxic(labels, id_col), "label_id", "left").select("toxic", "terms")
    sizes = {r.toxic: r["n"] for r in slim.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    free, toxic = sizes.get(None, 0), sizes.get(True, 0)
    if not (candidates and free):
        return []
    held = slim.filter("toxic is null").select(F.explode("terms").alias("term"))
    held = {r.term: r["n"] for r in held.groupBy("term").agg(F.count("*").alias("n")).collect()}
    labelled = toxic + sizes.get(False, 0)
    return [
        k
        for k, n in enumerate(candidates.values())
        if 2 * toxic * n * free >= held.get(k, 0) * labelled * n_sample
    ]


def measure_all(
    docs: DataFrame,
    labels: DataFrame,
    carry: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    counts_col: str = "counts",
) -> DataFrame:
    """The documents (columns ``carry``), stored, with all counts, toxic words among them."""
    candidates, n_sample = candidate_terms(docs, labels, id_col, text_col)
    measured = materialize(measure(docs, text_col, carry, counts_col, list(candidates)), "counts")
    toxic = toxic_terms(measured, labels, candidates, n_sample, id_col, counts_col)
    found, marks = F.col(counts_col), F.from_json(F.lit(str(toxic)), "array<int>")
    pairs = F.arrays_zip(found["terms"], found["times"])
    marked = F.filter(pairs, lambda x: F.array_contains(marks, x["terms"]))
    n = F.aggregate(marked, F.lit(0).cast("bigint"), lambda a, x: a + x["times"])
    return measured.withColumn(counts_col, found.dropFields("terms", "times").withField("n_toxic_words", n))


def sequence(
    measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", counts_col: str = "counts"
) -> dict[str, list[int]]:
    """For each rule and share, from 0 to 1,000 thousandths, the step that rejects it.

    Where all documents are labelled, those that are not good take the part of the unlabelled.
    """
    rules = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), share(*pair, counts_col).alias("value"))
            for rule, pair in RULES.items()
        ]
    )
    good = good_labels(labels, id_col).select("label_id", F.lit("good").alias("good"))
    named = labels.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("label_id"))
    kinds = named.distinct().join(good, "label_id", "left")
    kinds = kinds.select("label_id", F.coalesce("good", F.lit("other")).alias("kind"))
    counted = (
        measured.filter(~base_failed(counts_col))
        .select(F.col(f"`{id_col}`").alias("label_id"), rules.alias("r"))
        .join(kinds, "label_id", "left")
        .groupBy("kind", "r")
        .agg(F.count("*").alias("n"))
        .select("kind", F.inline("r"), "n")
        # Of the holdout, the size and nothing else.
        .groupBy("kind", "rule", F.when(F.col("kind") == "good", 0).otherwise(F.col("value")).alias("value"))
        .agg(F.sum("n").alias("n"))
    )
    counts_ = {(kind, rule): [0] * 1001 for kind in (None, "other", "good") for rule in RULES}
    for row in counted.collect():  # two times 1,001 for each rule at most, and one more
        counts_[row.kind, row.rule][row.value] = row.n
    return {rule: _steps(*(counts_[kind, rule] for kind in (None, "other", "good"))) for rule in RULES}


def _steps(unlabelled: list[int], other: list[int], good: list[int]) -> list[int]:
    n_labelled = sum(other) + sum(good)
    if not sum(unlabelled):
        unlabelled, other = other, [0] * len(other)
    n = sum(unlabelled)
    out, above, above_other, most = [], 0, 0, 0
    for v in range(len(unlabelled) - 1, -1, -1):
        above, above_other = above + unlabelled[v], above_other + other[v]
        # In parts of n * n_labelled; a lower cutoff never rejects fewer.
        most = max(most, above * n_labelled - above_other * n)
        cost = 10 * most + above * n_labelled
        out.append(cost * STEPS // (10 * n * n_labelled) if n * n_labelled else 0)
    return out[::-1]


def rejecting_step(steps: dict[str, list[int]], counts_col: str) -> F.Column:
    """The first step at which a rule rejects a document; null if none does."""
    found = []
    for rule, pair in RULES.items():
        value = share(*pair, counts_col)
        own = F.from_json(F.lit(str(steps[rule])), "array<bigint>")
        step = F.element_at(own, F.least(value, F.lit(1000)).cast("int") + 1)
        found.append(F.when(value > 0, step))
    return F.least(*found)


def joint_steps(
    stepped: DataFrame,
    labels: DataFrame,
    stratum_col: str,
    risk: float = RISK,
    delta: float = DELTA,
    id_col: str = "doc_id",
    step_col: str = "step",
) -> DataFrame:
    """Rows (pooled, stratum, n_good, n_allowed, stop) of the strata with cutoffs, and of the
    pool; a document is rejected by the steps before ``stop``, by all if it is null.

    ``stepped`` has the documents that pass the base rules, with the step that rejects them.
    Good ones are counted by it, so the first step at which more than ``n_allowed`` are rejected
    is the first that fails.
    """
    held = (
        stepped.select(
            F.col(f"`{id_col}`").alias("label_id"),
            F.col(f"`{stratum_col}`").alias("stratum"),
            F.col(step_col).alias("step"),
        )
        .join(good_labels(labels, id_col), "label_id", "left_semi")
        .groupBy("stratum", "step")
        .agg(F.count("*").alias("n"))
    )
    held = materialize(held, "holdout")
    n_tests = held.select("stratum").distinct().count() + 1
    pool = held.groupBy("step").agg(F.sum("n").alias("n"))
    held = held.withColumn("pooled", F.lit(False)).unionByName(
        pool.withColumn("pooled", F.lit(True)), allowMissingColumns=True
    )

    @F.pandas_udf("bigint")
    def most(n: pd.Series) -> pd.Series:
        found = {k: allowed(int(k), risk, delta / n_tests) for k in n.unique()}
        return n.map(found)

    totals = held.groupBy("pooled", "stratum").agg(F.sum("n").alias("n_good"))
    totals = totals.withColumn("n_allowed", most("n_good")).filter("n_allowed >= 0")
    up_to = Window.partitionBy("pooled", "stratum").orderBy(F.asc_nulls_last("step"))
    rejected = held.withColumn("rejected", F.sum("n").over(up_to))
    return (
        totals.alias("b")
        .join(rejected.alias("a"), F.expr("a.pooled = b.pooled and a.stratum <=> b.stratum"))
        .groupBy("b.pooled", "b.stratum", "b.n_good", "b.n_allowed")
        .agg(F.min(F.expr("case when a.rejected > b.n_allowed then a.step end")).alias("stop"))
    )


def judge(
    measured: DataFrame,
    labels: DataFrame,
    stratum_col: str,
    id_col: str = "doc_id",
    counts_col: str = "counts",
    kept_col: str = "kept",
    **options,
) -> DataFrame:
    """``measured``, a stored table, with the verdict."""
    steps = sequence(measured, labels, id_col, counts_col)
    step_col, name = (column_name(c, measured.columns) for c in ("step", "stops"))
    stepped = measured.withColumn(step_col, rejecting_step(steps, counts_col))
    passed = stepped.filter(~base_failed(counts_col))
    stops = joint_steps(passed, labels, stratum_col, id_col=id_col, step_col=step_col, **options)
    stops = materialize(stops, "stops")
    pool = stops.filter("pooled").first()  # one row, or none
    own = stops.filter("not pooled").select(F.struct("stratum", "stop").alias(name))
    judged = stepped.join(own, F.col(f"`{stratum_col}`").eqNullSafe(F.col(name)["stratum"]), "left")
    pooled = F.lit(pool.stop if pool else 0).cast("bigint")  # no step comes before 0
    stop = F.when(F.col(name).isNotNull(), F.col(name)["stop"]).otherwise(pooled)
    above = F.col(step_col).isNotNull() & (stop.isNull() | (F.col(step_col) < stop))
    return judged.withColumn(kept_col, ~base_failed(counts_col) & ~above).drop(name, step_col)


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    stratum_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """The documents that the rules keep, with their own columns; texts are measured once."""
    counts_col, kept_col = (column_name(c, docs.columns) for c in ("counts", "kept"))
    measured = measure_all(docs, labels, docs.columns, id_col, text_col, counts_col)
    judged = judge(measured, labels, stratum_col, id_col, counts_col, kept_col, **options)
    return judged.filter(F.col(kept_col)).select(*[F.col(f"`{c}`") for c in docs.columns])


def rate(
    docs: DataFrame,
    labels: DataFrame,
    stratum_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """A row per document: id, stratum, counts and the verdict ``kept``."""
    slim = measure_all(docs, labels, [id_col, stratum_col], id_col, text_col)
    return judge(slim, labels, stratum_col, id_col, **options)
