"""Ranked search against a plain scan of all documents."""

import random

import brute
import numpy as np
import pytest
from brute import rows_of

from ladderlake.llm import lexical

ITEMS = [
    (1, "same line here"),
    (2, None),
    (3, " \n"),
    (4, "a A a b w1 w2 w17"),
    (4, "x"),
    (None, "\u00dcn\u00efc\u00f6d\u00e9 \u65e5\u672c\u8a9e W100 w100"),
    (5, "absent everywhere"),
    (6, " ".join(f"w{k}" for k in range(0, 3000, 7))),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string, term string, item string, doc_id string")


@pytest.fixture(scope="module")
def items(spark):
    return frame(spark, [(*r, "t", "i", "d") for r in ITEMS])


@pytest.mark.parametrize("block_bytes", [1 << 23, 2000])
def test_search_equals_a_scan(odd_table, table_docs, items, block_bytes):
    out = lexical.search(odd_table, items, k=4, block_bytes=block_bytes)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(out) == brute.search(table_docs, ITEMS, 4)


def test_empty_tables_give_no_rows(spark, odd_table, empty_table, items):
    assert lexical.search(empty_table, items).count() == 0
    assert lexical.search(odd_table, items.limit(0)).count() == 0


def test_items_in_several_groups(spark, odd_table, table_docs, items, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS_EACH", 2)
    assert rows_of(lexical.search(odd_table, items)) == brute.search(table_docs, ITEMS)


def test_skipping_loses_no_document():
    """Many ranges, few of which can pass the threshold, and many equal scores."""
    own = np.random.default_rng(5)
    lists, n_docs = lexical.Lists.__new__(lexical.Lists), 20_000
    held = [np.sort(own.choice(n_docs, size, replace=False)) for size in (5, 40, 300, 4000, 9000, 15000)]
    lists.first = np.concatenate([[0], np.cumsum([len(x) for x in held])])
    lists.docs = np.concatenate(held)
    lists.scores = np.concatenate([own.integers(0, 4, len(x)) * 10 ** (5 - k) for k, x in enumerate(held)])
    lists.edges = np.arange(0, n_docs + lexical.RANGE, lexical.RANGE)
    lists.long = np.array([len(x) > 100 for x in held])
    lists.ranged = {}
    for asked in ([0, 1, 2, 3, 4, 5], [0], [1, 3], [5], [2, 4, 5], [0, 1]):
        sums = np.zeros(n_docs, np.int64)
        for k in asked:
            np.add.at(sums, held[k], lists.scores[lists.first[k] : lists.first[k + 1]])
        order = np.lexsort((np.arange(n_docs), -sums))[:10]
        order = order[sums[order] > 0]
        docs, scores = lists.best(np.array(asked), 10)
        assert docs.tolist() == order.tolist() and scores.tolist() == sums[order].tolist()


def test_numbers_survive_their_bytes():
    own = random.Random(1)
    values = np.array([own.randrange(2 ** own.randrange(1, 62)) for _ in range(999)])
    data, starts = lexical.varints(values)
    assert lexical.numbers(data.tobytes()).tolist() == values.tolist() and len(starts) == 1000
    assert lexical.numbers(b"").tolist() == []


def test_a_document_with_most_rows_is_split_over_blocks(spark, tmp_path):
    """A third of all rows are copies; no group holds more than a block of them."""
    rows = [(k, "hot term " * 20) for k in range(3000)] + [(k, f"cold w{k}") for k in range(6000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    index = lexical.index_documents(docs, block_bytes=20_000)
    assert index.filter("term = 'hot'").agg({"size": "max"}).first()[0] <= 300
    items = spark.createDataFrame([(1, "hot w5"), (2, "cold term")], "item_id bigint, text string")
    found = lexical.search(docs, items, block_bytes=20_000)
    assert rows_of(found) == brute.search(rows, [(1, "hot w5"), (2, "cold term")])
