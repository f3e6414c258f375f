"""Near copies by full sets, against all pairs."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from brute import rows_of
from conftest import prose

from ladderlake.llm import minhash

SCHEMA = "doc_id bigint, text string"


def stored(spark, rows, path, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


def changed(text, seed, n):
    own, words = random.Random(seed), text.split()
    for k in own.sample(range(len(words)), n):
        words[k] = f"x{seed}"
    return " ".join(words)


def test_odd_documents_equal_all_pairs(odd_table, table_docs):
    out = minhash.near_duplicates(odd_table)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert rows_of(out) == brute.similar(table_docs)


def test_empty_table(empty_table):
    assert minhash.near_duplicates(empty_table).count() == 0


@pytest.mark.parametrize("least", [4096, 3])
def test_chains_and_large_groups_equal_all_pairs(spark, tmp_path, monkeypatch, least):
    """Near copies of copies, half of the rows; then with blocks that hold three sets only."""
    monkeypatch.setattr(minhash, "BLOCK_SETS", least)
    base, rows = prose(11, 120), []
    for k in range(60):  # copies of one text, more than the limit apart from each other
        rows.append((1000 - k, changed(base, k, 1 + k % 4)))
    text = prose(12, 200)
    for k in range(12):  # each near the one before alone
        rows.append((k, text))
        text = changed(text, 100 + k, 2)
    rows += [(2000 + k, prose(200 + k, 90)) for k in range(40)]
    rows += [(3000 + k, rows[k][1].upper()) for k in range(8)] + [(None, base)]
    docs = stored(spark, rows, tmp_path / "d")
    expected = brute.similar(rows)
    assert rows_of(minhash.near_duplicates(docs)) == expected
    assert len({r[2] for r in expected}) < len(rows) - 30


def test_a_repeated_row_is_one_set(spark, tmp_path):
    base = prose(21, 80)
    rows = [(7, base)] * 400 + [(8, changed(base, 1, 1)), (3, prose(22, 80))] + [(4, None)] * 100
    docs = stored(spark, rows, tmp_path / "d")
    assert rows_of(minhash.near_duplicates(docs)) == sorted(
        [(7, 76, 7, True)] * 400 + [(8, 76, 7, False), (3, 76, 3, True)] + [(4, 0, 4, True)] * 100, key=repr
    )


def test_every_coordinate_is_filled_and_estimates_similarity():
    own = np.random.default_rng(3)
    values = own.integers(0, 2**63, 2000).astype(np.uint64)
    sets = [values[:1], values[:2], values[:50], values[:1000], values[100:1100], values[:0]]
    first = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    t = 512
    found = minhash.sketches(np.concatenate(sets), first, t)
    assert (found[:-1] != minhash._EMPTY).all() and (found[-1] == minhash._EMPTY).all()
    alone = minhash.sketches(sets[2], np.array([0, 50]), t)
    assert (alone[0] == found[2]).all()
    agreed = (found[3] == found[4]).mean()  # of 1100 elements 900 are shared
    assert abs(agreed - 900 / 1100) < 0.07


def test_sets_of_texts():
    texts = [None, "", "a b", "A  b", "b a", "a b c d e f a b c d e", "a b c d e f"]
    elements, first = minhash.shingle_sets(pa.chunked_array([pa.array(texts)]))
    assert np.diff(first).tolist() == [len(brute.shingle_set(t)) for t in texts]
    sets = [set(elements[a:b].tolist()) for a, b in zip(first[:-1], first[1:])]
    assert sets[2] == sets[3] != sets[4] and sets[6] < sets[5]


def test_group_of_most_rows_leaves_no_task_with_it(spark, tmp_path):
    """Exact copies and near copies of one text: linked through its hub, no group of them is dealt."""
    base = prose(31, 100)
    rows = [(k, base) for k in range(300)] + [(1000 + k, f"{base} y{k}") for k in range(300)]
    docs = stored(spark, rows, tmp_path / "d")
    out = minhash.near_duplicates(docs)
    assert out.filter("component_id = 0").count() == 600
    assert rows_of(out.select("kept").distinct()) == [(False,), (True,)]
