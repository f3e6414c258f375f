"""Spelling variants against the words that each word less a letter gives."""

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from brute import rows_of

from ladderlake.llm import variants

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def made_words(seed, n):
    """Words of few parts, which share most of their grams, and words near them."""
    own = random.Random(seed)
    parts = ["tion", "ere", "an", "st", "in", "the", "\u00e9\u00df", "o", "qu", "ing"]
    words = set()
    while len(words) < n:
        word = "".join(own.choice(parts) for _ in range(own.randrange(2, 6)))
        k = own.randrange(len(word))
        words |= {word, word[:k] + word[k + 1 :], word[:k] + own.choice("xyz\u00ff") + word[k:], word[:k] + "a" + word[k + 1 :]}
    return {w: own.choice([5, 6, 24, 25, 26, 130, 700, 4000]) for w in sorted(words) if len(w) >= 6}


def stored(spark, rows, path, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.mark.parametrize("limits", [(1 << 16, 1 << 18, 1 << 14), (40, 300, 64)])
def test_variants_equal_all_deletions(spark, tmp_path, monkeypatch, limits):
    """Also with lists cut into blocks, several tasks, and a dictionary of many grams."""
    for name, value in zip(("LIST_ROWS", "TASK_ROWS", "DICTIONARY"), limits):
        monkeypatch.setattr(variants, name, value)
    monkeypatch.setattr(variants, "PAIRS_EACH", 1000)
    words = made_words(4, 3000)
    df = stored(spark, list(words.items()), tmp_path / "w", "word string, n bigint")
    out = variants.spelling_variants(df)
    assert out.columns == COLUMNS
    assert rows_of(out) == brute.variants(words)


def test_odd_documents(spark, odd_table, table_docs, empty_table):
    """Also long words, chains of forms, ties and words that grow out of altered runs."""
    out = variants.group_variants(odd_table, noise=3, min_count=1)
    assert rows_of(out) == brute.variants(brute.variant_words(table_docs, 3, 1))
    assert variants.group_variants(empty_table).count() == 0
    assert variants.group_variants(odd_table, min_count=10**6).count() == 0


def test_long_words_and_chains(spark, tmp_path):
    long = "ab" * 400
    words = {long: 5, long + "c": 100, long[:300] + "x" + long[301:]: 30, long[1:]: 600}
    words |= {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "aaaaa\u00ff": 25}
    df = stored(spark, list(words.items()), tmp_path / "w", "word string, n bigint")
    expected = brute.variants(words)
    assert rows_of(variants.spelling_variants(df)) == expected
    assert ("aaaaaa", "aaaaab", "aabbbb", 5, 2, 25) in expected


def test_bounds_cover_what_an_edit_changes():
    """Every gram beyond the bound is found in the edited word, at its place or one before."""
    words = list(made_words(9, 800))
    counts = brute.Counter()
    for w in words:
        marked = f"^{w}$"
        counts.update(marked[p : p + q] for q in (2, 3, 4) for p in range(len(marked) - q + 1))
    frequent = {g: n for g, n in counts.items() if n > 60}
    ends = variants.ends_of(frequent)
    for w in words[:300]:
        marked = f"^{w}$"
        grams = variants.decompose(marked, frequent)
        bound = variants.affected(marked, grams, ends)
        assert bound < len(grams)
        held = {(marked[p:e], p) for p, e in grams}
        for i in range(1, len(marked) - 1):
            for c in ["", *"aetno\u00e9"]:
                other = marked[:i] + c + marked[i + 1 :]
                now = {(other[p:e], p) for p, e in variants.decompose(other, frequent)}
                now |= set() if c else {(g, p + 1) for g, p in now}
                assert len(held - now) <= bound, (w, i, c)


def test_joined_crc():
    own = random.Random(2)
    left = [bytes(own.randrange(256) for _ in range(own.randrange(9))) for _ in range(50)]
    right = [bytes(own.randrange(256) for _ in range(own.randrange(40))) for _ in range(50)]
    crc = lambda rows: np.array([zlib.crc32(x) for x in rows], np.uint32)
    size = np.array([len(x) for x in right])
    assert variants.joined_crc(crc(left), crc(right), size).tolist() == [zlib.crc32(a + b) for a, b in zip(left, right)]


def test_runs_of_letters():
    texts = ["Ab\u00c0\u00ff\u0100x", None, "", "abcdefg", "hij", "\u00d7\u00f7 A-B"]
    found = variants.letter_runs(pa.chunked_array([pa.array(texts)]))
    assert [w.decode() for w in found.array().to_pylist()] == [
        "ab\u00c0\u00ff", "x", "abcdefg", "hij", "\u00d7\u00f7", "a", "b"
    ]
    assert np.diff(found.first).tolist() == [2, 0, 0, 1, 1, 3]


def test_given_documents(spark, small_docs, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    out = variants.group_variants(docs, noise=199)
    assert rows_of(out.select(COLUMNS)) == brute.variants(brute.variant_words(small_docs))
