"""Tables replaced at once: what readers see while and after a publication."""

import os

import pytest

from ladderlake.sources import publish_values, publish_version, read_published
from ladderlake.sources import versions


def frame(spark, rows, schema="k string, v int"):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_readers_see_all_of_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    publish_version(frame(spark, [("a", 1), ("b", 2)]), path, ["k"])
    old = read_published(spark, path)
    publish_version(frame(spark, [("c", 3)]), path, ["k"])
    assert rows(old.select("k", "v")) == [("a", 1), ("b", 2)]  # still there for its readers
    assert rows(read_published(spark, path).select("k", "v")) == [("c", 3)]
    # Out of itself, with another layout and other columns.
    more = read_published(spark, path).selectExpr("k", "v + 1 as v", "'x' as w")
    publish_version(more, path)
    assert rows(read_published(spark, path)) == [("c", 4, "x")]
    assert len([n for n in os.listdir(path) if not n.startswith((".", "_"))]) == 2


def test_a_failed_publication_shows_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish_version(frame(spark, [("a", 1)]), path)
    real = versions.write_table

    def fail(*args, **more):
        real(*args, **more)
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "write_table", fail)
    with pytest.raises(RuntimeError):
        publish_version(frame(spark, [("b", 2)]), path)
    monkeypatch.setattr(versions, "write_table", real)
    assert rows(read_published(spark, path)) == [("a", 1)]
    publish_version(frame(spark, [("c", 3)]), path, keep=1)
    assert rows(read_published(spark, path)) == [("c", 3)]
    assert len([n for n in os.listdir(path) if not n.startswith((".", "_"))]) == 1


def test_some_values_are_replaced_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_values(frame(spark, [("a", 1), ("b", 2), (None, 3)]), path, "k", ["a", "b"])
    publish_values(frame(spark, [("a", 9)]), path, "k", ["a", "b"])
    assert rows(read_published(spark, path).select("k", "v")) == sorted([("a", 9), (None, 3)], key=repr)


def test_ten_versions_keep_their_order(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(11):
        publish_version(frame(spark, [("a", k)]), path, rebalance=False)
    assert rows(read_published(spark, path)) == [("a", 10)]
