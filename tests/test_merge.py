"""Tables changed in part: what is read, what is replaced, and what a repetition changes."""

import os

import pytest
from pyspark.sql import functions as F

from ladderlake.sources import merge_latest, partition_digests, publish_changed, read_table
from ladderlake.sources import merge

SCHEMA = "tier string, k int, at int, v string"


def files(path):
    return {
        os.path.relpath(os.path.join(d, f), path)
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def rows(spark, path):
    return sorted(map(tuple, read_table(spark, path).select("tier", "k", "at", "v").collect()), key=repr)


def merged(spark, new, path, **more):
    df = spark.createDataFrame(new, SCHEMA)
    return merge_latest(df, path, ["tier", "k"], [F.col("at").desc(), F.col("v").desc()], **more)


def test_only_touched_buckets_are_read_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("G", k, 1, f"a{k}") for k in range(200)] + [(None, 1, 1, "n"), ("S", 1, 1, "s")]
    merged(spark, first, path, partition_by=["tier"], buckets=16)
    before = files(path)
    touched = merged(
        spark, [("G", 5, 2, "b5"), ("G", 500, 1, "new"), ("G", 6, 0, "late"), (None, 1, 3, "m")], path,
        partition_by=["tier"], buckets=16,
    )
    after = files(path)
    assert len(touched) <= 4
    kept = {f for f in before & after}
    assert len({os.path.dirname(f) for f in before - kept}) == len(touched)
    old = merge.stored_partitions(spark, path, ["tier", merge.bucket_column(16)], touched)
    read = {r[0] for r in old.select("_metadata.file_path").distinct().collect()}
    assert len(read) < len(after) / 2 and not {f for f in kept if any(x.endswith(f) for x in read)}
    expected = [("G", k, 1, f"a{k}") for k in range(200) if k != 5]
    expected += [("G", 5, 2, "b5"), ("G", 500, 1, "new"), (None, 1, 3, "m"), ("S", 1, 1, "s")]
    assert rows(spark, path) == sorted(expected, key=repr)


def test_a_repeated_merge_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merged(spark, [("G", k, 1, "a") for k in range(50)], path, buckets=4)
    new = [("G", 3, 2, "b"), ("G", 3, 2, "c"), ("G", 60, 1, "d")]
    real = merge.write_table

    def fail(*args, **more):
        real(*args, **more)
        raise RuntimeError("lost")

    monkeypatch.setattr(merge, "write_table", fail)
    with pytest.raises(RuntimeError):
        merged(spark, new, path, buckets=4)
    monkeypatch.setattr(merge, "write_table", real)
    once = rows(spark, path)
    merged(spark, new, path, buckets=4)
    assert rows(spark, path) == once and ("G", 3, 2, "c") in once and len(once) == 51
    assert merged(spark, [], path, buckets=4) == []
    with pytest.raises(ValueError):
        merged(spark, new, path, buckets=8)


def test_digests_see_every_change_but_the_order(spark):
    base = [("a", 1, None, (1, None)), ("a", 1, None, (1, None)), ("b", None, "x", (None, 2))]
    schema = "p string, k int, v string, s struct<x: int, y: int>"

    def digest(rows):
        df = spark.createDataFrame(rows, schema).repartition(3)
        return {r.p: (r.row_count, r.digest) for r in partition_digests(df, ["p"]).collect()}

    same = digest(base)
    assert digest(base[::-1]) == same
    for other in (
        [*base[:2], ("b", None, "x", (2, None))],
        [*base[:2], ("b", None, None, (None, 2))],
        [*base[:2], ("b", 1, "x", (None, 2))],
        [*base, base[2]],
    ):
        found = digest(other)
        assert found["a"] == same["a"] and found["b"] != same["b"]
    assert digest(base[1:])["a"] != same["a"]


def test_unchanged_partitions_keep_their_files(spark, tmp_path):
    target = str(tmp_path / "t")
    schema = "p string, v int"
    first = [("a", 1), ("a b", 2), ("c", 3), (None, 4)]

    def publish(rows, schema=schema):
        actions = publish_changed(spark, spark.createDataFrame(rows, schema), target, ["p"])
        return {r.p: r.action for r in actions.collect()}

    assert publish(first) == dict.fromkeys(["a", "a b", "c", None], "written")
    before = files(target)
    assert publish(first[::-1]) == dict.fromkeys(["a", "a b", "c", None], "kept")
    assert files(target) == before
    second = [("a", 1), ("a b", 5), ("a b", 2), (None, 4), ("d", 1)]
    assert publish(second) == {"a": "kept", "a b": "written", "c": "deleted", None: "kept", "d": "written"}
    assert {f for f in before if f.startswith("p=a/") or f.startswith("p=__HIVE")} <= files(target)
    found = sorted(map(tuple, read_table(spark, target).select("p", "v").collect()), key=repr)
    assert found == sorted(second, key=repr)
    wider = [(*r, "w") for r in second]
    assert set(publish(wider, "p string, v int, w string").values()) == {"written"}


def test_a_failed_publication_is_made_up_for(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int")
    publish_changed(spark, df, target, ["p"])
    changed = spark.createDataFrame([("a", 1), ("b", 3)], "p string, v int")
    real = merge.write_table

    def fail(*args, **more):
        raise RuntimeError("lost")

    monkeypatch.setattr(merge, "write_table", fail)
    with pytest.raises(RuntimeError):
        publish_changed(spark, changed, target, ["p"])
    monkeypatch.setattr(merge, "write_table", real)
    # Back to the first rows: what is stored is right again, yet it is not taken for granted.
    actions = {r.p: r.action for r in publish_changed(spark, df, target, ["p"]).collect()}
    assert actions == {"a": "kept", "b": "written"}
    assert sorted(r.v for r in read_table(spark, target).collect()) == [1, 2]
