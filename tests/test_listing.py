"""Names listed by tasks against names listed by the driver."""

import os

import pytest

from ladderlake.plans import landing_status
from ladderlake.sources import landed_files, list_by_tasks
from ladderlake.sources import listing


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    for folder, pages in (("gold_I", 700), ("platina_I", 3), ("silver I", 5), ("a/b/c", 4), ("_hidden", 2), ("a/.x", 1)):
        os.makedirs(f"{root}/{folder}")
        for page in range(pages):
            with open(f"{root}/{folder}/{page}.json", "w") as f:
                f.write("x" * page)
    for name in ("top.json", ".dot.json", "_SUCCESS.json", "other.txt"):
        open(f"{root}/{name}", "w").close()
    os.makedirs(f"{root}/empty")
    return root


def found(df):
    return sorted((r.path, r.length, r.modificationTime) for r in df.collect())


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_tasks_list_what_the_driver_lists(spark, raw, levels, monkeypatch):
    monkeypatch.setattr(listing, "BATCH", 100)
    assert found(list_by_tasks(spark, raw, levels=levels)) == found(landed_files(spark, raw))


def test_the_driver_lists_folders_only(raw):
    reader = listing.ListingReader({"path": f"file:{raw}", "glob": "*.json"})
    parts = reader.partitions()
    assert sorted((os.path.basename(p.path), p.deep) for p in parts if p.deep) == [
        ("a", True), ("empty", True), ("gold_I", True), ("platina_I", True), ("silver I", True)
    ]
    assert sum(not p.deep for p in parts) == 1
    names = [x for p in parts for b in reader.read(p) for x in b.column(0).to_pylist()]
    assert len(names) == len(set(names)) == 699 + 2 + 4 + 3  # those with a byte


def test_status_and_errors(spark, raw):
    columns = ["folder", "first_page", "last_page", "file_count", "next_page", "absent_pages"]
    by_tasks, by_driver = (
        sorted(map(tuple, landing_status(spark, raw, levels=n).select(columns).collect()), key=repr) for n in (1, None)
    )
    assert by_tasks == by_driver
    with pytest.raises(Exception, match="nowhere"):
        list_by_tasks(spark, f"{raw}/nowhere").count()
    os.makedirs(f"{raw}/nothing/here", exist_ok=True)
    assert list_by_tasks(spark, f"{raw}/nothing").count() == 0


def test_sessions_side_by_side_list(spark, raw):
    for session in (spark, spark.newSession(), spark, spark.newSession()):
        assert list_by_tasks(session, raw).count() == 708
