import os
import random

import pytest
from brute import CLASHING

from ladderlake.llm.queries import reachable


@pytest.fixture(scope="session")
def small_dir():
    return os.environ.get("TEST_SMALL_DIR", "/root/testdata/sf0.001")


@pytest.fixture(autouse=True)
def workers(spark):
    reachable(spark)


def prose(seed, n, vocabulary=3000):
    own = random.Random(seed)
    return " ".join(f"w{own.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls, empty and long texts, ties, repeated rows, copies and shared passages."""
    passage, other = prose(1, 60), prose(2, 80)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t \x0b"),
        (4, "a"),
        (5, passage),
        (5, passage),
        (5, f"{other}\n{passage}"),
        (None, passage),
        (None, other),
        (7, prose(3, 40_000, 200_000)),
        (8, f"{prose(3, 40_000, 200_000)} {passage}"),
        (9, "Ünïcödé wörds — 日本語 \u3000 ß\u00a0x <|endoftext|> </s>[INST] \\ |> \x00 \x1f"),
        (10, "same line here\n" * 50),
        (11, f"  {passage}\r\n\r\nEnd. "),
        (12, passage.upper()),
        (13, "é" * 400),
        (14, "é" * 300 + "x" * 120),
        (15, "ab" * 90),
        (16, "a b # $ % & | < > * " * 8),
        (-3, other + " tail"),
    ]


@pytest.fixture(scope="session")
def odd_table(spark, odd_docs, tmp_path_factory):
    """The odd documents, stored, with columns of clashing names."""
    rows = [(*r, "en" if k % 3 else None, *[f"{c}{k}" for c in CLASHING]) for k, r in enumerate(odd_docs)]
    schema = "doc_id bigint, text string, lang string, " + ", ".join(f"{c} string" for c in CLASHING)
    path = str(tmp_path_factory.mktemp("odd") / "documents")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def table_docs(odd_table):
    """(doc_id, text) in the order of the stored rows."""
    return [tuple(r) for r in odd_table.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty_table(odd_table, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents")
    odd_table.limit(0).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def small_docs(spark, small_dir):
    return [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
