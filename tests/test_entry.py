import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract
from ladderlake.oracle import SQL
from ladderlake.queries import REGISTRY


def test_flagship_has_rows_and_a_stable_schema(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.dtypes == [
        ("tier", "string"),
        ("division", "string"),
        ("player_id", "bigint"),
        ("points", "double"),
        ("win_percentage", "double"),
        ("rn", "bigint"),
    ]


def test_every_query_is_registered():
    assert set(REGISTRY) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize(
    "absent", [("ladderlake.llm", "corpus_pipeline"), ("public_tokenizers",), ("xxhash",)]
)
def test_the_rest_works_without_the_training_data_package(absent):
    """The entry point of a copy that lacks the package, its pipeline or one of its libraries."""
    code = f"""
import builtins
real = builtins.__import__
def without(name, *args, **more):
    if name.startswith({absent!r}):
        raise ModuleNotFoundError(name, name=name)
    return real(name, *args, **more)
builtins.__import__ = without
import __spark_entry__ as contract
assert set(contract.queries()) == set(contract.oracle_sql()) and contract.llm is None
"""
    root = os.path.dirname(contract.__file__)
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
