"""Fields inside variant records, and unions of columns with several types."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.operators import drift_across, field_types, record_drift, record_schemas, union_widened
from ladderlake.operators.drift import common_type, widest

ROWS = [
    ("G", "2024-01-02", '{"a": 1, "b": "x", "m": {"w": 1, "l": null}, "z": []}'),
    ("G", "2024-01-01", '{"a": 1.5, "b": 2, "m": {"w": 2.5, "deep": {"x": 1}}}'),
    ("S", "2024-01-03", '{"a": null, "m": 5, "n": {}, "z": [1, "a"], "d.e": true}'),
    ("S", "2024-01-03", "[1, 2]"),
    ("S", "2024-01-03", "7"),
    (None, None, None),
]


@pytest.fixture(scope="module")
def records(spark):
    df = spark.createDataFrame(ROWS, "tier string, day string, j string")
    return df.withColumn("record", F.parse_json("j")).drop("j")


def test_types_of_fields_in_each_group(records):
    found = {(r.tier, r.field): r for r in record_drift(records, ["tier"], day="day").collect()}
    shown = lambda *key: (found[key].types, found[key].widened, found[key].clashes)
    assert shown("G", "a") == ("BIGINT:1|DECIMAL:1", "DECIMAL", False)
    assert shown("G", "b") == ("BIGINT:1|STRING:1", "VARIANT", True)
    assert shown("G", "m") == ("OBJECT:2", "OBJECT", False)
    assert shown("G", "m.l") == ("VOID:1", "VOID", False) and found["G", "m.l"].null_count == 1
    assert shown("G", "m.w") == ("BIGINT:1|DECIMAL:1", "DECIMAL", False)
    assert shown("G", "m.deep") == ("OBJECT:1", "OBJECT", False)
    assert shown("S", "z") == ("ARRAY<VARIANT>:1", "ARRAY<VARIANT>", True)
    assert shown("S", "n") == ("OBJECT:1", "OBJECT", False)
    assert (found["G", "a"].first_day, found["G", "a"].last_day) == ("2024-01-01", "2024-01-02")
    assert {t for t, _ in found} == {"G", "S"} and ("S", None) not in found


def test_depth_and_declared_fields(records):
    flat = {r.field for r in field_types(records, ["tier"], depth=1).collect()}
    assert flat == {"a", "b", "m", "n", "z", "d.e"}
    deep = {r.field for r in field_types(records, ["tier"], depth=3, declared=["a", "z"]).collect()}
    assert deep == {"b", "m", "m.w", "m.l", "m.deep", "m.deep.x", "n", "d.e"}


def test_fields_over_all_groups(records):
    found = {r.field: r for r in drift_across(record_drift(records, ["tier"]), "tier", 2).collect()}
    assert (found["a"].groups, found["a"].widened, found["a"].drifts) == ("G,S", "DECIMAL", False)
    assert (found["m"].widened, found["m"].drifts) == ("VARIANT", True)
    assert found["n"].groups == "S" and found["n"].drifts


def test_merged_schemas(records):
    found = {r.tier: r.record_schema for r in record_schemas(records, ["tier"]).collect()}
    assert "b: VARIANT" in found["G"] and found["S"] == "VARIANT"


def test_no_records_no_fields(records):
    assert record_drift(records.limit(0), ["tier"], day="day").count() == 0


@pytest.mark.parametrize(
    "types, held",
    [
        ([], "VOID"), (["VOID"], "VOID"), (["BIGINT", "VOID"], "BIGINT"), (["BIGINT", "DOUBLE"], "DOUBLE"),
        (["BIGINT", "STRING"], "VARIANT"), (["ARRAY<VOID>", "ARRAY<BIGINT>"], "ARRAY<BIGINT>"),
        (["ARRAY<DOUBLE>", "ARRAY<BIGINT>"], "ARRAY<DOUBLE>"), (["ARRAY<STRING>", "BIGINT"], "VARIANT"),
        (["BOOLEAN", "BIGINT"], "VARIANT"),
    ],
)
def test_lattice_of_variant_types(spark, types, held):
    df = spark.createDataFrame([(types,)], "t array<string>")
    assert df.select(widest(F.col("t"))).first()[0] == held


def test_one_scan_and_no_sort_of_the_records(records, spark, tmp_path):
    records.write.parquet(str(tmp_path / "r"))
    plan = record_drift(spark.read.parquet(str(tmp_path / "r")), ["tier"], day="day")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("variant_explode") == 2
    before = text[text.rindex("Exchange hashpartitioning") :]
    assert "HashAggregate" in before and "SortAggregate" not in before and "Sort [" not in before


def test_common_types():
    long, double, text = T.LongType(), T.DoubleType(), T.StringType()
    assert common_type(T.IntegerType(), long) == long and common_type(long, double) == double
    assert common_type(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4)
    assert common_type(T.DecimalType(38, 0), T.DecimalType(38, 30)) == double
    assert common_type(long, T.DecimalType(5, 2)) == T.DecimalType(22, 2)
    assert common_type(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert common_type(T.BooleanType(), long) == text
    left = T.StructType.fromDDL("a int, b struct<x: int>")
    right = T.StructType.fromDDL("b struct<x: double, y: string>, c string")
    assert common_type(left, right) == T.StructType.fromDDL("a int, b struct<x: double, y: string>, c string")


def test_widened_unions_keep_every_value(spark):
    a = spark.createDataFrame([(1, (2,), [1], "2024-01-01")], "k int, s struct<x: int>, l array<int>, d string")
    b = spark.createDataFrame([("z", (2.5, "y"), [None, 0.5], True)], "k string, s struct<x: double, y: string>, l array<double>, d boolean")
    c = spark.createDataFrame([((1, 2),)], "k struct<p: int, q: int>")
    out = union_widened([a, b, c])
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "struct<x:double,y:string>", "array<double>", "string"]
    rows = sorted(out.collect(), key=repr)
    assert {r.k for r in rows} == {"1", "z", '{"p":1,"q":2}'}
    assert {r.d for r in rows} == {"2024-01-01", "true", None}
    assert {tuple(r.s) if r.s else None for r in rows} == {(2.0, None), (2.5, "y"), None}
