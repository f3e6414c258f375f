"""Drift of what was landed: types of fields inside variant records, and unions that widen types."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# From narrow to wide; the last is what JSON numbers of any kind fit in.
_NUMBERS = ("BIGINT", "DECIMAL", "FLOAT", "DOUBLE")


def record_schemas(df: DataFrame, keys: Sequence[str], record: str = "record") -> DataFrame:
    """One merged schema for each group, as text; fields of clashing types are ``VARIANT``."""
    merged = F.schema_of_variant_agg(F.col(record)).alias("record_schema")
    return df.groupBy(*keys).agg(merged, F.count(F.lit(1)).alias("row_count"))


def record_fields_found(
    df: DataFrame,
    keys: Sequence[str],
    record: str = "record",
    depth: int = 2,
    keep: Sequence[str] = (),
    declared: Sequence[str] = (),
) -> DataFrame:
    """A row for each field of each variant record: keys, ``keep``, ``field`` and its ``value``.

    Fields of objects are listed below their object, as ``outer.inner``, to the given depth;
    those named ``declared`` are left out. Records that are no objects have no fields.
    Each level is a lateral generator over the row at hand, so the table is read once and
    nothing is shuffled.
    """
    own = [*keys, *keep]
    fields = df.sparkSession.tvf.variant_explode
    is_object = F.schema_of_variant(record).startswith("OBJECT")
    rows = df.select(*own, F.when(is_object, F.col(record)).alias("_open"))
    rows = rows.lateralJoin(fields(F.col("_open").outer())).filter(~F.col("key").isin(*declared) if declared else F.lit(True))
    rows = rows.select(*own, F.col("key").alias("field"), "value", F.lit(True).alias("_new"))
    for _ in range(depth - 1):
        is_object = F.col("_new") & F.schema_of_variant("value").startswith("OBJECT")
        rows = rows.withColumn("_open", F.when(is_object, F.col("value")))
        inner = df.sparkSession.tvf.variant_explode_outer(F.col("_open").outer())
        deeper = rows.withColumnsRenamed({"field": "_field", "value": "_value"}).lateralJoin(inner)
        entry = lambda name, value, new: F.struct(
            name.alias("field"), value.alias("value"), F.lit(new).alias("_new")
        )
        # The object itself is listed with the first of its fields.
        outer = F.when(F.coalesce("pos", F.lit(0)) == 0, entry(F.col("_field"), F.col("_value"), False))
        below = entry(F.concat_ws(".", "_field", "key"), F.col("value"), True)
        found = F.array_compact(F.array(outer, F.when(F.col("pos").isNotNull(), below)))
        rows = deeper.select(*own, F.inline(found))
    return rows.drop("_new")


def field_types(
    df: DataFrame,
    keys: Sequence[str],
    record: str = "record",
    day: str | None = None,
    depth: int = 2,
    declared: Sequence[str] = (),
) -> DataFrame:
    """Rows of each type of each field of the variant records, and the first and last day of it.

    A number without a fraction is a ``BIGINT`` however it is stored: a file may keep whole
    numbers as decimals where others of its column have fractions.
    """
    keep = [day] if day else []
    found = record_fields_found(df, keys, record, depth, keep, declared)
    # Digits and inner fields are no types of their own; inner fields are listed below.
    kind = F.regexp_replace(F.schema_of_variant("value"), r"OBJECT<.*>(?=>*$)", "OBJECT")
    kind = F.regexp_replace(kind, r"\(.*?\)", "")
    exact = F.try_variant_get("value", F.lit("$"), "decimal(38,18)")
    kind = F.when((kind == "DECIMAL") & (exact % 1 == 0), "BIGINT").otherwise(kind)
    by = [*keys, "field", "data_type"]
    # The days are few: as a key they keep the first, large count in a hash table.
    counted = found.withColumn("data_type", kind).groupBy(*by, *keep).agg(F.count(F.lit(1)).alias("row_count"))
    days = [F.min(day).alias("first_day"), F.max(day).alias("last_day")] if day else []
    return counted.groupBy(*by).agg(F.sum("row_count").alias("row_count"), *days) if day else counted


def _widest(types: Column) -> Column:
    some = F.array_remove(types, "VOID")
    number = F.forall(some, lambda t: t.isin(*_NUMBERS))
    widened = F.element_at(F.filter(F.array(*map(F.lit, _NUMBERS)), lambda t: F.array_contains(some, t)), -1)
    return (
        F.when(F.size(some) == 0, "VOID")
        .when(F.size(some) == 1, F.element_at(some, 1))
        .when(number, widened)
        .otherwise("VARIANT")
    )


def widest(types: Column) -> Column:
    """The type that holds all of an array of distinct type names; ``VARIANT`` where they clash.

    Arrays widen by their elements, and empty ones fit any array.
    """
    some = F.array_remove(types, "VOID")
    lists = (F.size(some) > 1) & F.forall(some, lambda t: t.startswith("ARRAY<"))
    inner = F.transform(some, lambda t: F.regexp_replace(t, "^ARRAY<(.*)>$", "$1"))
    return F.when(lists, F.concat(F.lit("ARRAY<"), _widest(inner), F.lit(">"))).otherwise(_widest(types))


def record_drift(
    df: DataFrame,
    keys: Sequence[str],
    record: str = "record",
    day: str | None = None,
    depth: int = 2,
    declared: Sequence[str] = (),
) -> DataFrame:
    """For each group and field of its variant records: the types with their rows, and whether they clash.

    Numbers widen (BIGINT, DECIMAL, DOUBLE); nulls fit everywhere; other types of one field
    clash. One pass over the records with partial counts; what follows has a row for each
    field and type.
    """
    types = field_types(df, keys, record, day, depth, declared)
    names = F.array_sort(F.collect_set("data_type"))
    listed = F.array_sort(F.collect_list(F.concat_ws(":", "data_type", F.col("row_count").cast("string"))))
    days = [F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")] if day else []
    nulls = F.coalesce(F.sum(F.when(F.col("data_type") == "VOID", F.col("row_count"))), F.lit(0))
    out = types.groupBy(*keys, "field").agg(
        names.alias("_names"),
        F.array_join(listed, "|").alias("types"),
        F.sum("row_count").alias("row_count"),
        nulls.cast("bigint").alias("null_count"),
        *days,
    )
    out = out.withColumn("widened", widest(F.col("_names")))
    return out.withColumn("clashes", F.col("widened").contains("VARIANT")).drop("_names")


def drift_across(drift: DataFrame, key: str, expected: int | None = None) -> DataFrame:
    """For each field: the groups that have it and the type that holds it in all of them.

    ``expected`` is the number of groups; a field that fewer have, or that clashes, drifts.
    """
    some = F.array_sort(F.collect_set("widened"))
    out = drift.groupBy("field").agg(
        F.array_join(F.array_sort(F.collect_set(key)), ",").alias("groups"),
        F.count_distinct(key).alias("group_count"),
        some.alias("_names"),
        F.sum("row_count").alias("row_count"),
    )
    out = out.withColumn("widened", widest(F.col("_names")))
    drifts = F.col("widened").contains("VARIANT")
    if expected is not None:
        drifts = drifts | (F.col("group_count") < expected)
    return out.withColumn("drifts", drifts).drop("_names")


_ORDER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The narrowest type that holds both: numbers widen, structs join their fields, else text."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    if isinstance(left, _ORDER) and isinstance(right, _ORDER):
        if not isinstance(left, T.DecimalType) and not isinstance(right, T.DecimalType):
            return max(left, right, key=lambda t: _ORDER.index(type(t)))
        if isinstance(left, (T.FloatType, T.DoubleType)) or isinstance(right, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        parts = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (left, right)]
        whole, scale = max(p[0] for p in parts), max(p[1] for p in parts)
        return T.DecimalType(min(38, whole + scale), min(scale, 38 - min(38, whole))) if whole + scale <= 38 else T.DoubleType()
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        names = list(dict.fromkeys([*left.names, *right.names]))
        kinds = [[s[n].dataType for s in (left, right) if n in s.names] for n in names]
        return T.StructType([T.StructField(n, reduce(common_type, k)) for n, k in zip(names, kinds)])
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        return T.ArrayType(common_type(left.elementType, right.elementType))
    days = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(left, days) and isinstance(right, days):
        return max(left, right, key=lambda t: days.index(type(t)))
    return T.StringType()


_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def _to(column: Column, own: T.DataType, target: T.DataType) -> Column:
    if own == target:
        return column
    if isinstance(own, T.StructType) and isinstance(target, T.StructType):
        parts = [
            _to(column[f.name], own[f.name].dataType, f.dataType).alias(f.name)
            if f.name in own.names
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(own, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(column, lambda x: _to(x, own.elementType, target.elementType))
    if isinstance(own, _NESTED):
        return F.to_json(column)
    return column.cast(target)


def union_widened(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows by column name, absent columns null; a column of several types gets one for all.

    Numbers widen, structs and arrays are joined field by field, and types that clash become
    text (nested ones as JSON), so no value is lost and no cast can fail. The types come from
    the schemas alone.
    """
    kinds: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds[f.name] = common_type(kinds[f.name], f.dataType) if f.name in kinds else f.dataType

    def aligned(df: DataFrame) -> DataFrame:
        own = {f.name: f.dataType for f in df.schema.fields}
        return df.select(
            *[
                (_to(F.col(f"`{n}`"), own[n], t) if n in own else F.lit(None).cast(t)).alias(n)
                for n, t in kinds.items()
            ]
        )

    return reduce(DataFrame.unionByName, [aligned(df) for df in frames])
