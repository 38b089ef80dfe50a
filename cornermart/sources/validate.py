"""The strict contract over raw JSON records: which columns, which value types."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

from ..contracts import CONTRACTS

SAMPLE = 5  # offenders quoted per column
EVERY_RECORD = "\0"  # not a key of any delivery


def kind(value: Column) -> Column:
    """Coarse JSON kind: text, boolean, number, array, object or other."""
    shape = F.schema_of_variant(value)
    return (
        F.when(shape == "STRING", "text")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape.rlike("^(BIGINT|INT|DECIMAL|DOUBLE|FLOAT)"), "number")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape.startswith("OBJECT"), "object")
        .otherwise("other")
    )


def _opened_type(dtype: DataType) -> str:
    """One level of a type with everything below it left as VARIANT."""
    if isinstance(dtype, StructType):
        return "struct<" + ",".join(f"`{f.name}`:variant" for f in dtype.fields) + ">"
    return "variant"


def _broken_members(opened: Column, dtype: StructType) -> Column:
    """NULL for anything but an object; members may be absent or null, undeclared ones are ignored."""
    checks = [mismatches(opened[f.name], f.dataType) for f in dtype.fields]
    return opened.isNull() | reduce(or_, checks)


def _broken_element(element: Column, dtype: DataType) -> Column:
    """Inside an array a null is not a value of the element type."""
    if isinstance(dtype, StructType):
        return _broken_members(element, dtype)
    return F.is_variant_null(element) | mismatches(element, dtype)


def mismatches(value: Column, dtype: DataType) -> Column:
    """TRUE when a VARIANT value does not have the declared type; absent and null values pass.

    Numbers must be exact in the declared decimal; booleans and text are never numbers; dates may
    be text; types not listed here pass.
    """
    shape = F.schema_of_variant(value)
    absent = value.isNull() | F.is_variant_null(value)
    if isinstance(dtype, StringType):
        return F.coalesce(~shape.isin("STRING", "VOID"), F.lit(False))
    if isinstance(dtype, LongType):
        return F.coalesce(~shape.isin("BIGINT", "VOID"), F.lit(False))
    if isinstance(dtype, (DateType, TimestampType)):
        return ~absent & ~shape.rlike("^(STRING|DATE|TIMESTAMP)")
    if isinstance(dtype, DecimalType):
        wide = F.try_variant_get(value, "$", "decimal(38,18)")
        stored = F.try_variant_get(value, "$", dtype.simpleString())
        inexact = F.coalesce(wide != stored, F.lit(True))
        return ~absent & (inexact | shape.isin("STRING", "BOOLEAN"))
    if isinstance(dtype, ArrayType):
        elements = F.try_variant_get(value, "$", f"array<{_opened_type(dtype.elementType)}>")
        broken = F.exists(elements, lambda e: _broken_element(e, dtype.elementType))
        return ~absent & F.coalesce(broken, F.lit(True))
    if isinstance(dtype, StructType):
        opened = F.try_variant_get(value, "$", _opened_type(dtype))
        return ~absent & _broken_members(opened, dtype)
    return F.lit(False)


def opened(raw: DataFrame, source_name: str) -> DataFrame:
    """Add ``_r``: the declared members of each record, each still a VARIANT; NULL if no object."""
    return raw.withColumn("_r", F.try_variant_get("v", "$", _opened_type(CONTRACTS[source_name])))


def member(name: str) -> Column:
    return F.col("_r")[name]


def value_checks(source_name: str) -> dict[str, Column]:
    """Per declared column of an opened record: does it break its type?"""
    return {f.name: mismatches(member(f.name), f.dataType) for f in CONTRACTS[source_name].fields}


def undeclared(source_name: str) -> Column:
    """Keys of a record that the contract does not know."""
    keys = F.map_keys(F.try_variant_get("v", "$", "map<string,variant>"))
    return F.array_except(keys, F.array(*[F.lit(n) for n in CONTRACTS[source_name].names]))


def column_report(raw: DataFrame, source_name: str) -> DataFrame:
    """Columns missing from every record and columns nobody declared: (issue, column_name, n_rows).

    One pass: each record gives its keys and, for the number of records, an empty key. After the
    count there is one row per distinct key.
    """
    names = F.array(*[F.lit(n) for n in CONTRACTS[source_name].names])
    keys = F.map_keys(F.try_variant_get("v", "$", "map<string,variant>"))
    every = F.array_append(F.coalesce(keys, F.array().cast("array<string>")), F.lit(EVERY_RECORD))
    counted = raw.select(F.explode(every).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    seen = counted.agg(
        F.collect_set("key").alias("keys"),
        F.max(F.when(F.col("key") == EVERY_RECORD, F.col("n"))).alias("n_rows"),
        F.collect_list(F.when(~F.array_contains(names, F.col("key")) & (F.col("key") != EVERY_RECORD), F.struct("key", "n"))).alias("extra"),
    )
    missing = F.transform(
        F.array_except(names, F.col("keys")),
        lambda n: F.struct(F.lit("missing").alias("issue"), n.alias("column_name"), F.col("n_rows").alias("n_rows")),
    )
    extra = F.transform(
        "extra",
        lambda e: F.struct(F.lit("unexpected").alias("issue"), e["key"].alias("column_name"), e["n"].alias("n_rows")),
    )
    return seen.filter("n_rows > 0").select(F.inline(F.concat(missing, extra)))


def violations(raw: DataFrame, source_name: str) -> DataFrame:
    """One row per offending value: (column_name, expected, found, value, _file)."""
    types = {f.name: f.dataType.simpleString() for f in CONTRACTS[source_name].fields}
    offenders = [
        F.when(
            broken,
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(types[name]).alias("expected"),
                kind(member(name)).alias("found"),
                F.substring(F.to_json(member(name)), 1, 80).alias("value"),
            ),
        )
        for name, broken in value_checks(source_name).items()
    ]
    found = F.filter(F.array(*offenders), lambda o: o.isNotNull())
    records = opened(raw, source_name)
    return records.select(F.explode(found).alias("o"), "_file").select("o.*", "_file")


def violation_counts(raw: DataFrame, source_name: str) -> DataFrame:
    return (
        violations(raw, source_name)
        .groupBy("column_name", "expected", "found")
        .agg(F.count("*").alias("violations"))
    )


def describe_offenders(raw: DataFrame, source_name: str, column: str) -> str:
    """Quote the first few offenders of a column for an error message."""
    rows = violations(raw, source_name).filter(F.col("column_name") == column).limit(SAMPLE).collect()
    detail = "; ".join(f"{r['_file']}: got {r['found']} -> {r['value']}" for r in rows)
    return f"column '{column}' expected {rows[0]['expected'] if rows else '?'}: {detail}"


def typed(raw: DataFrame, source_name: str) -> DataFrame:
    """Declared columns in declared types. Run the checks first: the getters themselves are lenient."""
    contract = CONTRACTS[source_name]
    record = raw.select(F.try_variant_get("v", "$", contract.simpleString()).alias("r"), "_file")
    return record.select("r.*", "_file")
