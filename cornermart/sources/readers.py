"""Raw readers: records as delivered, no typing decisions.

CSV gives text columns, JSON gives one VARIANT per record; both carry ``_file``. The reader of a
format is found in ``READERS``.
"""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from ..contracts import CONTRACTS, ContractError, SourceSpec
from .records import CsvLines, JsonArray, records

ODD, WIDE = "_odd", "_wide"  # a record that doesn't have the header's width; whether it is wider

# Cell texts that mean "no value" in the delivered CSV exports.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _file() -> Column:
    return F.col("_metadata.file_path").alias("_file")


def headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files by their header line, read by a job: only one row per distinct header comes back
    with its files. Empty files have no line and are left out."""
    lines = spark.read.text(paths).select(
        _file(), "value", F.monotonically_increasing_id().alias("_at"), F.col("_metadata.file_block_start").alias("_block")
    )
    first = lines.filter("_block = 0").groupBy("_file").agg(F.min_by("value", "_at").alias("header"))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("_file")).alias("files")).collect()
    return {tuple(next(csv.reader([r["header"].lstrip("\ufeff")]), ())): r["files"] for r in found}


def check_columns(name: str, found: set[str]) -> None:
    """The delivered columns must be the declared ones; the error names both kinds of difference."""
    declared = set(CONTRACTS[name].names)
    absent, foreign = sorted(declared - found), sorted(found - declared)
    if absent or foreign:
        raise ContractError(f"{name}: columns do not agree with the contract: not delivered {absent}, not declared {foreign}")


def read_csv(spark: SparkSession, spec: SourceSpec, paths: list[str]) -> DataFrame:
    """All-text columns in contract order; cells meaning "no value" become NULL.

    Quoted cells may hold line breaks; a file is nevertheless read by as many tasks as it has ranges.
    Files that share a header are one scan. ``_odd`` holds the record where it is narrower or wider
    than its header; a narrow one is filled up with NULLs.
    """
    by_header = headers(spark, paths)
    if not by_header:
        raise ContractError(f"{spec.name}: no header in the delivery: {paths}")
    names = CONTRACTS[spec.name].names

    def scan(header: tuple[str, ...], parts: list[str]) -> DataFrame:
        check_columns(spec.name, set(header))
        if len(set(header)) < len(header):
            raise ContractError(f"{spec.name}: a column appears twice in the header {header}")
        schema = ", ".join(f"`{n}` string" for n in (*header, ODD))
        lines = records(spark, parts, CsvLines()).filter("not first")  # the first record is the header
        lines = lines.withColumn("text", F.regexp_replace("text", "\r?\n?$", "")).filter("text <> ''")
        cells = F.from_csv("text", schema, {"escape": '"', "columnNameOfCorruptRecord": ODD})
        raw = lines.select(cells.alias("c"), "_file").select("c.*", "_file")
        cells = [F.when(~F.col(n).isin(*NA_TOKENS), F.col(n)).alias(n) for n in names]
        wider = F.size(F.split(F.regexp_replace(ODD, '"[^"]*"', ""), ",", -1)) > len(header)
        return raw.select(*cells, ODD, F.coalesce(wider, F.lit(False)).alias(WIDE), "_file")

    scans = [scan(header, parts) for header, parts in sorted(by_header.items())]
    return reduce(DataFrame.unionByName, scans)


def array_elements(cuts: DataFrame) -> DataFrame:
    """One VARIANT ``v`` per element of arrays that are cut behind their objects.

    The first cut begins with the array's bracket and every other one with the comma before it; the
    last ends with the bracket. Elements that are no objects come in the cut of the object behind
    them, or in the last.
    """
    opening = F.when(F.col("first"), r"^\ufeff?\s*\[").otherwise(r"^\s*,")
    closing = F.when(F.col("last"), r"\]\s*$").otherwise("$")
    nothing = r"^\s*\]\s*$"  # behind the last object
    bare = F.col("last") & ~F.col("first") & F.col("text").rlike(nothing)
    inner = F.regexp_replace(F.regexp_replace("text", opening, F.lit("")), closing, F.lit(""))
    whole = F.regexp_like("text", opening) & F.regexp_like("text", closing)
    filled = F.col("first") & F.col("last") | ~inner.rlike(r"^\s*$")  # a comma needs an element
    checked = F.when(whole & filled, F.concat(F.lit("["), inner, F.lit("]")))
    broken = F.raise_error(F.concat(F.lit("malformed JSON array in "), "_file", F.lit(": "), F.substring("text", 1, 80)))
    element = F.variant_get(F.parse_json(F.coalesce(checked, broken.cast("string"))), "$", "array<variant>")
    return cuts.filter(~bare).select(F.explode(element).alias("v"), "_file")


def read_json(spark: SparkSession, spec: SourceSpec, paths: list[str]) -> DataFrame:
    """One VARIANT ``v`` per record, keeping the delivered type of every value.

    A file holds one array, or one object per line (``json_lines``); both are read by as many tasks
    as a file has ranges. Broken JSON is an error.
    """
    if spec.json_lines:
        reader = spark.read.option("mode", "FAILFAST")
        return reader.option("singleVariantColumn", "v").json(paths).select("v", _file())
    return array_elements(records(spark, paths, JsonArray()))


READERS: dict[str, Callable[[SparkSession, SourceSpec, list[str]], DataFrame]] = {
    "csv": read_csv,
    "json": read_json,
}


def read_raw(spark: SparkSession, spec: SourceSpec, paths: list[str]) -> DataFrame:
    return READERS[spec.format](spark, spec, paths)
