"""Bronze ingestion: read, check, stage, then swap into the stored table."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..contracts import (
    CONTRACTS,
    PARTITION,
    SNAPSHOT,
    SOURCES,
    ContractError,
    SourceSpec,
    bronze_schema,
)
from ..settings import Settings
from . import files, fs, tables, validate
from .readers import ODD, WIDE, check_columns, read_raw

SKIPPED, LOADED, OUTDATED = "skipped", "loaded", "outdated"


@dataclass(frozen=True)
class Load:
    """What one source delivered in one run."""

    source: str
    status: str
    rows: int
    short_rows: int = 0  # CSV records narrower than their header, filled up with NULLs


def stamp(df: DataFrame, spec: SourceSpec, run_date: Column) -> DataFrame:
    """Add lineage; ``_run_date`` is the logical day of the data, not the wall clock."""
    return df.withColumns(
        {
            "_source_system": F.lit(spec.name),
            "_ingested_at": F.current_timestamp(),
            PARTITION: run_date,
        }
    ).select(*bronze_schema(spec.name).names)


def _file_run_date() -> Column:
    day = F.regexp_extract("_file", r"_(\d{4}-\d{2}-\d{2})\.[a-z]+(/[^/]*)?$", 1)
    return day.cast("date")


def _checked(raw: DataFrame, spec: SourceSpec) -> tuple[DataFrame, Observation]:
    """Typed rows plus the contract counts gathered while they are written: one parse, not two."""
    seen = Observation()
    if spec.format == "csv":
        narrow = F.count_if(F.col(ODD).isNotNull() & ~F.col(WIDE)).alias("narrow")
        return raw.observe(seen, F.count_if(WIDE).alias("wide"), narrow), seen
    raw = validate.opened(raw, spec.name)
    checks = validate.value_checks(spec.name)
    counts = [F.count(validate.member(n)).alias(f"has_{n}") for n in checks]
    counts += [F.count_if(broken).alias(f"bad_{n}") for n, broken in checks.items()]
    counts.append(F.count_if(F.size(validate.undeclared(spec.name)) > 0).alias("undeclared"))
    counts.append(F.count_if(F.col("_r").isNull()).alias("not_objects"))
    return validate.typed(raw.observe(seen, *counts), spec.name), seen


def _verify(raw: DataFrame, spec: SourceSpec, found: dict[str, int]) -> None:
    """Raise on a broken contract; only then is the delivery read again for details."""
    if spec.format == "csv":
        if found["wide"]:
            bad = raw.filter(WIDE).select("_file", *CONTRACTS[spec.name].names[:1])
            quoted = [tuple(r) for r in bad.limit(validate.SAMPLE).collect()]
            raise ContractError(f"{spec.name}: {found['wide']} records are wider than their header, such as {quoted}")
        return
    if found["not_objects"]:
        raise ContractError(f"{spec.name}: {found['not_objects']} records are no JSON objects")
    names = CONTRACTS[spec.name].names
    present = {n for n in names if found[f"has_{n}"]}
    if found["undeclared"]:
        report = validate.column_report(raw, spec.name).filter("issue = 'unexpected'")
        present |= {r.column_name for r in report.collect()}  # one row per distinct name
    check_columns(spec.name, present)
    broken = [n for n in names if found[f"bad_{n}"]]
    if broken:
        details = [validate.describe_offenders(raw, spec.name, n) for n in broken]
        counted = validate.violation_counts(raw, spec.name).orderBy("column_name", "found").collect()  # a row per column and kind
        details += [f"{r.violations} values of '{r.column_name}' are {r.found}" for r in counted]
        raise ContractError(f"{spec.name}: " + " | ".join(details))


def _stage(
    spark: SparkSession, s: Settings, spec: SourceSpec, paths: list[str], run_date: Column
) -> tuple[str, int, int]:
    """Write checked, typed, stamped rows beside the table; returns (path, rows, short rows).

    A contract count above zero proves a violation even if tasks were retried; the row count is
    taken from the staged files, which are exact.
    """
    spec = replace(spec, json_lines=spec.json_lines or s.json_lines)
    raw = read_raw(spark, spec, paths)
    rows, seen = _checked(raw, spec)
    path = tables.staging_path(s, spec.name)
    stamp(rows, spec, run_date).write.parquet(path)
    try:
        count = spark.read.schema(bronze_schema(spec.name)).parquet(path).count()
        if count == 0 and spec.required and spec.format == "csv":
            raise ContractError(f"{spec.name}: no records in {paths}; an empty day is not loaded")
        _verify(raw, spec, seen.get)
    except ContractError:
        fs.remove(spark, path)
        raise
    return path, count, seen.get.get("narrow", 0)


def pending_marker(s: Settings, source: str, day: str) -> str:
    return f"{s.path('ops', 'pending')}/{source}={day}"


def pending(spark: SparkSession, s: Settings) -> dict[str, set[str]]:
    """Days per source that were loaded since silver was last brought in line."""
    found: dict[str, set[str]] = {}
    for marker in fs.glob(spark, f"{s.path('ops', 'pending')}/*=*"):
        name, day = marker.rsplit("/", 1)[1].split("=")
        found.setdefault(name, set()).add(day)
    return found


def settle(spark: SparkSession, s: Settings, done: dict[str, set[str]]) -> None:
    """Silver now holds these loads."""
    for name, days in done.items():
        for day in days:
            fs.remove(spark, pending_marker(s, name, day))


def _publish(
    spark: SparkSession, s: Settings, spec: SourceSpec, staged: str, days: set[str], present: set[str] | None
) -> None:
    """Swap staged rows in. The days are marked as pending first, so that a run cut off in between
    is seen by the next silver run, which may process a day twice without harm."""
    rows = spark.read.schema(bronze_schema(spec.name)).parquet(staged)
    path = s.path("bronze", spec.name)
    if fs.glob(spark, f"{path}/*=*"):
        tables.check_drift(spark, path, spec.name, PARTITION)
    for day in days:
        fs.write_text(spark, pending_marker(s, spec.name, day), "")
    if spec.load_strategy == SNAPSHOT:
        tables.replace_self(rows, path)
    else:
        tables.swap(rows, path, PARTITION, days, present=present)
    tables.note_contract(spark, path, spec.name)
    fs.remove(spark, staged)


def outdated(spark: SparkSession, s: Settings, spec: SourceSpec, day: date) -> bool:
    """A snapshot older than the stored one tells nothing new."""
    if spec.load_strategy != SNAPSHOT:
        return False
    newest = tables.table(spark, s, "bronze", spec.name).agg(F.max(PARTITION)).first()[0]
    return newest is not None and day < newest


def load_day(spark: SparkSession, s: Settings, spec: SourceSpec, day: date) -> Load:
    """One source, one logical day; loading a day again replaces exactly that day."""
    path = files.resolve_day(spark, s, spec, day)
    if path is None:
        return Load(spec.name, SKIPPED, 0)
    if outdated(spark, s, spec, day):
        return Load(spec.name, OUTDATED, 0)
    staged, rows, short = _stage(spark, s, spec, [path], F.lit(day))
    days = {day.isoformat()}
    _publish(spark, s, spec, staged, days, days if rows else set())
    return Load(spec.name, LOADED, rows, short)


def load_history(spark: SparkSession, s: Settings, spec: SourceSpec) -> Load:
    """All delivered days in one scan (append) or the newest file only (snapshot)."""
    try:
        paths = files.resolve_all(spark, s, spec)
    except FileNotFoundError:
        if spec.required:
            raise
        return Load(spec.name, SKIPPED, 0)
    if spec.load_strategy == SNAPSHOT:
        paths = paths[-1:]
    staged, rows, short = _stage(spark, s, spec, paths, _file_run_date())
    if rows == 0:
        fs.remove(spark, staged)
        raise ContractError(f"{spec.name}: no records in {len(paths)} files, nothing is loaded")
    _publish(spark, s, spec, staged, {files.file_day(p).isoformat() for p in paths}, None)
    return Load(spec.name, LOADED, rows, short)


def ingest_day(spark: SparkSession, s: Settings, day: date, sources=SOURCES) -> list[Load]:
    return [load_day(spark, s, spec, day) for spec in sources]


def ingest_history(spark: SparkSession, s: Settings, sources=SOURCES) -> list[Load]:
    return [load_history(spark, s, spec) for spec in sources]
