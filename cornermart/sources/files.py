"""Which files make up a delivery."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import SparkSession

from ..contracts import SourceSpec
from ..settings import Settings
from . import fs

_DAY = re.compile(r"_(\d{4}-\d{2}-\d{2})\.[a-z]+/*$")


def hive_folder(zone: str, source_name: str, day: date) -> str:
    """``zone/source_name=/year=/month=/day=`` folder of one source and day."""
    return f"{zone.rstrip('/')}/source_name={source_name}/year={day:%Y}/month={day:%m}/day={day:%d}"


def day_path(s: Settings, spec: SourceSpec, day: date) -> str:
    file_name = f"{spec.name}_{day.isoformat()}.{spec.format}"
    folder = hive_folder(s.raw, spec.name, day) if s.hive_raw_layout else s.raw.rstrip("/")
    return f"{folder}/{file_name}"


def resolve_day(spark: SparkSession, s: Settings, spec: SourceSpec, day: date) -> str | None:
    """The day's file, None for an optional source without one, else an error."""
    path = day_path(s, spec, day)
    if fs.exists(spark, path):
        return path
    if spec.required:
        raise FileNotFoundError(f"no file for required source {spec.name!r} on {day}: {path}")
    return None


def resolve_all(spark: SparkSession, s: Settings, spec: SourceSpec) -> list[str]:
    """Every dated file of a source, oldest first."""
    folder = f"{s.raw.rstrip('/')}/source_name={spec.name}/*/*/*" if s.hive_raw_layout else s.raw
    found = fs.glob(spark, f"{folder}/{spec.name}_*.{spec.format}")
    dated = [p for p in found if file_day(p)]
    if not dated:
        raise FileNotFoundError(f"no files for source {spec.name!r} under {s.raw}")
    return sorted(dated, key=file_day)


def file_day(path: str) -> date | None:
    match = _DAY.search(path)
    return date.fromisoformat(match.group(1)) if match else None
