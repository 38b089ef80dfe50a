"""Pure column functions for instants, local times and calendar days.

Stored timestamps are TIMESTAMP_NTZ holding UTC. The session zone is pinned to UTC, so a
cast between TIMESTAMP and TIMESTAMP_NTZ never moves the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_UTC = "UTC"


def parse_utc(text: Column) -> Column:
    """ISO text with an offset -> naive UTC."""
    return text.cast("timestamp").cast("timestamp_ntz")


def naive_to_utc(text: Column, zone: Column) -> Column:
    """Wall-clock text of ``zone`` -> naive UTC."""
    return F.convert_timezone(zone, F.lit(_UTC), text.cast("timestamp_ntz"))


def utc_to_local(ts: Column, zone: str) -> Column:
    """Naive UTC -> wall clock of a fixed zone, which Spark looks up once and not per row."""
    return F.from_utc_timestamp(ts.cast("timestamp"), zone).cast("timestamp_ntz")


def week_start(ts: Column) -> Column:
    """Monday of the week."""
    return F.trunc(F.to_date(ts), "week")


def local_date(text: Column) -> Column:
    """Calendar day of wall-clock text; no zone applied."""
    return F.to_date(text.cast("timestamp_ntz"))


def utc_date(text: Column) -> Column:
    """UTC calendar day of ISO text with an offset."""
    return F.to_date(parse_utc(text))


def day_diff(start: Column, end: Column) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end``."""
    return F.datediff(F.to_date(end), F.to_date(start))


def date_spine(start: Column, end: Column) -> Column:
    """Generator: every day from ``start`` to ``end`` inclusive."""
    return F.explode(F.sequence(start, end, F.expr("interval 1 day")))
