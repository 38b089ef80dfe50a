"""Jobs for spark-submit: ``python -m cornermart <job> --root <uri> --raw <uri> --seeds <uri> ...``.

A job ends with exit code 1 if a check fails that ``--allow`` doesn't name.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from .contracts import SOURCES, parse_run_date
from .plans import daily_build
from .session import pin
from .settings import Settings
from .sources import tables
from .sources.seeds import SEEDS
from .streaming.arrivals import ingest_arrivals

VARIABLES = {f.name: type(f.default) for f in fields(Settings) if f.name not in ("root", "raw", "hive_raw_layout")}


def variable(text: str) -> tuple[str, object]:
    """``name=value`` of a setting, in the setting's type."""
    name, _, value = text.partition("=")
    if name not in VARIABLES:
        raise argparse.ArgumentTypeError(f"unknown setting {name!r}, known are {sorted(VARIABLES)}")
    kind = VARIABLES[name]
    return name, value.lower() in ("1", "true", "yes") if kind is bool else kind(value)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cornermart")
    parser.add_argument("job", choices=["history", "day", "backfill", "arrivals", "check", "audit", "archive"])
    parser.add_argument("--root", required=True, help="URI of the lake")
    parser.add_argument("--raw", required=True, help="URI of the raw deliveries")
    parser.add_argument("--seeds", help="URI of the folder with the seed files")
    parser.add_argument("--hive-raw-layout", action="store_true")
    parser.add_argument("--date", type=parse_run_date, help="logical day, default today; it may have been loaded before")
    parser.add_argument("--until", type=parse_run_date, help="last day of a backfill")
    parser.add_argument("--zone", help="URI of the archive, by source, year, month and day")
    parser.add_argument("--progress", help="URI for the progress of the arrivals stream")
    parser.add_argument("--set", type=variable, action="append", default=[], metavar="NAME=VALUE", help="a threshold, the zone, json_lines ...")
    parser.add_argument("--allow", action="append", default=[], metavar="CHECK", help="a check that may fail")
    a = parser.parse_args(argv)
    if a.job == "archive" and not a.zone:
        parser.error("archive needs --zone")
    return a


def settings(a: argparse.Namespace) -> Settings:
    return Settings(root=a.root, raw=a.raw, hive_raw_layout=a.hive_raw_layout, **dict(a.set))


def days_of(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def audit(spark: SparkSession, s: Settings) -> int:
    """Print what differs from the contracts in stored bronze tables."""
    names = [spec.name for spec in SOURCES if tables.has_table(spark, s, "bronze", spec.name)]
    rows = [tuple(r) for name in names for r in tables.audit(spark, s, name).collect()]
    for row in rows:
        print(*row, sep="\t")
    return int(bool(rows))


def archive(spark: SparkSession, s: Settings, zone: str) -> int:
    """Copy the stored bronze tables into dated folders; the days written replace those there."""
    for spec in SOURCES:
        if tables.has_table(spark, s, "bronze", spec.name):
            tables.write_hive_layout(tables.table(spark, s, "bronze", spec.name), f"{zone.rstrip('/')}")
    return 0


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    s = settings(a)
    seeds = {name: f"{(a.seeds or a.raw).rstrip('/')}/{name}.csv" for name in SEEDS}
    day = a.date or date.today()
    if a.job == "audit":
        return audit(spark, s)
    if a.job == "archive":
        return archive(spark, s, a.zone)

    def arrived() -> None:
        ingest_arrivals(spark, s, a.progress or s.path("ops", "arrivals")).awaitTermination()

    def check() -> DataFrame:
        return daily_build.check(pin(spark), s, day)

    results = {
        "history": lambda: daily_build.run_history(spark, s, seeds),
        "day": lambda: daily_build.run_days(spark, s, [day], seeds),
        "backfill": lambda: daily_build.run_days(spark, s, days_of(day, a.until or day), seeds),
        "arrivals": lambda: daily_build.run_arrivals(spark, s, arrived, seeds),
        "check": check,
    }[a.job]()
    found = daily_build.violated(results, a.allow)
    for row in found:
        print(*row, sep="\t")
    outside = {row.table_name for row in found if row.check_name == "accepted_values"}
    for row in daily_build.bad_values(spark, s, sorted(outside)).collect() if outside else []:
        print(*row, sep="\t")
    print(f"{len(found)} findings; all results are in {s.path('ops', 'check_history')}")
    return int(bool(found))


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    return run(SparkSession.builder.appName(f"cornermart-{a.job}").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
