"""Jobs: seeds, ingestion, silver, gold, checks, in dependency order."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..contracts import PARTITION, SOURCES
from ..operators import gold, quality, silver
from ..session import pin
from ..settings import Settings
from ..sources import bronze, seeds, tables
from . import incremental

SILVER = ("stg_customers", "stg_orders", "stg_refunds", "stg_subscriptions")
GOLD = (
    "fact_weekly_revenue",
    "fact_subscription_churn",
    "fact_customer_health",
    "fact_customer_rfm",
    "fact_refund_alerts",
)
RUN_LOG = (
    "run_id string, step string, table_name string, run_date date, rows bigint, status string,"
    " short_rows bigint, finished_at timestamp, seconds double"
)


class RunLog:
    """One row per step and run; kept when a step fails."""

    def __init__(self, spark: SparkSession, s: Settings, run_date: date | None):
        self.spark, self.path, self.run_date = spark, s.path("ops", "run_log"), run_date
        self.run_id = uuid.uuid4().hex

    def add(self, step: str, name: str, rows: int | None, status: str, began: float, short: int | None = None) -> None:
        now = datetime.now(timezone.utc)
        row = (self.run_id, step, name, self.run_date, rows, status, short, now, time.time() - began)
        self.spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").parquet(self.path)

    def step(self, step: str, name: str, work: Callable[[], bronze.Load | dict[str, int] | None]) -> None:
        """Run one step; a failure is logged and stops the run. A step that gives rows per table is
        logged once for each."""
        began = time.time()
        try:
            done = work()
        except Exception:
            self.add(step, name, None, "failed", began)
            raise
        if isinstance(done, bronze.Load):
            self.add(step, name, done.rows, done.status, began, done.short_rows)
        elif done:
            for table_name, rows in done.items():
                self.add(step, table_name, rows, "built", began)
        else:
            self.add(step, name, None, "built", began)


def counted(spark: SparkSession, s: Settings, layer: str, names: Iterable[str]) -> dict[str, int]:
    """Rows per stored table, from the files' footers."""
    return {n: tables.table(spark, s, layer, n).count() for n in names}


def load_seeds(spark: SparkSession, s: Settings, paths: dict[str, str]) -> None:
    for name, path in paths.items():
        tables.replace_self(seeds.read_seed(spark, name, path).coalesce(1), s.path("silver", name))


def build_gold(spark: SparkSession, s: Settings) -> None:
    """Gold tables are ranked or windowed over everything, so each is rebuilt from silver."""
    orders = incremental.stored(spark, s, "stg_orders")
    customers = incremental.stored(spark, s, "stg_customers")
    refunds = incremental.stored(spark, s, "stg_refunds").select(*silver.REFUND_COLUMNS)
    subs = tables.table(spark, s, "silver", "stg_subscriptions")
    built = {
        "fact_weekly_revenue": gold.weekly_revenue(orders, s),
        "fact_subscription_churn": gold.subscription_churn(subs),
        "fact_customer_health": gold.customer_health(orders, customers, s),
        "fact_customer_rfm": gold.customer_rfm(orders, customers, subs, s),
        "fact_refund_alerts": gold.refund_alerts(orders, refunds, s).coalesce(1),
    }
    for name, df in built.items():
        tables.replace_self(df, s.path("gold", name))


def check(spark: SparkSession, s: Settings, run_date: date | None = None) -> DataFrame:
    """Run all checks on the stored tables and append the results to their history."""
    built = {n: tables.table(spark, s, "silver", n) for n in SILVER}
    built |= {n: tables.table(spark, s, "gold", n) for n in GOLD}
    results = quality.run_checks(built, s).withColumns(
        {"run_date": F.lit(run_date).cast("date"), "checked_at": F.current_timestamp()}
    )
    results.coalesce(1).write.mode("append").parquet(s.path("ops", "check_history"))
    history = spark.read.parquet(s.path("ops", "check_history"))
    newest = history.agg(F.max("checked_at")).first()[0]
    return history.filter(F.col("checked_at") == F.lit(newest))


def bad_values(spark: SparkSession, s: Settings, names: Iterable[str]) -> DataFrame:
    """The values outside their declared sets in the named stored tables, with their rows."""
    layers = {n: "silver" if n in SILVER else "gold" for n in names}
    return quality.accepted_report({n: tables.table(spark, s, layer, n) for n, layer in layers.items()})


def freshness(named: dict[str, DataFrame]) -> DataFrame:
    """Rows and newest logical day per table, and how far it lags the newest table."""
    per_table = None
    for name, df in named.items():
        one = df.agg(
            F.count("*").alias("n_rows"), F.max(PARTITION).alias("latest_run_date")
        ).select(F.lit(name).alias("table_name"), "n_rows", "latest_run_date")
        per_table = one if per_table is None else per_table.unionByName(one)
    newest = F.max("latest_run_date").over(Window.partitionBy())  # one row per table
    lag = F.datediff(newest, "latest_run_date").alias("days_behind")
    return per_table.select("*", lag)


def note_freshness(spark: SparkSession, s: Settings, run_date: date | None) -> None:
    """Append the freshness of the bronze tables to its history."""
    named = {spec.name: tables.table(spark, s, "bronze", spec.name) for spec in SOURCES}
    rows = freshness(named).withColumns({"run_date": F.lit(run_date).cast("date"), "checked_at": F.current_timestamp()})
    rows.coalesce(1).write.mode("append").parquet(s.path("ops", "freshness"))


def build(spark: SparkSession, s: Settings, log: RunLog, silver_step: Callable[[SparkSession, Settings], None]) -> DataFrame:
    """Silver, gold, freshness and checks over what bronze holds."""

    def silver_tables() -> dict[str, int]:
        silver_step(spark, s)
        return counted(spark, s, "silver", SILVER)

    def gold_tables() -> dict[str, int]:
        build_gold(spark, s)
        return counted(spark, s, "gold", GOLD)

    log.step("silver", "silver", silver_tables)
    log.step("gold", "gold", gold_tables)
    log.step("freshness", "freshness", lambda: note_freshness(spark, s, log.run_date))
    return check(spark, s, log.run_date)


def run_days(spark: SparkSession, s: Settings, days: Iterable[date], seed_paths: dict[str, str]) -> DataFrame:
    """Load logical days, new or delivered again, then build and check everything once."""
    pin(spark)
    days = sorted(days)
    log = RunLog(spark, s, days[-1])
    log.step("seed", "seeds", lambda: load_seeds(spark, s, seed_paths))
    for day in days:
        for spec in SOURCES:
            log.step("ingest", spec.name, lambda spec=spec, day=day: bronze.load_day(spark, s, spec, day))
    return build(spark, s, log, incremental.update)


def run_arrivals(spark: SparkSession, s: Settings, load: Callable[[], None], seed_paths: dict[str, str]) -> DataFrame:
    """Load what has arrived, then build and check."""
    pin(spark)
    log = RunLog(spark, s, None)
    log.step("seed", "seeds", lambda: load_seeds(spark, s, seed_paths))
    log.step("ingest", "arrivals", load)
    return build(spark, s, log, incremental.update)


def run_history(spark: SparkSession, s: Settings, seed_paths: dict[str, str]) -> DataFrame:
    """Everything delivered so far as one full refresh."""
    pin(spark)
    log = RunLog(spark, s, None)
    log.step("seed", "seeds", lambda: load_seeds(spark, s, seed_paths))
    for spec in SOURCES:
        log.step("ingest", spec.name, lambda spec=spec: bronze.load_history(spark, s, spec))
    return build(spark, s, log, incremental.rebuild)


def violated(results: DataFrame, allowed: Iterable[str] = ()) -> list:
    """Findings of checks that aren't allowed to fail; one row per check and column, so few."""
    found = results.filter((F.col("violations") > 0) & ~F.col("check_name").isin(list(allowed)))
    return found.select("check_name", "table_name", "column_name", "violations").collect()
