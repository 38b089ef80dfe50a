"""One named query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, IntegerType

from ..contracts import PARTITION
from ..functions import timefx
from ..operators import gold, quality, silver
from ..plans import daily_build, incremental
from ..session import materialise, scratch
from ..settings import Settings
from ..sources import bronze, fs, tables, validate
from . import views
from .views import Shop

SILVER, GOLD = daily_build.SILVER, daily_build.GOLD
CUTOFF = "2000-01-01"  # the stored part of the incremental demonstrations ends before this day


def present(df: DataFrame) -> DataFrame:
    """Plain result types: decimals as doubles of 6 places, integers as bigint."""

    def plain(name: str, dtype) -> Column:
        c = F.col(name)
        if isinstance(dtype, DecimalType):
            return F.round(c, 6).cast("double").alias(name)
        return c.cast("bigint").alias(name) if isinstance(dtype, IntegerType) else c

    return df.select(*[plain(f.name, f.dataType) for f in df.schema.fields])


def _lake(w: Shop, name: str) -> Settings:
    return replace(w.s, root=scratch(w.spark, name))


def _snapshot_latest(w: Shop) -> DataFrame:
    """Store all older records as a snapshot, then the newest day's; the stored table is the newest."""
    s, newest = _lake(w, "snapshots"), w.subs.agg(F.max(PARTITION)).first()[0]
    path = s.path("bronze", "recharge_subscriptions")
    for day in (F.col(PARTITION) < F.lit(newest), F.col(PARTITION) == F.lit(newest)):
        tables.replace_self(w.subs.filter(day), path)
    return w.spark.read.schema(w.subs.schema).parquet(tables.current(w.spark, path))


def _partition_swap(w: Shop) -> DataFrame:
    """Store all order days, then deliver the last year again with a corrected price."""
    path = scratch(w.spark, "shopify_orders")
    orders = w.web.select("order_id", "total_price", "financial_status", PARTITION)
    tables.swap(orders, path, PARTITION, set())
    again = orders.filter(F.col(PARTITION) >= "2001-01-01").withColumn(
        "total_price", (F.col("total_price") * F.lit("0.9").cast("decimal(2,1)")).cast("decimal(18,4)")
    )
    tables.swap(again, path, PARTITION, set())
    stored = w.spark.read.schema(orders.schema).parquet(path)
    return stored.select("order_id", "total_price", "financial_status", PARTITION)


def _incremental_new_rows(w: Shop) -> DataFrame:
    """Bronze holds all order days; those from the cutoff on wait for silver, and the job reads them."""
    s = _lake(w, "increment")
    tables.swap(w.web.drop("line_items"), s.path("bronze", incremental.WEB), PARTITION, set())
    waiting = w.web.filter(F.col(PARTITION) >= CUTOFF)
    for day in tables.values_of(waiting, PARTITION):
        fs.write_text(w.spark, bronze.pending_marker(s, incremental.WEB, day), "")
    fresh = incremental.marked(w.spark, s, incremental.WEB, bronze.pending(w.spark, s))
    return fresh.select("order_id", "customer_email", "total_price", PARTITION)


def _upsert_merge(w: Shop) -> DataFrame:
    """Stored orders before the cutoff; the batch brings later ones and restates the last month."""
    s, orders = _lake(w, "upsert"), silver.online_orders(w.web)
    tables.swap(orders.filter(F.col("order_run_date") < CUTOFF), s.path("silver", "orders"), "order_run_date", set())
    batch = orders.filter(F.col("order_run_date") >= "1999-12-01").withColumn(
        "currency", F.concat(F.lit("re-"), "currency")
    )
    tables.upsert(batch, s, "silver", "orders", "order_id", "order_run_date")
    stored = w.spark.read.schema(orders.schema).parquet(s.path("silver", "orders"))
    return stored.select(*orders.columns)


def _two_part_load(w: Shop) -> DataFrame:
    """Bronze and silver loaded in two parts, with tickets, deliveries and refunds across the cut:
    the second part is brought in by the daily job. The refunds must be those of a full build."""
    s = _lake(w, "parts")
    year = F.trunc(PARTITION, "year").alias(PARTITION)  # one folder per year keeps the trial's files few
    sources = {incremental.WEB: w.web, incremental.POS: w.pos, incremental.SHIP: w.ship}
    seeds = {"store_timezones": w.zones, "exchange_rates": w.rates}
    for name, df in seeds.items():
        tables.replace_self(df, s.path("silver", name))
    tables.replace_self(w.subs, s.path("bronze", "recharge_subscriptions"))
    yearly = {n: df.select(*[c for c in df.columns if c != PARTITION], year) for n, df in sources.items()}
    late = F.col(PARTITION) >= "1997-01-01"
    for part in (~late, late):
        for name, df in yearly.items():
            rows = df.filter(part)
            path = s.path("bronze", name)
            tables.swap(rows, path, PARTITION, set())
            brought = tables.table(w.spark, s, "bronze", name).filter(part)  # the folders' days, no data
            for day in tables.values_of(brought, PARTITION):
                fs.write_text(w.spark, bronze.pending_marker(s, name, day), "")
        incremental.update(w.spark, s)
    stored = incremental.stored(w.spark, s, "stg_refunds")
    return stored.select("refund_id", "order_id", "amount_usd", "delivered_at", "refund_ts", "within_policy_window")


def _freshness(w: Shop) -> DataFrame:
    return daily_build.freshness(
        {
            "shopify_orders": w.web,
            "square_transactions": w.pos,
            "recharge_subscriptions": w.subs,
            "zendesk_tickets": w.tickets,
            "shipstation_shipments": w.ship,
        }
    )


def _tenure(w: Shop) -> DataFrame:
    base = gold.rfm_base(w.stg_orders, w.stg_customers, w.s)
    return gold.subscriber_tenure(w.stg_subscriptions, gold.reference_day(base), w.s)


def _quintiles(w: Shop) -> DataFrame:
    return gold.rfm_quintiles(materialise(gold.rfm_base(w.stg_orders, w.stg_customers, w.s)))


def _local(w: Shop, ts: str = "order_ts_raw") -> Column:
    return timefx.utc_to_local(F.col(ts), w.s.reporting_timezone)


QUERIES: dict[str, Callable[[Shop], DataFrame]] = {
    # ingestion
    "snapshot_latest": _snapshot_latest,
    "contract_columns": lambda w: validate.column_report(
        views.shopify_json(w.spark, w.sf_dir), "shopify_orders"
    ),
    "contract_violations": lambda w: validate.violation_counts(
        views.shopify_json(w.spark, w.sf_dir), "shopify_orders"
    ),
    "partition_swap": _partition_swap,
    "incremental_new_rows": _incremental_new_rows,
    "upsert_merge": _upsert_merge,
    "two_part_load": _two_part_load,
    "freshness": _freshness,
    # time functions
    "ts_parse_utc": lambda w: w.web.select(
        "order_id", timefx.parse_utc(F.col("created_at")).alias("created_utc")
    ),
    "ts_naive_to_utc": lambda w: w.pos.groupBy("transaction_id", "location_id", "created_at_local")
    .count()
    .join(w.zones, "location_id")
    .select(
        "transaction_id",
        timefx.naive_to_utc(F.col("created_at_local"), F.col("timezone_name")).alias("created_utc"),
    ),
    "ts_utc_to_local": lambda w: silver.online_orders(w.web).select(
        "order_id", _local(w).alias("ticket_clock")
    ),
    "week_start": lambda w: silver.online_orders(w.web).select(
        "order_id", timefx.week_start(_local(w)).alias("week_start_date")
    ),
    "local_date": lambda w: w.pos.groupBy(
        "transaction_id", timefx.local_date(F.col("created_at_local")).alias("local_day")
    ).agg(F.count("*").alias("n_lines")),
    "utc_date": lambda w: w.web.select(
        "order_id", timefx.utc_date(F.col("created_at")).alias("utc_day")
    ),
    "day_diff": lambda w: silver.exploded_refunds(w.web).select(
        "refund_id",
        timefx.day_diff(timefx.parse_utc(F.col("created_at")), F.col("refund_ts")).alias("days"),
    ),
    # cleaned tables
    "customers_online": lambda w: silver.online_customers(w.web),
    "customers_loyalty": lambda w: silver.loyalty_customers(w.pos),
    "customers_walk_in": lambda w: silver.walk_in_customers(w.pos),
    "stg_customers": lambda w: w.stg_customers,
    "square_order_rollup": lambda w: silver.store_orders(w.pos),
    "square_orders_utc": lambda w: silver.store_orders_utc(w.pos, w.zones),
    "online_orders": lambda w: silver.online_orders(w.web),
    "orders_combined": lambda w: silver.all_orders(w.web, w.pos, w.zones),
    "orders_fx": lambda w: silver.convert_orders(silver.online_orders(w.web), w.rates).select(
        "order_id", "currency", "amount_original", "amount_usd"
    ),
    "stg_orders": lambda w: w.stg_orders,
    "refunds_exploded": lambda w: silver.exploded_refunds(w.web),
    "shipments_delivered": lambda w: silver.deliveries(w.ship),
    "refund_delivery_lag": lambda w: silver.refunds_with_delivery(w.web, w.ship).select(
        "refund_id", "order_id", "delivered_at", "refund_ts", "days_since_delivery"
    ),
    "refund_policy_flags": lambda w: silver.flag_refunds(
        silver.refunds_with_delivery(w.web, w.ship), w.s.refund_window_days
    ).select(
        "refund_id",
        "days_since_delivery",
        "within_policy_window",
        "refunded_before_delivery_confirmed",
    ),
    "refunds_fx": lambda w: silver.convert_refunds(silver.exploded_refunds(w.web), w.rates).select(
        "refund_id", "currency", "amount_original", "amount_usd"
    ),
    "stg_refunds": lambda w: w.stg_refunds,
    "stg_subscriptions": lambda w: w.stg_subscriptions,
    # business tables
    "fact_weekly_revenue": lambda w: w.fact_weekly_revenue,
    "latest_subscription": lambda w: gold.latest_subscription(w.stg_subscriptions),
    "fact_subscription_churn": lambda w: w.fact_subscription_churn,
    "customer_last_order": lambda w: gold.customer_last_order(w.stg_orders, w.s),
    "fact_customer_health": lambda w: w.fact_customer_health,
    "rfm_base": lambda w: gold.rfm_base(w.stg_orders, w.stg_customers, w.s),
    "subscriber_tenure": _tenure,
    "rfm_quintiles": _quintiles,
    "fact_customer_rfm": lambda w: w.fact_customer_rfm,
    "activity_dates": lambda w: gold.activity_dates(w.stg_orders, w.stg_refunds, w.s),
    "calendar_spine": lambda w: gold.calendar_spine(w.stg_orders, w.stg_refunds, w.s),
    "refund_baseline": lambda w: gold.refund_baseline(w.stg_orders, w.stg_refunds, w.s),
    "daily_order_refund": lambda w: gold.daily_order_refund(w.stg_orders, w.stg_refunds, w.s),
    "refund_rolling": lambda w: gold.refund_rolling(w.stg_orders, w.stg_refunds, w.s),
    "fact_refund_alerts": lambda w: w.fact_refund_alerts,
    # data quality
    "dq_unique": lambda w: quality.unique_report(w.store("sales", *SILVER, *GOLD).tables(*SILVER, *GOLD)),
    "dq_not_null": lambda w: quality.not_null_report(
        w.store("sales", *SILVER, *GOLD).tables(*SILVER, *GOLD)
    ),
    "dq_accepted_values": lambda w: quality.accepted_report(
        w.store("sales", *SILVER, *GOLD).tables(*SILVER, *GOLD)
    ),
    "dq_relationships": lambda w: quality.relationship_report(w.store("sales", *SILVER).tables(*SILVER)),
    "dq_cad_orders": lambda w: quality.unconverted_cad(w.stg_orders),
    "dq_cad_refunds": lambda w: quality.unconverted_cad(w.stg_refunds),
    "dq_duplicate_active": lambda w: quality.duplicate_active(w.stg_subscriptions),
    "dq_negative_recency": lambda w: quality.negative_recency(w.fact_customer_health),
    "dq_reactivated": lambda w: quality.reactivated_but_churned(
        w.stg_subscriptions, w.fact_subscription_churn
    ),
    "dq_refund_conservation": lambda w: quality.refund_conservation(
        w.store("stg_orders", "stg_refunds").fact_refund_alerts, w.stg_refunds
    ),
    "dq_rfm_sum": lambda w: quality.rfm_sum_broken(w.fact_customer_rfm),
    "dq_tenure_history": lambda w: quality.tenure_history_broken(
        w.store("stg_orders").fact_customer_rfm, w.stg_subscriptions, w.stg_orders, w.s
    ),
    "dq_revenue_reconcile": lambda w: quality.revenue_reconciliation(
        w.store("stg_orders").fact_weekly_revenue, w.stg_orders
    ),
}


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: present(QUERIES[name](Shop(spark, sf_dir)))
