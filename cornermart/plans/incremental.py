"""Silver tables brought in line with the bronze days loaded since the last run.

Every load leaves a mark of its source and day; a run works on the marked days, whether they are
new, late or delivered again, and clears the marks at its end. A full rebuild and any sequence of
daily runs give the same tables: of an order exported on several days the newest export counts, a
ticket has its lines of all days, and a refund has the deliveries of all days.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..contracts import PARTITION, bronze_schema, silver_schema
from ..operators import silver
from ..session import materialise
from ..settings import Settings
from ..sources import bronze, tables

ORDER_DAY, REFUND_DAY = "order_run_date", "refund_date"
WEB, POS, SHIP = FACTS = ("shopify_orders", "square_transactions", "shipstation_shipments")


def lookups(spark: SparkSession, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(store time zones, exchange rates)."""
    return tuple(tables.table(spark, s, "silver", name) for name in ("store_timezones", "exchange_rates"))


def stored(spark: SparkSession, s: Settings, name: str) -> DataFrame:
    return tables.table(spark, s, "silver", name)


def _dated_refunds(refunds: DataFrame) -> DataFrame:
    return refunds.withColumn(REFUND_DAY, F.to_date("refund_ts"))


def earlier_first_seen(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Customer upsert that keeps the earliest day a key was seen."""
    both = target.unionByName(batch)
    return both.groupBy("customer_key", "customer_type").agg(
        F.min("first_seen_run_date").alias("first_seen_run_date")
    )


def newest_exports(web: DataFrame) -> DataFrame:
    """Of an order exported on several days only the rows of the newest; orders without id stay."""
    newest = web.groupBy("order_id").agg(F.max(PARTITION).alias("_newest"))
    both = web.join(newest.filter("order_id is not null"), "order_id", "left")
    return both.filter(F.col("_newest").isNull() | (F.col(PARTITION) == F.col("_newest"))).select(*web.columns)


def days_of(spark: SparkSession, s: Settings, name: str, keep: Callable[[str], bool]) -> DataFrame:
    """Bronze days picked by ISO date; the others are not even listed."""
    return tables.partitions(spark, s.path("bronze", name), PARTITION, bronze_schema(name), keep)


def newest_day(spark: SparkSession, s: Settings) -> str:
    """The watermark: newest order day in silver by folder name, empty before the first."""
    return tables.newest_partition(spark, s.path("silver", "stg_orders"), ORDER_DAY) or ""


def marked(spark: SparkSession, s: Settings, name: str, done: dict[str, set[str]]) -> DataFrame:
    """Bronze rows of the days of a source that wait for silver."""
    return days_of(spark, s, name, done.get(name, set()).__contains__)


def _keys(df: DataFrame, column: str, name: str = "order_id") -> DataFrame:
    return df.select(F.col(column).alias(name)).filter(F.col(name).isNotNull()).distinct()


def _shaped(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in silver_schema(name).fields])


def refresh_subscriptions(spark: SparkSession, s: Settings) -> None:
    """Always rebuilt: the source is a snapshot."""
    subs = silver.subscriptions(tables.table(spark, s, "bronze", "recharge_subscriptions"))
    tables.replace_self(subs.sort("customer_key"), s.path("silver", "stg_subscriptions"))


def _rebuild_refunds(spark: SparkSession, s: Settings, rates: DataFrame) -> None:
    web, ship = (tables.table(spark, s, "bronze", n) for n in (WEB, SHIP))
    refunds = silver.refunds(newest_exports(web), ship, rates, s.refund_window_days, s.earliest_delivery)
    tables.replace(_shaped(_dated_refunds(refunds), "stg_refunds"), s.path("silver", "stg_refunds"), REFUND_DAY)


def rebuild(spark: SparkSession, s: Settings) -> None:
    """All silver tables from all of bronze."""
    done = bronze.pending(spark, s)
    web, pos = (tables.table(spark, s, "bronze", n) for n in (WEB, POS))
    zones, rates = lookups(spark, s)
    tables.replace_self(silver.customers(web, pos), s.path("silver", "stg_customers"))
    orders = _shaped(silver.orders(newest_exports(web), pos, zones, rates), "stg_orders")
    tables.replace(orders, s.path("silver", "stg_orders"), ORDER_DAY, sort=["channel"])
    _rebuild_refunds(spark, s, rates)
    refresh_subscriptions(spark, s)
    bronze.settle(spark, s, done)


def _online_batch(spark: SparkSession, s: Settings, done: dict[str, set[str]], mark: str) -> tuple[DataFrame, DataFrame]:
    """(newest exports, ids) of the orders that the days touch.

    An order of a day after the watermark has its newest export there. For a late or repeated day,
    the other exports of its orders, and of those it used to hold, are looked up in all days.
    """
    new, days = marked(spark, s, WEB, done), done.get(WEB, set())
    late = {d for d in days if d <= mark}
    if not late:
        return newest_exports(new), materialise(_keys(new, "order_id"), "ids")
    held = tables.partitions(
        spark, s.path("silver", "stg_orders"), ORDER_DAY, silver_schema("stg_orders"), late.__contains__
    ).filter(F.col("channel") != silver.rules.RETAIL)
    ids = materialise(_keys(new.select("order_id").unionByName(held.select("order_id")), "order_id"), "ids")
    everywhere = tables.table(spark, s, "bronze", WEB).join(ids, "order_id", "left_semi")
    nameless = new.filter("order_id is null")
    return newest_exports(everywhere).unionByName(nameless), ids


def _store_batch(spark: SparkSession, s: Settings, done: dict[str, set[str]], mark: str) -> tuple[DataFrame, DataFrame]:
    """(all lines, ids) of the tickets that the days touch.

    A ticket may have lines on several days. Its stored order names the first of them, so for new
    days only those from the first stored one on are read; for a late day, all are.
    """
    new, days = marked(spark, s, POS, done), done.get(POS, set())
    late = {d for d in days if d <= mark}
    orders = tables.table(spark, s, "silver", "stg_orders").filter(F.col("channel") == silver.rules.RETAIL)
    ids = _keys(new, "transaction_id")
    if late:
        held = orders.filter(F.col(ORDER_DAY).cast("string").isin(sorted(late)))
        ids = _keys(ids.unionByName(held.select("order_id")), "order_id")
        old = tables.table(spark, s, "bronze", POS)
    else:
        first = orders.join(ids, "order_id", "left_semi").agg(F.min(ORDER_DAY)).first()[0]
        begin = first.isoformat() if first else "9999"
        old = days_of(spark, s, POS, lambda d: begin <= d and d not in days)
    lines = old.join(ids.withColumnRenamed("order_id", "transaction_id"), "transaction_id", "left_semi").select(*new.columns)
    nameless = new.filter("transaction_id is null")
    return (lines.unionByName(nameless) if late else lines.unionByName(new)), materialise(ids, "ids")


def _among(column: str, days: set[str]) -> Column:
    return F.col(column).cast("string").isin(sorted(days))


def update(spark: SparkSession, s: Settings) -> None:
    """Bring silver in line with the days that were loaded since."""
    if not tables.has_table(spark, s, "silver", "stg_orders"):
        return rebuild(spark, s)
    done = bronze.pending(spark, s)
    web_days, pos_days, ship_days = (done.get(n, set()) for n in FACTS)
    mark = newest_day(spark, s)
    zones, rates = lookups(spark, s)
    schema = silver_schema("stg_orders")

    path = s.path("silver", "stg_customers")
    if min(web_days | pos_days, default="9999") > mark:
        batch = silver.customers(*(marked(spark, s, n, done) for n in (WEB, POS)))
        tables.replace_self(earlier_first_seen(stored(spark, s, "stg_customers"), batch), path)
    else:  # a sighting may have gone
        tables.replace_self(silver.customers(*(tables.table(spark, s, "bronze", n) for n in (WEB, POS))), path)

    web, web_ids = _online_batch(spark, s, done, mark)
    pos, pos_ids = _store_batch(spark, s, done, mark)
    _update_refunds(spark, s, web, web_ids, web_days, ship_days, mark, rates)

    # last, since it moves the watermark
    retail = F.col("channel") == silver.rules.RETAIL
    stale = (retail & _among(ORDER_DAY, pos_days)) | (~retail & _among(ORDER_DAY, web_days))
    batch = _shaped(silver.orders(web, pos, zones, rates), "stg_orders")
    ids = web_ids.unionByName(pos_ids)
    tables.upsert(batch.select(*schema.names), s, "silver", "stg_orders", "order_id", ORDER_DAY, ids, stale, ["channel"])
    refresh_subscriptions(spark, s)
    bronze.settle(spark, s, done)


def _update_refunds(
    spark: SparkSession, s: Settings, web: DataFrame, web_ids: DataFrame, web_days: set[str], ship_days: set[str], mark: str, rates: DataFrame
) -> None:
    """Refunds of the touched orders and of those with new deliveries.

    A late or repeated shipment day may have taken deliveries back, so it rebuilds the refunds. So
    does an order day, since an order may have lost its refunds or changed its day.
    """
    if min(web_days | ship_days, default="9999") <= mark:
        return _rebuild_refunds(spark, s, rates)
    known = stored(spark, s, "stg_refunds")
    shipped = days_of(spark, s, SHIP, ship_days.__contains__)
    delivered = _keys(silver.deliveries(shipped), "order_id")
    waiting = known.join(delivered, "order_id", "left_semi").join(web_ids, "order_id", "left_anti")
    waiting_days = {r[0].isoformat() for r in waiting.select(ORDER_DAY).distinct().collect()}
    old = days_of(spark, s, WEB, waiting_days.__contains__)
    old = old.join(delivered, "order_id", "left_semi").join(web_ids, "order_id", "left_anti").select(*web.columns)
    touched = materialise(web.unionByName(newest_exports(old)).filter(F.size("refunds") > 0), "touched")
    ids = web_ids.unionByName(_keys(old, "order_id")).distinct()
    ship = tables.table(spark, s, "bronze", SHIP)
    relevant = ship.join(_keys(touched, "order_id", "shopify_order_id"), "shopify_order_id", "left_semi")
    refunds = _dated_refunds(silver.refunds(touched, relevant, rates, s.refund_window_days, s.earliest_delivery))
    shaped = _shaped(refunds, "stg_refunds")
    tables.upsert(shaped, s, "silver", "stg_refunds", "order_id", REFUND_DAY, ids, _among(ORDER_DAY, web_days))
