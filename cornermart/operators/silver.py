"""Cleaned tables: one customer per known key, unified orders and refunds, subscriptions.

Every function is DataFrame -> DataFrame over the bronze contract columns. Reference tables are joined
plainly: Spark broadcasts one whose size it knows to be small, and splits a hot store or currency at
run time otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import rules, timefx

ORDER_COLUMNS = [
    "order_id", "customer_key", "channel", "currency", "amount_original", "order_run_date", "order_ts_raw",
]
REFUND_COLUMNS = [
    "refund_id", "order_id", "customer_key", "amount_original", "currency", "amount_usd", "reason",
    "delivered_at", "refund_ts", "days_since_delivery", "order_run_date",
    "within_policy_window", "refunded_before_delivery_confirmed",
]


# -- customers ---------------------------------------------------------------------------


def _first_seen(sightings: DataFrame) -> DataFrame:
    """Sightings -> one row per key and type; the minimum combines map-side."""
    return sightings.groupBy("customer_key", "customer_type").agg(
        F.min("_run_date").alias("first_seen_run_date")
    )


def _online_sightings(web: DataFrame) -> DataFrame:
    key, kind = F.col("customer_email").alias("customer_key"), F.lit(rules.ONLINE)
    return web.select(key, kind.alias("customer_type"), "_run_date")


def _store_sightings(pos: DataFrame) -> DataFrame:
    """Loyalty and walk-in identities from one scan."""
    return pos.select(
        rules.store_customer_key().alias("customer_key"),
        rules.store_customer_type().alias("customer_type"),
        "_run_date",
    )


def online_customers(web: DataFrame) -> DataFrame:
    return _first_seen(_online_sightings(web))


def loyalty_customers(pos: DataFrame) -> DataFrame:
    return _first_seen(_store_sightings(pos.filter(F.col("customer_phone").isNotNull())))


def walk_in_customers(pos: DataFrame) -> DataFrame:
    return _first_seen(_store_sightings(pos.filter(F.col("customer_phone").isNull())))


def customers(web: DataFrame, pos: DataFrame) -> DataFrame:
    """All three identity kinds stacked, with a single shuffle."""
    return _first_seen(_online_sightings(web).unionByName(_store_sightings(pos)))


# -- orders ------------------------------------------------------------------------------


def ticket_totals(pos: DataFrame) -> DataFrame:
    """Ticket lines -> one row per ticket, of the first day it was sold. Sums combine map-side, so a
    huge ticket is no hot spot. The customers of the rows are those of the lines."""
    ticket = ["transaction_id", "location_id", "customer_phone", "created_at_local"]
    return pos.groupBy(*ticket).agg(
        F.min("_run_date").alias("_run_date"),
        F.sum(rules.line_amount()).cast(rules.MONEY).alias("amount_original"),
    )


def store_orders(pos: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """One row per ticket, from its lines or from their ``ticket_totals``, where those are stored."""
    rolled = ticket_totals(pos) if totals is None else totals
    return rolled.select(
        F.col("transaction_id").alias("order_id"),
        "location_id",
        rules.store_customer_key().alias("customer_key"),
        F.col("created_at_local").alias("ticket_clock"),
        F.col("_run_date").alias("order_run_date"),
        "amount_original",
    )


def store_orders_utc(pos: DataFrame, zones: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Tickets in the common order shape; a store without a time zone drops its sales."""
    located = store_orders(pos, totals).join(zones, "location_id")
    return located.select(
        "order_id",
        "customer_key",
        F.lit(rules.RETAIL).alias("channel"),
        F.lit("USD").alias("currency"),
        "amount_original",
        "order_run_date",
        timefx.naive_to_utc(F.col("ticket_clock"), F.col("timezone_name")).alias("order_ts_raw"),
    )


def online_orders(web: DataFrame) -> DataFrame:
    kept = web.filter(F.col("cancelled_at").isNull())
    return kept.select(
        "order_id",
        F.col("customer_email").alias("customer_key"),
        rules.online_channel().alias("channel"),
        "currency",
        F.col("total_price").cast(rules.MONEY).alias("amount_original"),
        F.col("_run_date").alias("order_run_date"),
        timefx.parse_utc(F.col("created_at")).alias("order_ts_raw"),
    )


def all_orders(web: DataFrame, pos: DataFrame, zones: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    return store_orders_utc(pos, zones, totals).unionByName(online_orders(web))


def to_usd(facts: DataFrame, day, rates: DataFrame) -> DataFrame:
    """Add ``amount_usd`` at the rate of ``day``; a missing rate counts as 1 (checked later)."""
    dated = facts.withColumn("currency_date", day)
    priced = dated.join(rates, ["currency", "currency_date"], "left")
    rate = F.coalesce(F.col("rate_to_usd"), F.lit(1).cast(rules.RATE))
    return priced.withColumn("amount_usd", F.col("amount_original") * rate)


def convert_orders(combined: DataFrame, rates: DataFrame) -> DataFrame:
    priced = to_usd(combined, F.to_date("order_ts_raw"), rates)
    return priced.select(*ORDER_COLUMNS, "amount_usd")


def orders(
    web: DataFrame, pos: DataFrame, zones: DataFrame, rates: DataFrame, totals: DataFrame | None = None
) -> DataFrame:
    """``totals``, where the caller has stored the ``ticket_totals`` of ``pos``, spare a pass over it."""
    return convert_orders(all_orders(web, pos, zones, totals), rates)


# -- refunds -----------------------------------------------------------------------------


def exploded_refunds(web: DataFrame) -> DataFrame:
    """One row per refund; cancelled orders keep theirs, orders without refunds vanish."""
    exploded = web.select(
        "order_id",
        F.col("customer_email").alias("customer_key"),
        "currency",
        "created_at",
        F.col("_run_date").alias("order_run_date"),
        F.explode("refunds").alias("r"),
    )
    return exploded.select(
        F.col("r.refund_id").alias("refund_id"),
        "order_id",
        "customer_key",
        F.col("r.amount").cast(rules.MONEY).alias("amount_original"),
        "currency",
        "created_at",
        "order_run_date",
        F.col("r.reason").alias("reason"),
        timefx.parse_utc(F.col("r.created_at")).alias("refund_ts"),
    )


def deliveries(shipments: DataFrame) -> DataFrame:
    done = shipments.filter(F.col("status") == "delivered")
    return done.select(
        F.col("shopify_order_id").alias("order_id"),
        timefx.parse_utc(F.col("last_scan_at")).alias("delivered_at"),
    )


def refunds_with_delivery(
    web: DataFrame, shipments: DataFrame, earliest_only: bool = False
) -> DataFrame:
    """Refund x delivery, keeping refunds without one; several deliveries repeat the refund.

    A left outer join cannot split a hot right side, so it is written as inner plus anti: the
    inner part can be split on either side at run time and the anti part sees one row per order.
    The join key is never NULL (a refund without order matches nothing), which makes both parts
    read the same shuffle of the refunds. ``earliest_only`` keeps one delivery per order, so a
    refund is never repeated.
    """
    refunds = exploded_refunds(web).withColumn("_key", F.coalesce("order_id", F.lit("\0")))
    delivered = deliveries(shipments).filter("order_id is not null")
    delivered = delivered.withColumnRenamed("order_id", "_key")
    if earliest_only:
        delivered = delivered.groupBy("_key").agg(F.min("delivered_at").alias("delivered_at"))
    matched = refunds.join(delivered, "_key")
    pending = refunds.join(delivered.select("_key").distinct(), "_key", "left_anti")
    pending = pending.withColumn("delivered_at", F.lit(None).cast("timestamp_ntz"))
    both = matched.unionByName(pending).drop("_key")
    return both.withColumn(
        "days_since_delivery", timefx.day_diff(F.col("delivered_at"), F.col("refund_ts"))
    )


def flag_refunds(lagged: DataFrame, window_days: int) -> DataFrame:
    days, delivered = F.col("days_since_delivery"), F.col("delivered_at")
    return lagged.withColumns(
        {
            "within_policy_window": rules.within_policy(days, delivered, window_days),
            "refunded_before_delivery_confirmed": rules.before_delivery(days, delivered),
        }
    )


def convert_refunds(refunds: DataFrame, rates: DataFrame) -> DataFrame:
    """The rate is that of the order's UTC day, not of the refund."""
    return to_usd(refunds, timefx.utc_date(F.col("created_at")), rates)


def refunds(
    web: DataFrame, shipments: DataFrame, rates: DataFrame, window_days: int = 30, earliest_only: bool = False
) -> DataFrame:
    flagged = flag_refunds(refunds_with_delivery(web, shipments, earliest_only), window_days)
    return convert_refunds(flagged, rates).select(*REFUND_COLUMNS)


# -- subscriptions -----------------------------------------------------------------------


def subscriptions(subs: DataFrame) -> DataFrame:
    return subs.select(
        "subscription_id",
        F.col("customer_email").alias("customer_key"),
        timefx.parse_utc(F.col("created_at")).alias("subscription_created_at"),
        timefx.parse_utc(F.col("cancelled_at")).alias("cancelled_at"),
        "frequency_days",
        rules.subscription_status().alias("customer_status"),
    )
