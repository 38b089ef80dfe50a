"""Business classifications as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import timefx

# Labels downstream consumers filter on.
ONLINE, LOYALTY, WALK_IN = "online", "loyalty", "walk_in"
RETAIL, ONE_OFF, SUBSCRIPTION = "retail", "online_oneoff", "subscription"
IDENTIFIED = (ONLINE, LOYALTY)

MONEY = "decimal(26,8)"  # times a decimal(10,6) rate stays exact in 38 digits
RATE = "decimal(10,6)"


def store_customer_key() -> Column:
    """Phone when known, else one synthetic customer per store and local day."""
    day = timefx.local_date(F.col("created_at_local")).cast("string")
    return F.coalesce(F.col("customer_phone"), F.concat("location_id", F.lit("_"), day))


def store_customer_type() -> Column:
    return F.when(F.col("customer_phone").isNull(), WALK_IN).otherwise(LOYALTY)


def line_amount() -> Column:
    qty = F.col("qty").cast("decimal(12,4)")
    price = F.col("unit_price").cast("decimal(18,4)")
    return qty * price - F.col("discount").cast("decimal(18,4)")


def online_channel() -> Column:
    return F.when(F.col("source_name") == "recharge", SUBSCRIPTION).otherwise(ONE_OFF)


def subscription_status() -> Column:
    status, reason = F.col("status"), F.col("cancellation_reason")
    cancelled = status == "cancelled"
    return (
        F.when(status == "active", "is_active")
        .when(status == "paused", "is_paused")
        .when(cancelled & (reason == "customer_cancelled"), "is_voluntarily_cancelled")
        .when(cancelled & (reason == "payment_failed_max_retries"), "is_payment_failure_cancelled")
        .otherwise("unknown_status")
    )


def churn_label(status: Column) -> Column:
    return (
        F.when(status.isin("is_active", "is_paused"), "not_churned")
        .when(status == "is_voluntarily_cancelled", "voluntarily_churned")
        .when(status == "is_payment_failure_cancelled", "involuntarily_churned")
        .otherwise("unmapped_status")
    )


def health_label(days: Column, at_risk_after: int, churned_after: int) -> Column:
    return (
        F.when(days >= churned_after, "churned")
        .when(days >= at_risk_after, "at_risk")
        .otherwise("active")
    )


def tenure_bonus(days: Column, lower: int, upper: int) -> Column:
    """2 from ``upper`` days on, 1 strictly between the bounds, else 0 (also when unknown)."""
    return F.when(days >= upper, 2).when(days > lower, 1).otherwise(0)


def within_policy(days: Column, delivered_at: Column, window: int) -> Column:
    """NULL while the delivery is unknown; a refund before delivery counts as inside."""
    return F.when(delivered_at.isNotNull(), F.coalesce(days <= window, F.lit(False)))


def before_delivery(days: Column, delivered_at: Column) -> Column:
    return F.when(delivered_at.isNotNull(), F.coalesce(days < 0, F.lit(False)))
