"""Business tables over the cleaned ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import rules, timefx
from ..session import materialise
from ..settings import Settings
from .ranking import add_ntiles


# -- weekly revenue ----------------------------------------------------------------------


def weekly_revenue(orders: DataFrame, s: Settings) -> DataFrame:
    local = timefx.utc_to_local(F.col("order_ts_raw"), s.reporting_timezone)
    return (
        orders.groupBy(timefx.week_start(local).alias("week_start_date"), "channel")
        .agg(F.round(F.sum("amount_usd"), 2).alias("total_revenue"))
        .orderBy(F.desc("week_start_date"), "channel")
    )


# -- subscriptions -----------------------------------------------------------------------


def latest_subscription(subscriptions: DataFrame) -> DataFrame:
    """Newest row per customer; equal times go to the higher subscription_id.

    A maximum of structs combines map-side, so a customer with very many rows is no hot spot.
    """
    rest = [
        c
        for c in subscriptions.columns
        if c not in ("customer_key", "subscription_created_at", "subscription_id")
    ]
    newest = F.max(F.struct("subscription_created_at", "subscription_id", *rest)).alias("s")
    return subscriptions.groupBy("customer_key").agg(newest).select("customer_key", "s.*")


def subscription_churn(subscriptions: DataFrame) -> DataFrame:
    return latest_subscription(subscriptions).select(
        "subscription_id",
        "customer_key",
        rules.churn_label(F.col("customer_status")).alias("churn_status"),
    )


def subscriber_first(subscriptions: DataFrame, s: Settings) -> DataFrame:
    """First-ever local signup of customers that have any active subscription."""
    local = timefx.utc_to_local(F.col("subscription_created_at"), s.reporting_timezone)
    return (
        subscriptions.filter(F.col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(
            F.min(local).alias("signed_up_at"),
            F.max(F.col("customer_status") == "is_active").alias("_any_active"),
        )
        .filter("_any_active")
        .drop("_any_active")
    )


def subscriber_tenure(subscriptions: DataFrame, reference: DataFrame, s: Settings) -> DataFrame:
    """``reference`` is one row with ``reference_date``."""
    return (
        subscriber_first(subscriptions, s)
        .crossJoin(F.broadcast(reference))
        .select(
            "customer_key",
            timefx.day_diff(F.col("signed_up_at"), F.col("reference_date")).alias(
                "tenure_days"
            ),
        )
    )


# -- customers ---------------------------------------------------------------------------


def customer_last_order(orders: DataFrame, s: Settings) -> DataFrame:
    local = timefx.utc_to_local(F.col("order_ts_raw"), s.reporting_timezone)
    return orders.groupBy("customer_key").agg(F.max(local).alias("last_order_date"))


def customer_health(orders: DataFrame, customers: DataFrame, s: Settings) -> DataFrame:
    """Walk-ins count for the reference day but get no label.

    The reference is taken from the same sums per customer. The join key is never NULL, so the join
    adds no filter of its own and both uses read one scan and one shuffle of the orders.
    """
    last = customer_last_order(orders, s)
    reference = last.agg(F.max("last_order_date").alias("reference_date"))
    known = customers.filter(F.col("customer_type").isin(*rules.IDENTIFIED))
    known = known.select(F.col("customer_key").alias("_known"), "customer_type")
    days = F.col("days_since_last_order")
    nobody = F.lit("\0")  # a row without a key matches nothing
    return (
        last.join(known.filter("_known is not null"), F.coalesce("customer_key", nobody) == F.coalesce("_known", nobody))
        .crossJoin(F.broadcast(reference))
        .withColumn(
            "days_since_last_order",
            timefx.day_diff(F.col("last_order_date"), F.col("reference_date")),
        )
        .select(
            "customer_key",
            "customer_type",
            "last_order_date",
            "days_since_last_order",
            rules.health_label(days, s.at_risk_after_days, s.churned_after_days).alias(
                "customer_health"
            ),
        )
    )


def rfm_base(orders: DataFrame, customers: DataFrame, s: Settings) -> DataFrame:
    """Spend, last order and order count per identified customer, summed before the join."""
    local = timefx.utc_to_local(F.col("order_ts_raw"), s.reporting_timezone)
    totals = orders.groupBy("customer_key").agg(
        F.round(F.sum("amount_usd"), 2).alias("spend_usd"),
        F.max(local).alias("newest_order_at"),
        F.count("customer_key").alias("n_orders"),
    )
    known = customers.filter(F.col("customer_type").isin(*rules.IDENTIFIED))
    return totals.join(known.select("customer_key", "customer_type"), "customer_key").select(
        "customer_key", "customer_type", "spend_usd", "newest_order_at", "n_orders"
    )


def reference_day(base: DataFrame) -> DataFrame:
    return base.agg(F.max("newest_order_at").alias("reference_date"))


def rfm_quintiles(base: DataFrame) -> DataFrame:
    """Scores 1-5 on spend, count and recency; ties are ranked by customer_key and type."""
    tie = ["customer_key", "customer_type"]
    orders = {
        "monetary_score": ["spend_usd", *tie],
        "frequency_score": ["n_orders", *tie],
        "recency_score": ["newest_order_at", *tie],
    }
    return add_ntiles(base, 5, orders)


def customer_rfm(
    orders: DataFrame, customers: DataFrame, subscriptions: DataFrame, s: Settings
) -> DataFrame:
    base = materialise(rfm_base(orders, customers, s))
    tenure = subscriber_tenure(subscriptions, reference_day(base), s)
    parts = ["monetary_score", "frequency_score", "recency_score", "tenure_bonus"]
    bonus = rules.tenure_bonus(F.col("tenure_days"), s.tenure_lower_days, s.tenure_upper_days)
    total: Column = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return (
        rfm_quintiles(base)
        .join(tenure, "customer_key", "left")
        .withColumn("tenure_bonus", bonus)
        .select("customer_key", *parts, total.alias("total_score"))
        .orderBy(F.desc("total_score"), "customer_key")
    )


# -- refund alerts -----------------------------------------------------------------------


def local_days(df: DataFrame, ts: str, s: Settings) -> DataFrame:
    return df.select(F.to_date(timefx.utc_to_local(F.col(ts), s.reporting_timezone)).alias("day"))


def activity_dates(orders: DataFrame, refunds: DataFrame, s: Settings) -> DataFrame:
    """Local days with an order or a refund; each side is reduced before the union's shuffle."""
    both = local_days(orders, "order_ts_raw", s).union(local_days(refunds, "refund_ts", s))
    return both.distinct()


def daily_counts(orders: DataFrame, refunds: DataFrame, s: Settings) -> DataFrame:
    """Orders and refunds per active local day; rows without a time stay under a NULL day."""
    events = (
        local_days(orders, "order_ts_raw", s)
        .select("day", F.lit(1).alias("o"), F.lit(0).alias("r"))
        .union(
            local_days(refunds, "refund_ts", s).select(
                "day", F.lit(0).alias("o"), F.lit(1).alias("r")
            )
        )
    )
    return events.groupBy("day").agg(
        F.sum("o").alias("daily_orders"), F.sum("r").alias("daily_refunds")
    )


def fill_calendar(daily: DataFrame) -> DataFrame:
    """Insert the quiet days as zeros. One row per day, so the ordered window stays small."""
    following = F.lead("day").over(Window.orderBy("day"))
    last_quiet = F.coalesce(F.date_sub(F.col("_next"), 1), F.col("day"))
    rest = [c for c in daily.columns if c not in ("day", "daily_orders", "daily_refunds")]
    first = F.col("_day") == F.col("day")
    return (
        daily.filter(F.col("day").isNotNull())
        .withColumn("_next", following)
        .withColumn("_day", timefx.date_spine(F.col("day"), last_quiet))
        .select(
            F.col("_day").alias("day"),
            F.when(first, F.col("daily_orders")).otherwise(0).alias("daily_orders"),
            F.when(first, F.col("daily_refunds")).otherwise(0).alias("daily_refunds"),
            *rest,
        )
    )


def daily_order_refund(orders: DataFrame, refunds: DataFrame, s: Settings) -> DataFrame:
    return fill_calendar(daily_counts(orders, refunds, s))


def calendar_spine(orders: DataFrame, refunds: DataFrame, s: Settings) -> DataFrame:
    """Every day from the first to the last active one."""
    return daily_order_refund(orders, refunds, s).select("day")


def baseline_rate(refunds: Column, orders: Column) -> Column:
    """Percent of all orders that were refunded; rows without a time count too."""
    return F.try_divide(refunds * F.lit(100.0), orders)


def refund_baseline(orders: DataFrame, refunds: DataFrame, s: Settings) -> DataFrame:
    rate = baseline_rate(F.sum("daily_refunds"), F.sum("daily_orders"))
    return daily_counts(orders, refunds, s).agg(rate.alias("baseline_rate"))


def rolling(daily: DataFrame, s: Settings) -> DataFrame:
    """Trailing sums; rows equal calendar days because the days are gap-free."""
    trailing = Window.orderBy("day").rowsBetween(1 - s.rolling_days, 0)
    return daily.withColumns(
        {
            "orders_rolling": F.sum("daily_orders").over(trailing),
            "refunds_rolling": F.sum("daily_refunds").over(trailing),
        }
    )


def refund_rolling(orders: DataFrame, refunds: DataFrame, s: Settings) -> DataFrame:
    return rolling(daily_order_refund(orders, refunds, s), s)


def rolling_rate() -> Column:
    """Percent to 2 places, half up, in whole numbers; NULL without orders."""
    hundredths = F.expr("(refunds_rolling * 20000 + orders_rolling) div (orders_rolling * 2)")
    return F.when(F.col("orders_rolling") > 0, hundredths.cast("double") / 100.0)


def refund_alerts(orders: DataFrame, refunds: DataFrame, s: Settings) -> DataFrame:
    """Orders and refunds are each read once; everything after that is one row per day."""
    total = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    baseline = baseline_rate(F.sum("daily_refunds").over(total), F.sum("daily_orders").over(total))
    daily = daily_counts(orders, refunds, s).withColumn("baseline_rate", baseline)
    alarming = F.col("refund_rate_pct") > F.col("baseline_rate") * s.alert_multiplier
    return (
        rolling(fill_calendar(daily), s)
        .withColumn("refund_rate_pct", rolling_rate())
        .select(
            "day",
            "daily_orders",
            "daily_refunds",
            "orders_rolling",
            "refunds_rolling",
            "refund_rate_pct",
            "baseline_rate",
            F.when(alarming, "alert").otherwise("normal").alias("alert_system"),
        )
    )
