"""Data-quality checks: each finds the rows (or counts) that break a rule; none means pass."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import timefx
from ..settings import Settings


@dataclass(frozen=True)
class TableRules:
    """Declared column rules of one table."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)  # column -> (table, column)


_CHANNELS = ("retail", "online_oneoff", "subscription")
_SCORES = (1, 2, 3, 4, 5)

# The declared rules, 8 unique + 22 not null + 11 accepted + 2 parents.
RULES: dict[str, TableRules] = {
    "stg_customers": TableRules(
        unique=("customer_key",),
        not_null=("customer_key", "customer_type"),
        accepted={"customer_type": ("online", "loyalty", "walk_in")},
    ),
    "stg_orders": TableRules(
        unique=("order_id",),
        not_null=("order_id", "customer_key", "channel", "amount_usd"),
        accepted={"channel": _CHANNELS},
        parents={"customer_key": ("stg_customers", "customer_key")},
    ),
    "stg_refunds": TableRules(
        unique=("refund_id",),
        not_null=("refund_id", "order_id", "amount_usd"),
        parents={"order_id": ("stg_orders", "order_id")},
    ),
    "stg_subscriptions": TableRules(
        unique=("subscription_id",),
        not_null=("subscription_id", "customer_status"),
        accepted={
            "customer_status": (
                "is_active",
                "is_paused",
                "is_voluntarily_cancelled",
                "is_payment_failure_cancelled",
            )
        },
    ),
    "fact_weekly_revenue": TableRules(
        not_null=("week_start_date", "channel", "total_revenue"),
        accepted={"channel": _CHANNELS},
    ),
    "fact_customer_health": TableRules(
        unique=("customer_key",),
        not_null=("customer_key", "customer_health", "days_since_last_order"),
        accepted={"customer_health": ("active", "at_risk", "churned")},
    ),
    "fact_customer_rfm": TableRules(
        unique=("customer_key",),
        not_null=("customer_key",),
        accepted={
            "monetary_score": _SCORES,
            "frequency_score": _SCORES,
            "recency_score": _SCORES,
            "tenure_bonus": (0, 1, 2),
        },
    ),
    "fact_subscription_churn": TableRules(
        unique=("customer_key",),
        not_null=("customer_key", "churn_status"),
        accepted={
            "churn_status": ("voluntarily_churned", "involuntarily_churned", "not_churned")
        },
    ),
    "fact_refund_alerts": TableRules(
        unique=("day",),
        not_null=("day", "alert_system"),
        accepted={"alert_system": ("alert", "normal")},
    ),
}

Tables = dict[str, DataFrame]


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _finding(check: str, table: str, column: str) -> list[Column]:
    return [
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
    ]


# -- generic checks ----------------------------------------------------------------------


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Repeated values and how often they occur; NULLs are not compared."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.filter("n > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent. Counted per key first, so a hot key joins as one row."""
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return keys.join(known, column, "left_anti")


def unique_report(tables: Tables) -> DataFrame:
    """Number of repeated values per declared unique column."""
    return _union(
        duplicates(tables[t], c)
        .agg(F.count("*").alias("violations"))
        .select(*_finding("unique", t, c), "violations")
        for t, r in RULES.items()
        if t in tables
        for c in r.unique
    )


def counted_rows(df: DataFrame, table: str, broken: dict[tuple[str, str], Column]) -> DataFrame:
    """Rows breaking each named (check, column) condition, all in one pass over the table."""
    counts = df.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(broken.values())])
    cells = [
        F.struct(*_finding(check, table, column), F.col(f"c{i}").alias("violations"))
        for i, (check, column) in enumerate(broken)
    ]
    return counts.select(F.inline(F.array(*cells)))


def _nulls(rules: TableRules) -> dict[tuple[str, str], Column]:
    return {("not_null", c): F.col(c).isNull() for c in rules.not_null}


def _outside(rules: TableRules) -> dict[tuple[str, str], Column]:
    return {("accepted_values", c): ~F.col(c).isin(*v) for c, v in rules.accepted.items()}


def not_null_report(tables: Tables) -> DataFrame:
    """NULLs per declared column."""
    return _union(
        counted_rows(tables[t], t, _nulls(r))
        for t, r in RULES.items()
        if t in tables and r.not_null
    )


def accepted_report(tables: Tables) -> DataFrame:
    """Every value outside its declared set, with its row count: one pass and shuffle per table."""

    def of(name: str, rules: TableRules) -> DataFrame:
        bad = [
            F.when(broken, F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("bad_value")))
            for (_, c), broken in _outside(rules).items()
        ]
        cells = tables[name].select(F.inline(F.filter(F.array(*bad), lambda cell: cell.isNotNull())))
        counted = cells.groupBy("column_name", "bad_value").agg(F.count("*").alias("violations"))
        head = [F.lit("accepted_values").alias("check_name"), F.lit(name).alias("table_name")]
        return counted.select(*head, "column_name", "bad_value", "violations")

    return _union(of(t, r) for t, r in RULES.items() if t in tables and r.accepted)


def relationship_report(tables: Tables) -> DataFrame:
    """Orphaned rows and distinct orphaned keys per declared parent."""
    return _union(
        orphans(tables[t], c, tables[parent], pc)
        .agg(
            F.count("*").alias("orphan_keys"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("violations"),
        )
        .select(*_finding("relationships", t, c), "orphan_keys", "violations")
        for t, r in RULES.items()
        if t in tables
        for c, (parent, pc) in r.parents.items()
    )


# -- business invariants -----------------------------------------------------------------


def _cad_kept() -> Column:
    return (F.col("currency") == "CAD") & (F.col("amount_usd") == F.col("amount_original"))


def _rfm_total_differs() -> Column:
    parts = ["monetary_score", "frequency_score", "recency_score", "tenure_bonus"]
    return F.col("total_score") != sum((F.col(p) for p in parts[1:]), F.col(parts[0]))


def _before_reference() -> Column:
    return F.col("days_since_last_order") < 0


def unconverted_cad(df: DataFrame) -> DataFrame:
    """CAD rows whose USD amount equals the original: the rate join found nothing."""
    return df.filter(_cad_kept())


def duplicate_active(subscriptions: DataFrame) -> DataFrame:
    active = subscriptions.filter(F.col("customer_status") == "is_active")
    counted = active.groupBy("customer_key").agg(F.count("*").alias("n_active"))
    return counted.filter("n_active > 1")


def negative_recency(health: DataFrame) -> DataFrame:
    return health.filter(_before_reference())


def reactivated_but_churned(subscriptions: DataFrame, churn: DataFrame) -> DataFrame:
    """Customers with a payment-failure row and an active row that are still labelled churned."""
    status = F.col("customer_status")
    reactivated = (
        subscriptions.groupBy("customer_key")
        .agg(
            F.count_if(status == "is_payment_failure_cancelled").alias("failed"),
            F.count_if(status == "is_active").alias("active"),
        )
        .filter("failed > 0 and active > 0")
    )
    lost = churn.filter(F.col("churn_status") != "not_churned")
    return lost.join(reactivated.select("customer_key"), "customer_key").select("customer_key")


def _compared(left: DataFrame, right: DataFrame, broken: Column) -> DataFrame:
    """Two one-row aggregates side by side with a 0/1 verdict."""
    verdict = F.coalesce(broken, F.lit(False)).cast("int").alias("mismatch")
    return left.crossJoin(F.broadcast(right)).select("*", verdict)


def refund_conservation(alerts: DataFrame, refunds: DataFrame) -> DataFrame:
    """The spine must hold every refund."""
    spine = alerts.agg(F.sum("daily_refunds").alias("counted_refunds"))
    truth = refunds.agg(F.count("*").alias("stored_refunds"))
    return _compared(spine, truth, F.col("counted_refunds") != F.col("stored_refunds"))


def revenue_reconciliation(weekly: DataFrame, orders: DataFrame) -> DataFrame:
    """Weekly revenue must add up to the orders within 0.10."""
    facts = weekly.agg(F.sum("total_revenue").alias("weekly_usd"))
    truth = orders.agg(F.sum("amount_usd").alias("orders_usd"))
    gap = F.abs(F.col("weekly_usd") - F.col("orders_usd"))
    return _compared(facts, truth, gap > F.lit("0.10").cast("decimal(3,2)"))


def rfm_sum_broken(rfm: DataFrame) -> DataFrame:
    return rfm.filter(_rfm_total_differs())


def tenure_history_broken(
    rfm: DataFrame, subscriptions: DataFrame, orders: DataFrame, s: Settings
) -> DataFrame:
    """Active subscribers without a bonus although their first signup is old enough.

    Uses the UTC signup day, all orders for the reference day and ``>=`` at the lower bound, so
    a tenure of exactly the lower bound is reported although the score is right.
    """
    history = (
        subscriptions.groupBy("customer_key")
        .agg(
            F.min("subscription_created_at").alias("earliest_signup"),
            F.max(F.col("customer_status") == "is_active").alias("any_active"),
        )
        .filter("any_active")
    )
    local = timefx.utc_to_local(F.col("order_ts_raw"), s.reporting_timezone)
    reference = orders.agg(F.max(local).alias("reference_date"))
    age = timefx.day_diff(F.col("earliest_signup"), F.col("reference_date"))
    return (
        rfm.filter(F.col("tenure_bonus") == 0)
        .join(history, "customer_key")
        .crossJoin(F.broadcast(reference))
        .filter(age >= s.tenure_lower_days)
        .select("customer_key")
    )


# -- one result table --------------------------------------------------------------------


def run_checks(t: Tables, s: Settings) -> DataFrame:
    """All checks over built tables as (check_name, table_name, column_name, violations).

    Everything that looks at single rows shares one pass per table; ``violations`` counts rows
    there, and repeated keys, orphaned rows or failing customers in the others.
    """
    row_invariants = {
        "stg_orders": {("cad_orders", "amount_usd"): _cad_kept()},
        "stg_refunds": {("cad_refunds", "amount_usd"): _cad_kept()},
        "fact_customer_health": {("negative_recency", "days_since_last_order"): _before_reference()},
        "fact_customer_rfm": {("rfm_sum", "total_score"): _rfm_total_differs()},
    }
    row_checks = [
        counted_rows(t[name], name, _nulls(r) | _outside(r) | row_invariants.get(name, {}))
        for name, r in RULES.items()
    ]

    def counted(check: str, table: str, column: str, broken: DataFrame) -> DataFrame:
        found = broken.agg(F.count("*").alias("violations"))
        return found.select(*_finding(check, table, column), "violations")

    orders, refunds, subs = t["stg_orders"], t["stg_refunds"], t["stg_subscriptions"]
    churn, rfm = t["fact_subscription_churn"], t["fact_customer_rfm"]
    alerts, weekly = t["fact_refund_alerts"], t["fact_weekly_revenue"]
    lost = refund_conservation(alerts, refunds).filter("mismatch = 1")
    unbalanced = revenue_reconciliation(weekly, orders).filter("mismatch = 1")
    young = tenure_history_broken(rfm, subs, orders, s)
    others = [
        unique_report(t),
        relationship_report(t).drop("orphan_keys"),
        counted("duplicate_active", "stg_subscriptions", "customer_key", duplicate_active(subs)),
        counted("reactivated", "fact_subscription_churn", "customer_key", reactivated_but_churned(subs, churn)),
        counted("tenure_history", "fact_customer_rfm", "tenure_bonus", young),
        counted("refund_conservation", "fact_refund_alerts", "daily_refunds", lost),
        counted("revenue_reconcile", "fact_weekly_revenue", "total_revenue", unbalanced),
    ]
    return _union([*row_checks, *others])
