"""Each check fires on a planted fault and stays silent on good rows."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from cornermart.operators import gold, quality
from cornermart.settings import Settings

S = Settings()


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_declared_checks_are_counted():
    r = quality.RULES.values()
    counts = [sum(len(getattr(x, f)) for x in r) for f in ("unique", "not_null", "accepted", "parents")]
    assert counts == [8, 22, 11, 2]


def test_duplicates_ignore_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(quality.duplicates(df, "k"), "k", "n") == [("a", 2)]


def test_values_outside_their_set_ignore_nulls(spark):
    df = spark.createDataFrame([("retail",), ("x",), ("x",), ("y",), (None,)], "channel string")
    found = quality.accepted_report({"stg_orders": df})
    assert rows(found, "table_name", "column_name", "bad_value", "violations") == [
        ("stg_orders", "channel", "x", 2), ("stg_orders", "channel", "y", 1)
    ]


def test_orphans_of_a_hot_key_join_as_one_row(spark):
    child = spark.range(300).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("ok").alias("k"))
    child = child.union(spark.createDataFrame([(None,)], "k string"))
    parent = spark.createDataFrame([("ok",), ("ok",)], "p string")
    assert rows(quality.orphans(child, "k", parent, "p"), "k", "n") == [("hot", 100)]


def test_counted_rows_is_one_pass(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    got = quality.counted_rows(
        df, "t", {("not_null", "k"): F.col("k").isNull(), ("big", "v"): F.col("v") > 1}
    )
    assert rows(got, "check_name", "column_name", "violations") == [("big", "v", 1), ("not_null", "k", 1)]


def test_unconverted_cad(spark):
    data = [("CAD", Decimal(5), Decimal(5)), ("CAD", Decimal(5), Decimal(4)), ("USD", Decimal(5), Decimal(5))]
    df = spark.createDataFrame(data, "currency string, amount_original decimal(10,2), amount_usd decimal(10,2)")
    assert quality.unconverted_cad(df).count() == 1


def subs(spark, *data):
    return spark.createDataFrame(
        [(f"RC-{i}", k, t, s) for i, (k, t, s) in enumerate(data)],
        "subscription_id string, customer_key string, subscription_created_at timestamp_ntz, customer_status string",
    )


def test_reactivated_within_two_days_is_not_churned(spark):
    df = subs(
        spark,
        ("a", datetime(2026, 8, 8, 10), "is_payment_failure_cancelled"),
        ("a", datetime(2026, 8, 10, 9), "is_active"),
        ("b", datetime(2026, 8, 10), "is_payment_failure_cancelled"),
        ("b", datetime(2026, 8, 1), "is_active"),
    )
    churn = gold.subscription_churn(df)
    assert rows(churn, "customer_key", "churn_status") == [("a", "not_churned"), ("b", "involuntarily_churned")]
    assert rows(quality.reactivated_but_churned(df, churn), "customer_key") == [("b",)]


def test_duplicate_active(spark):
    t = datetime(2026, 8, 1)
    df = subs(spark, ("a", t, "is_active"), ("a", t, "is_active"), ("b", t, "is_active"), ("b", t, "is_paused"))
    assert rows(quality.duplicate_active(df), "customer_key", "n_active") == [("a", 2)]


def test_tenure_uses_the_first_signup(spark):
    df = subs(
        spark,
        ("a", datetime(2026, 1, 1), "is_payment_failure_cancelled"),
        ("a", datetime(2026, 7, 30), "is_active"),
        ("c", datetime(2026, 1, 1), "is_paused"),
    )
    reference = spark.createDataFrame([(datetime(2026, 8, 1),)], "reference_date timestamp_ntz")
    got = gold.subscriber_tenure(df, reference, S)
    assert rows(got, "customer_key", "tenure_days") == [("a", 213)]  # local first day is Dec 31


def test_tenure_check_reports_the_lower_bound(spark):
    df = subs(spark, ("a", datetime(2026, 5, 3, 12), "is_active"), ("b", datetime(2026, 7, 1), "is_active"))
    orders = spark.createDataFrame([(datetime(2026, 8, 1, 16),)], "order_ts_raw timestamp_ntz")
    rfm = spark.createDataFrame([("a", 0), ("b", 0)], "customer_key string, tenure_bonus int")
    assert rows(quality.tenure_history_broken(rfm, df, orders, S), "customer_key") == [("a",)]


def test_rfm_sum(spark):
    columns = "monetary_score int, frequency_score int, recency_score int, tenure_bonus int, total_score int"
    df = spark.createDataFrame([(1, 2, 3, 1, 7), (1, 2, 3, 1, 8)], columns)
    assert quality.rfm_sum_broken(df).count() == 1


def test_revenue_tolerance(spark):
    weekly = spark.createDataFrame([(Decimal("100.10"),)], "total_revenue decimal(12,2)")
    for silver, mismatch in (("100.00", 0), ("99.99", 1), ("100.21", 1)):
        orders = spark.createDataFrame([(Decimal(silver),)], "amount_usd decimal(12,2)")
        assert quality.revenue_reconciliation(weekly, orders).first().mismatch == mismatch


# -- refund alerts -----------------------------------------------------------------------


def events(spark, column, counts):
    data = [(datetime(2026, 8, day, 16),) for day, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(data, f"{column} timestamp_ntz")


def test_alerts_over_a_gap_free_calendar(spark):
    orders = events(spark, "order_ts_raw", {1: 50, 2: 30, 12: 20})
    refunds = events(spark, "refund_ts", {2: 1, 12: 6, 14: 1})
    got = {r.day.day: r for r in gold.refund_alerts(orders, refunds, S).collect()}
    assert sorted(got) == list(range(1, 15))
    assert got[1].daily_refunds == 0 and got[3].daily_orders == 0
    assert got[2].orders_rolling == 80 and got[2].refund_rate_pct == 1.25
    assert got[8].orders_rolling == 30  # day 1 left the window, day 2 is still in it
    assert got[9].orders_rolling == 0 and got[9].refund_rate_pct is None and got[9].alert_system == "normal"
    assert got[12].refund_rate_pct == 30.0 and got[12].alert_system == "alert"
    assert got[2].baseline_rate == 8.0 and got[2].alert_system == "normal"
    assert quality.refund_conservation(gold.refund_alerts(orders, refunds, S), refunds).first().mismatch == 0


def test_refund_without_time_is_reported_lost(spark):
    orders = events(spark, "order_ts_raw", {1: 2})
    refunds = events(spark, "refund_ts", {1: 1}).union(spark.createDataFrame([(None,)], "r timestamp_ntz"))
    alerts = gold.refund_alerts(orders, refunds, S)
    assert alerts.first().baseline_rate == 100.0  # both refunds count for the baseline
    check = quality.refund_conservation(alerts, refunds).first()
    assert (check.counted_refunds, check.stored_refunds, check.mismatch) == (1, 2, 1)


def test_health_reference_includes_walk_ins(spark):
    orders = spark.createDataFrame(
        [("a", datetime(2026, 6, 1, 16)), ("w", datetime(2026, 8, 1, 16)), ("l", datetime(2026, 6, 17, 16))],
        "customer_key string, order_ts_raw timestamp_ntz",
    )
    customers = spark.createDataFrame(
        [("a", "online", date(2026, 6, 1)), ("w", "walk_in", date(2026, 8, 1)), ("l", "loyalty", date(2026, 6, 1))],
        "customer_key string, customer_type string, first_seen_run_date date",
    )
    got = gold.customer_health(orders, customers, S)
    assert rows(got, "customer_key", "days_since_last_order", "customer_health") == [("a", 61, "churned"), ("l", 45, "at_risk")]
    assert quality.negative_recency(got).count() == 0
