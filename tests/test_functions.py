from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cornermart.functions import rules, timefx


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first().x


def test_offset_text_becomes_naive_utc(spark):
    got = one(spark, timefx.parse_utc(F.col("t")), t="2026-08-03T21:30:00-04:00")
    assert got == datetime(2026, 8, 4, 1, 30)
    assert one(spark, timefx.utc_date(F.col("t")), t="2026-08-03T21:30:00-04:00") == date(2026, 8, 4)


def test_store_wall_clock_becomes_utc(spark):
    c = timefx.naive_to_utc(F.col("t"), F.col("z"))
    assert one(spark, c, t="2026-01-05T09:00:00", z="America/Chicago") == datetime(2026, 1, 5, 15)
    assert one(spark, c, t="2026-07-05T09:00:00", z="America/Chicago") == datetime(2026, 7, 5, 14)


def test_monday_after_midnight_utc_is_previous_local_week(spark):
    ts = F.col("t").cast("timestamp_ntz")
    local = timefx.utc_to_local(ts, "America/New_York")
    assert one(spark, timefx.week_start(local), t="2026-08-03T00:30:00") == date(2026, 7, 27)
    assert one(spark, timefx.week_start(ts), t="2026-08-03T00:30:00") == date(2026, 8, 3)


def test_local_clock_equals_convert_timezone_and_looks_the_zone_up_once(spark):
    base = F.lit("1989-12-30 00:30:00").cast("timestamp_ntz")
    ts = spark.range(0, 24 * 366 * 3, 1, 4).select((base + F.make_dt_interval(F.lit(0), F.col("id"))).alias("ts"))
    more = ["1800-01-01 00:00:00.000001", "1999-10-31 05:59:59.999999", "1999-10-31 06:00:00", "2500-07-01 12:00:00", None]
    ts = ts.union(spark.createDataFrame([(t,) for t in more], "t string").select(F.col("t").cast("timestamp_ntz")))
    zone = "America/New_York"
    local = ts.select("ts", timefx.utc_to_local(F.col("ts"), zone).alias("local"))
    wanted = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("ts"))
    assert local.filter(~F.col("local").eqNullSafe(wanted)).count() == 0
    assert local.schema["local"].dataType.simpleString() == "timestamp_ntz"
    assert "convert_timezone" not in local._jdf.queryExecution().optimizedPlan().toString()


def test_local_date_applies_no_zone(spark):
    assert one(spark, timefx.local_date(F.col("t")), t="2026-08-03T23:59:00") == date(2026, 8, 3)


def test_day_diff_counts_boundaries(spark):
    c = timefx.day_diff(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"))
    assert one(spark, c, a="2026-08-03T23:59:00", b="2026-08-04T00:01:00") == 1
    assert one(spark, c, a="2026-08-04T00:01:00", b="2026-08-03T23:59:00") == -1


def test_spine_is_inclusive(spark):
    spine = timefx.date_spine(F.lit("2026-02-27").cast("date"), F.lit("2026-03-01").cast("date"))
    days = [r.x for r in spark.range(1).select(spine.alias("x")).collect()]
    assert days == [date(2026, 2, 27), date(2026, 2, 28), date(2026, 3, 1)]


@pytest.mark.parametrize(
    "days, within, before",
    [(-1, True, True), (0, True, False), (30, True, False), (31, False, False)],
)
def test_refund_policy_edges(spark, days, within, before):
    delivered = F.lit("2026-08-01").cast("timestamp_ntz")
    assert one(spark, rules.within_policy(F.col("d"), delivered, 30), d=days) is within
    assert one(spark, rules.before_delivery(F.col("d"), delivered), d=days) is before


def test_refund_policy_is_unknown_without_delivery(spark):
    none = F.lit(None).cast("timestamp_ntz")
    assert one(spark, rules.within_policy(F.lit(None).cast("int"), none, 30), d=1) is None
    assert one(spark, rules.before_delivery(F.lit(None).cast("int"), none), d=1) is None


@pytest.mark.parametrize("days, bonus", [(89, 0), (90, 0), (91, 1), (129, 1), (130, 2), (None, 0)])
def test_tenure_edges(spark, days, bonus):
    assert one(spark, rules.tenure_bonus(F.col("d").cast("int"), 90, 130), d=days) == bonus


@pytest.mark.parametrize(
    "days, label", [(44, "active"), (45, "at_risk"), (59, "at_risk"), (60, "churned")]
)
def test_health_edges(spark, days, label):
    assert one(spark, rules.health_label(F.col("d"), 45, 60), d=days) == label


@pytest.mark.parametrize(
    "status, reason, expected, churn",
    [
        ("active", None, "is_active", "not_churned"),
        ("paused", None, "is_paused", "not_churned"),
        ("cancelled", "customer_cancelled", "is_voluntarily_cancelled", "voluntarily_churned"),
        ("cancelled", "payment_failed_max_retries", "is_payment_failure_cancelled", "involuntarily_churned"),
        ("cancelled", None, "unknown_status", "unmapped_status"),
        ("expired", None, "unknown_status", "unmapped_status"),
        ("Active", None, "unknown_status", "unmapped_status"),
        (None, None, "unknown_status", "unmapped_status"),
    ],
)
def test_subscription_classes(spark, status, reason, expected, churn):
    df = spark.createDataFrame([(status, reason)], "status string, cancellation_reason string")
    row = df.select(rules.subscription_status().alias("s")).select(
        "s", rules.churn_label(F.col("s")).alias("c")
    )
    assert row.first() == (expected, churn)
