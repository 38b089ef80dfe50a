import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

import deliveries as d
from cornermart import __main__ as main
from cornermart.operators import gold, ranking, silver
from cornermart.settings import Settings


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 1003])
def test_tiles_equal_ntile(spark, n):
    rng = random.Random(n)
    rows = [
        (f"c{i:05d}", rng.choice([1, 1, 1, 2, None]), rng.random(), datetime(2026, 1, 1) + timedelta(microseconds=rng.randrange(10**12)))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "k string, few int, many double, at timestamp_ntz").repartition(5)
    orders = {"a": ["few", "k"], "b": ["many", "k"], "c": ["at", "k"]}
    got = ranking.add_ntiles(df, 5, orders)
    want = df
    for name, order in orders.items():
        want = want.withColumn(name, F.ntile(5).over(Window.orderBy(*[F.asc_nulls_last(c) for c in order])))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_tiles_of_more_rows_than_the_driver_sorts(spark, monkeypatch):
    """Brackets are narrowed over several rounds, with hot values, NULLs, NaN and repeated rows."""
    monkeypatch.setattr(ranking, "FEW", 200)
    df = spark.range(20_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("k"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 11).cast("int").alias("few"),
        F.when(F.col("id") % 5 == 0, float("nan")).otherwise(F.rand(3)).alias("many"),
    )
    df = spark.createDataFrame(df.collect(), df.schema).repartition(6)
    orders = {"a": ["few", "k"], "b": ["many", "k"]}
    got = ranking.add_ntiles(df, 5, orders)
    want = df
    for name, order in orders.items():
        want = want.withColumn(name, F.ntile(5).over(Window.orderBy(*[F.asc_nulls_last(c) for c in order])))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))  # NaN equals nothing
    # among equal rows the cut is the value that the wanted rank has
    ranked = sorted(r.few for r in df.filter("few is not null").collect())
    found = ranking.cuts(df.filter("few is not null"), len(ranked), 5, ["few"])
    assert [v for (v,) in found] == [ranked[end - 1] for end in ranking.tile_ends(len(ranked), 5)]


def test_tiles_need_no_one_task_window(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("v"))
    plan = ranking.add_ntiles(df, 5, {"t": ["v", "k"]})._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan and "Join" not in plan


def test_health_reads_orders_once(spark, tmp_path):
    rows = [("a", datetime(2026, 8, 1)), ("b", datetime(2026, 6, 20)), (None, datetime(2026, 8, 20)), ("w", datetime(2026, 8, 5))]
    spark.createDataFrame(rows, "customer_key string, order_ts_raw timestamp_ntz").write.parquet(str(tmp_path / "o"))
    orders = spark.read.parquet(str(tmp_path / "o"))
    customers = spark.createDataFrame([("a", "online"), ("b", "loyalty"), ("w", "walk_in")], "customer_key string, customer_type string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        health = gold.customer_health(orders, customers, Settings())
        got = {r.customer_key: r.days_since_last_order for r in health.collect()}
        plan = health._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {"a": 19, "b": 61}  # the reference is 2026-08-19 local, from the order without a customer
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_hot_order_keeps_every_refund_and_delivery(spark):
    """One order holds a third of the refunds and many deliveries: the result is still complete."""
    refund = F.struct(
        F.concat(F.lit("R"), F.col("id")).alias("refund_id"),
        F.lit(Decimal("1.0000")).cast("decimal(18,4)").alias("amount"),
        F.lit("2026-08-09T00:00:00+00:00").alias("created_at"),
        F.lit("x").alias("reason"),
    )
    order = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    web = spark.range(300).select(
        order.alias("order_id"),
        F.lit("a@x").alias("customer_email"),
        F.lit("USD").alias("currency"),
        F.lit("2026-08-01T00:00:00+00:00").alias("created_at"),
        F.lit("2026-08-01").cast("date").alias("_run_date"),
        F.array(refund).alias("refunds"),
    )
    ship = spark.range(40).select(
        F.lit("hot").alias("shopify_order_id"),
        F.lit("delivered").alias("status"),
        F.lit("2026-08-05T00:00:00+00:00").alias("last_scan_at"),
    )
    got = silver.refunds_with_delivery(web, ship)
    assert got.filter("order_id = 'hot'").count() == 100 * 40
    assert got.filter("delivered_at is null").count() == 200  # incl. refunds without an order
    assert got.filter("order_id is null").count() == 100


def test_latest_subscription_breaks_ties_by_id(spark):
    t = datetime(2026, 8, 1)
    rows = [("RC-1", "a", t, "is_active"), ("RC-2", "a", t, "is_paused"), ("RC-0", "a", None, "x")]
    df = spark.createDataFrame(
        rows, "subscription_id string, customer_key string, subscription_created_at timestamp_ntz, customer_status string"
    )
    assert gold.latest_subscription(df).first().subscription_id == "RC-2"


def test_store_rollup_shuffles_partial_sums(spark):
    """A ticket with a third of all lines reaches the shuffle as partial sums only."""
    pos = spark.range(100).select(
        F.lit("T").alias("transaction_id"), F.lit("STORE-01").alias("location_id"),
        F.lit("2").alias("qty"), F.lit("1.25").alias("unit_price"), F.lit("0.50").alias("discount"),
        F.lit("2026-08-03T09:00:00").alias("created_at_local"),
        F.lit(None).cast("string").alias("customer_phone"),
        F.lit("2026-08-03").cast("date").alias("_run_date"),
    )
    rolled = silver.store_orders(pos)
    assert rolled.first().amount_original == Decimal("200.00000000")
    assert "partial_sum" in rolled._jdf.queryExecution().executedPlan().toString()


def test_ticket_totals_stand_for_the_lines(spark):
    """Stored totals give the customers and orders of the lines, so the lines are read once."""
    lines = [
        ("T1", "S1", "555", "2026-08-01T09:00:00", "1", "2.50", "0.5", datetime(2026, 8, 2)),
        ("T1", "S1", "555", "2026-08-01T09:00:00", "2", "1.25", "0", datetime(2026, 8, 1)),
        ("T2", "S1", None, "2026-08-01T23:00:00", "1", "7", "0", datetime(2026, 8, 1)),
        ("T2", "S2", None, "2026-08-01T23:00:00", None, "7", "0", datetime(2026, 8, 3)),
        (None, "S2", "556", None, "3", "7", "1", None),
        (None, None, None, "2026-08-04T01:00:00", "3", "7", "1", datetime(2026, 8, 4)),
    ]
    names = "transaction_id string, location_id string, customer_phone string, created_at_local string, qty string, unit_price string, discount string, day timestamp"
    pos = spark.createDataFrame(lines, names).withColumn("_run_date", F.to_date("day"))
    web = spark.createDataFrame(
        [("#1", "a@x", datetime(2026, 8, 1))], "order_id string, customer_email string, day timestamp"
    ).selectExpr(
        "order_id", "customer_email", "'2026-08-01T10:00:00-04:00' as created_at", "'USD' as currency", "1.5 as total_price",
        "'web' as source_name", "cast(null as string) as cancelled_at", "to_date(day) as _run_date",
    )
    zones = spark.sql("select * from values ('S1', 'America/Chicago'), ('S2', 'America/New_York') as z(location_id, timezone_name)")
    rates = spark.sql("select 'USD' as currency, date'2026-08-01' as currency_date, cast(1 as decimal(10,6)) as rate_to_usd")
    totals = silver.ticket_totals(pos)

    def rows(df):
        return sorted(map(repr, df.collect()))

    assert rows(silver.customers(web, totals)) == rows(silver.customers(web, pos))
    assert rows(silver.orders(web, pos, zones, rates, totals)) == rows(silver.orders(web, pos, zones, rates))
    assert totals.count() == 5


def test_stored_shop_reads_the_lines_once(spark, testdata, tmp_path):
    from cornermart.testbed import views

    shop = views.Shop(spark, f"{testdata}/sf0.001").store("sales", "stg_customers", "stg_orders")
    plain = views.Shop(spark, f"{testdata}/sf0.001")
    assert "sales" not in plain.__dict__
    for name in ("stg_customers", "stg_orders"):
        stored, lazy = getattr(shop, name), getattr(plain, name)
        assert stored.count() == lazy.count() and stored.exceptAll(lazy).isEmpty()
    assert "lineitem" not in " ".join(shop.sales.inputFiles())


def test_settings_schema_names():
    s = Settings(root="/lake", default_schema="main")
    assert s.schema_for(None) == "main" and s.schema_for(" gold ") == "gold"
    assert s.path("gold", "t") == "/lake/gold/t"


def test_hot_join_key_is_split_at_run_time(spark, tmp_path):
    """A third of the refunds belong to one order: the join reads that order in several tasks."""
    refund = F.struct(
        F.concat(F.lit("R"), F.col("id")).alias("refund_id"), F.lit(1).cast("decimal(18,4)").alias("amount"),
        F.lit("2026-08-09T00:00:00+00:00").alias("created_at"), F.sha2(F.col("id").cast("string"), 512).alias("reason"),
    )
    order = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    spark.range(0, 60_000, 1, 8).select(
        order.alias("order_id"), F.sha2(F.col("id").cast("string"), 256).alias("customer_email"),
        F.lit("USD").alias("currency"), F.lit("2026-08-01T00:00:00+00:00").alias("created_at"),
        F.lit("2026-08-01").cast("date").alias("_run_date"), F.array(refund).alias("refunds"),
    ).write.parquet(str(tmp_path / "web"))
    spark.range(60_000).select(
        order.alias("shopify_order_id"), F.lit("delivered").alias("status"),
        F.lit("2026-08-05T00:00:00+00:00").alias("last_scan_at"),
    ).dropDuplicates(["shopify_order_id"]).write.parquet(str(tmp_path / "ship"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "300k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        web, ship = (spark.read.parquet(str(tmp_path / n)) for n in ("web", "ship"))
        got = silver.refunds_with_delivery(web, ship)
        assert len(got.select("refund_id", "reason", "customer_key", "delivered_at").collect()) == 60_000
        rows = got.collect()
        assert len(rows) == 60_000 and all(r.delivered_at for r in rows)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "ReusedExchange" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_earliest_delivery_option(spark):
    refund = d.refund("R", 1, "2026-08-09T00:00:00+00:00")
    web = spark.createDataFrame(
        [("#1", "a", "USD", "2026-08-01T00:00:00+00:00", [tuple(refund.values())])],
        "order_id string, customer_email string, currency string, created_at string,"
        " refunds array<struct<refund_id string, amount int, created_at string, reason string>>",
    ).withColumn("_run_date", F.lit("2026-08-01").cast("date"))
    ship = spark.createDataFrame(
        [("#1", "delivered", "2026-08-05T00:00:00+00:00"), ("#1", "delivered", "2026-08-07T00:00:00+00:00")],
        "shopify_order_id string, status string, last_scan_at string",
    )
    both = silver.refunds_with_delivery(web, ship)
    assert sorted(r.days_since_delivery for r in both.collect()) == [2, 4]
    one = silver.refunds_with_delivery(web, ship, earliest_only=True)
    assert [r.days_since_delivery for r in one.collect()] == [4]


def test_job_arguments():
    a = main.arguments(["backfill", "--root", "/l", "--raw", "/r", "--date", "2026-08-30", "--until", "2026-09-02"])
    assert len(main.days_of(a.date, a.until)) == 4
    with pytest.raises(SystemExit):
        main.arguments(["day", "--root", "/l", "--raw", "/r", "--date", "nonsense"])
