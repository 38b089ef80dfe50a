"""End-to-end: any split of days, late deliveries, replays and re-deliveries agree with a full refresh."""

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

import deliveries as d
from cornermart import __main__ as main
from cornermart.contracts import SOURCES
from cornermart.plans import daily_build, incremental
from cornermart.settings import Settings
from cornermart.sources import bronze, fs, tables
from cornermart.streaming import arrivals

D3, D4, D5 = (date(2026, 8, n) for n in (3, 4, 5))
CAD = {"currency": "CAD"}


def write_all(raw: Path) -> None:
    d.write_day(
        raw, "2026-08-03",
        [
            d.web("#1", refunds=[d.refund("R1", 2.5, "2026-08-06T10:00:00-04:00")]),
            d.web("#2", customer_email="b@x.com", source_name="recharge", **CAD),
            d.web("#3", customer_email="c@x.com", cancelled_at="2026-08-03T12:00:00-04:00"),
        ],
        [
            d.pos("T1"), d.pos("T1", qty="2", discount="1.00"),
            d.pos("T2", customer_phone="555-1"), d.pos("T3", location_id="STORE-99"),
        ],
        [d.sub("RC-1")],
        [d.ship("S0", "#2")],
        [d.ticket("Z1")],
    )
    d.write_day(
        raw, "2026-08-04",
        [d.web("#4", created_at="2026-08-04T23:30:00-04:00"), d.web("#5", customer_email="d@x.com")],
        [d.pos("T4", created_at_local="2026-08-04T18:00:00"), d.pos("T5", customer_phone="555-1")],
        [d.sub("RC-1", status="cancelled", cancellation_reason="payment_failed_max_retries"), d.sub("RC-2", created_at="2026-08-04T09:00:00-04:00")],
        [d.ship("S1", "#1", last_scan_at="2026-08-04T12:00:00-04:00")],  # after its refund was stored
    )
    d.write_day(
        raw, "2026-08-05",
        [d.web("#6", customer_email="e@x.com", refunds=[d.refund("R6a", 1, "2026-08-05T10:00:00-04:00"), d.refund("R6b", 2, "2026-08-07T10:00:00-04:00")])],
        [d.pos("T6", location_id="STORE-02", created_at_local="2026-08-05T10:00:00")],
        [d.sub("RC-1", status="cancelled", cancellation_reason="payment_failed_max_retries"), d.sub("RC-2", created_at="2026-08-04T09:00:00-04:00"), d.sub("RC-3", customer_email="d@x.com", status="expired")],
        [d.ship("S2", "#6", last_scan_at="2026-08-06T12:00:00-04:00"), d.ship("S3", "#4", status="in_transit")],
        [d.ticket("Z2", requester_email="")],
    )


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    write_all(folder)
    return folder


@pytest.fixture(scope="module")
def seeds(tmp_path_factory):
    return d.write_seeds(tmp_path_factory.mktemp("seeds"))


def contents(spark, s, names=("stg_customers", "stg_orders", "stg_refunds", "stg_subscriptions", *daily_build.GOLD)):
    out = {}
    for name in names:
        layer = "silver" if name.startswith("stg_") else "gold"
        df = tables.table(spark, s, layer, name)
        df = df.select(sorted(c for c in df.columns if not c.startswith("_")))
        out[name] = sorted((tuple(r) for r in df.collect()), key=str)
    return out


@pytest.fixture(scope="module")
def full(spark, raw, seeds, tmp_path_factory):
    s = Settings(root=str(tmp_path_factory.mktemp("full")), raw=str(raw))
    checks = daily_build.run_history(spark, s, seeds)
    return s, checks.collect()


def test_full_refresh_contents(spark, full):
    s, checks = full
    orders = {r.order_id: r for r in incremental.stored(spark, s, "stg_orders").collect()}
    assert set(orders) == {"#1", "#2", "#4", "#5", "#6", "T1", "T2", "T4", "T5", "T6"}
    assert float(orders["T1"].amount_usd) == 14.0 and orders["T1"].customer_key == "STORE-01_2026-08-03"
    assert float(orders["#2"].amount_usd) == pytest.approx(20.5 * 0.723225)
    assert orders["#4"].order_ts_raw == datetime(2026, 8, 5, 3, 30) and orders["#4"].order_run_date == D4
    assert orders["T6"].order_ts_raw == datetime(2026, 8, 5, 15, 0)
    assert orders["#2"].channel == "subscription"
    kinds = {r.customer_key: r.customer_type for r in incremental.stored(spark, s, "stg_customers").collect()}
    assert kinds["c@x.com"] == "online" and kinds["555-1"] == "loyalty"
    assert kinds["STORE-99_2026-08-03"] == "walk_in"
    refunds = {r.refund_id: r for r in incremental.stored(spark, s, "stg_refunds").collect()}
    assert refunds["R1"].days_since_delivery == 2 and refunds["R1"].within_policy_window is True
    assert refunds["R6a"].refunded_before_delivery_confirmed is True
    churn = {r.customer_key: r.churn_status for r in tables.table(spark, s, "gold", "fact_subscription_churn").collect()}
    assert churn == {"a@x.com": "not_churned", "d@x.com": "unmapped_status"}
    found = {(c.check_name, c.table_name): c.violations for c in checks if c.violations}
    assert found == {("accepted_values", "stg_subscriptions"): 1, ("accepted_values", "fact_subscription_churn"): 1}
    assert len(checks) == 8 + 22 + 11 + 2 + 9
    assert all(c.column_name for c in checks)


def test_daily_runs_equal_full_refresh(spark, raw, seeds, full, tmp_path):
    s = Settings(root=str(tmp_path), raw=str(raw))
    for day in (D3, D4, D5):
        daily_build.run_days(spark, s, [day], seeds)
    expected = contents(spark, full[0])
    assert contents(spark, s) == expected
    # replaying the newest day and a past day changes nothing; the older snapshot stays out
    daily_build.run_days(spark, s, [D5, D3], seeds)
    assert contents(spark, s) == expected
    log = spark.read.parquet(s.path("ops", "run_log"))
    assert log.filter("status = 'skipped' and table_name = 'zendesk_tickets'").count() == 1
    assert log.filter("status = 'outdated'").count() == 1
    assert log.filter("step = 'ingest' and table_name = 'shopify_orders'").count() == 5
    built = log.filter("step in ('silver', 'gold') and rows is not null")
    assert built.select("table_name").distinct().count() == 9 and built.count() == 4 * 9
    history = spark.read.parquet(s.path("ops", "check_history"))
    assert history.select("checked_at").distinct().count() == 4
    fresh = spark.read.parquet(s.path("ops", "freshness"))
    assert fresh.count() == 4 * 5 and bronze.pending(spark, s) == {}


def test_silver_any_split_and_first_days_without_refunds(spark, raw, seeds, full, tmp_path):
    """Two days, then one; the first split starts on a day without refunds."""
    s = Settings(root=str(tmp_path), raw=str(raw))
    daily_build.load_seeds(spark, s, seeds)
    for days in ([D4], [D5]):
        for day in days:
            bronze.ingest_day(spark, s, day)
        incremental.update(spark, s)
    assert incremental.stored(spark, s, "stg_refunds").count() == 2
    bronze.ingest_day(spark, s, D3)  # an older day arrives last: the watermark alone would skip it
    incremental.update(spark, s)
    names = ("stg_customers", "stg_orders", "stg_refunds")
    expected = contents(spark, full[0], names)
    assert contents(spark, s, names) == expected


def test_redelivered_day_with_fewer_orders(spark, seeds, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_all(raw)
    s = Settings(root=str(tmp_path / "a"), raw=str(raw))
    daily_build.load_seeds(spark, s, seeds)
    for day in (D3, D4):
        bronze.ingest_day(spark, s, day)
    incremental.update(spark, s)
    d.write_json(raw, "shopify_orders", "2026-08-03", [d.web("#2", customer_email="b@x.com", total_price=1)])
    bronze.ingest_day(spark, s, D3)
    incremental.update(spark, s)
    fresh = Settings(root=str(tmp_path / "b"), raw=str(raw))
    daily_build.load_seeds(spark, fresh, seeds)
    for day in (D3, D4):
        bronze.ingest_day(spark, fresh, day)
    incremental.rebuild(spark, fresh)
    names = ("stg_customers", "stg_orders", "stg_refunds")
    assert contents(spark, s, names) == contents(spark, fresh, names)
    assert incremental.stored(spark, s, "stg_refunds").count() == 0


def test_first_seen_never_moves_forward(spark):
    schema = "customer_key string, customer_type string, first_seen_run_date date"
    old = spark.createDataFrame([("a", "online", D3), ("b", "online", D4)], schema)
    new = spark.createDataFrame([("a", "online", D5), ("b", "online", D3), ("c", "online", D5)], schema)
    got = {r.customer_key: r.first_seen_run_date for r in incremental.earlier_first_seen(old, new).collect()}
    assert got == {"a": D3, "b": D3, "c": D5}


def test_a_run_reads_the_marked_days(spark, tmp_path):
    s = Settings(root=str(tmp_path))
    rows = spark.createDataFrame([("#1", D3), ("#2", D4)], "order_id string, _run_date date")
    tables.swap(rows, s.path("bronze", "shopify_orders"), "_run_date", set())
    ids = lambda: sorted(r.order_id for r in incremental.marked(spark, s, "shopify_orders", bronze.pending(spark, s)).collect())
    assert ids() == []
    for day in ("2026-08-03", "2026-08-04"):
        fs.write_text(spark, bronze.pending_marker(s, "shopify_orders", day), "")
    assert ids() == ["#1", "#2"]
    bronze.settle(spark, s, {"shopify_orders": {"2026-08-03"}})
    assert ids() == ["#2"]


# -- any order of arrival equals a full rebuild ------------------------------------------


def days_apart(spark, tmp_path, seeds, first, second):
    """Tables after ``first`` and ``second`` were delivered and run one after the other, and after one rebuild."""
    raw = tmp_path / "raw"
    raw.mkdir()
    lakes = [Settings(root=str(tmp_path / n), raw=str(raw)) for n in ("daily", "full")]
    for deliver, days in (first, second):
        deliver(raw)
        daily_build.run_days(spark, lakes[0], days, seeds)
    daily_build.run_history(spark, lakes[1], seeds)
    return [contents(spark, s) for s in lakes]


def quiet(raw, day, web=(), pos=(), subs=None, ship=()):
    d.write_day(raw, day, list(web) or [d.web(f"#q{day}")], list(pos) or [d.pos(f"q{day}")], [d.sub("RC-1")] if subs is None else subs,
                list(ship) or [d.ship(f"Sq{day}", f"#q{day}")], [])


def test_ticket_with_lines_on_two_days(spark, tmp_path, seeds):
    first = (lambda raw: quiet(raw, "2026-08-03", pos=[d.pos("T1", unit_price="5.00"), d.pos("T9")]), [D3])
    second = (lambda raw: quiet(raw, "2026-08-04", pos=[d.pos("T1", unit_price="7.00")]), [D4])
    daily, whole = days_apart(spark, tmp_path, seeds, first, second)
    assert daily == whole
    (ticket,) = [r for r in daily["stg_orders"] if "T1" in r]
    assert Decimal("12.00") in [x for x in ticket if isinstance(x, Decimal)]


def test_shipment_file_that_arrives_after_its_day(spark, tmp_path, seeds):
    refunds = [d.refund("R1", 2.5, "2026-08-06T10:00:00-04:00")]

    def first(raw):
        quiet(raw, "2026-08-03", web=[d.web("#1", refunds=refunds)])
        quiet(raw, "2026-08-04")

    def second(raw):
        quiet(raw, "2026-08-03", web=[d.web("#1", refunds=refunds)], ship=[d.ship("S1", "#1", last_scan_at="2026-08-04T12:00:00-04:00")])

    daily, whole = days_apart(spark, tmp_path, seeds, (first, [D3, D4]), (second, [D3]))
    assert daily == whole
    assert datetime(2026, 8, 4, 16) in [x for r in daily["stg_refunds"] for x in r]


def test_order_exported_again_later(spark, tmp_path, seeds):
    refunds = [d.refund("R1", 2.5, "2026-08-04T10:00:00-04:00"), d.refund("R2", 1, "2026-08-04T11:00:00-04:00")]
    first = (lambda raw: quiet(raw, "2026-08-03", web=[d.web("#1", refunds=refunds), d.web("#2"), d.web("#3")]), [D3])
    again = [d.web("#1", total_price=9, refunds=refunds[:1]), d.web("#3", cancelled_at="2026-08-04T12:00:00-04:00")]
    second = (lambda raw: quiet(raw, "2026-08-04", web=again), [D4])
    daily, whole = days_apart(spark, tmp_path, seeds, first, second)
    assert daily == whole
    assert sum("#1" in r for r in daily["stg_orders"]) == 1 and not any("#3" in r for r in daily["stg_orders"])
    assert len(daily["stg_refunds"]) == 1


def test_past_day_delivered_again_with_an_older_snapshot(spark, tmp_path, seeds):
    def first(raw):
        quiet(raw, "2026-08-03", web=[d.web("#1"), d.web("#2")], subs=[d.sub("RC-1")])
        quiet(raw, "2026-08-04", web=[d.web("#1", total_price=3)], subs=[d.sub("RC-1", status="cancelled", cancellation_reason="customer_cancelled")])

    def second(raw):
        quiet(raw, "2026-08-03", web=[d.web("#1", total_price=99), d.web("#5")], subs=[d.sub("RC-1")])

    daily, whole = days_apart(spark, tmp_path, seeds, (first, [D3, D4]), (second, [D3]))
    assert daily == whole
    assert not any("#2" in r for r in daily["stg_orders"])
    assert any("voluntarily_churned" in r for r in daily["fact_subscription_churn"])


def test_a_new_day_opens_only_its_own_bronze_files(spark, full, monkeypatch, raw, seeds, tmp_path):
    """Orders and tickets of earlier days aren't listed when nothing of them is touched."""
    s = Settings(root=str(tmp_path), raw=str(raw))
    daily_build.run_days(spark, s, [D3, D4], seeds)
    for spec in SOURCES:
        bronze.load_day(spark, s, spec, D5)
    web, _ = incremental._online_batch(spark, s, bronze.pending(spark, s), "2026-08-04")
    pos, _ = incremental._store_batch(spark, s, bronze.pending(spark, s), "2026-08-04")
    for frame in (web, pos):
        assert {f.split("_run_date=")[1][:10] for f in frame.inputFiles()} == {"2026-08-05"}


# -- jobs --------------------------------------------------------------------------------


def job(root, raw, seeds, *argv):
    folder = str(Path(next(iter(seeds.values()))).parent)
    return main.arguments([*argv, "--root", str(root), "--raw", str(raw), "--seeds", folder])


def test_a_failing_check_fails_the_job(spark, raw, seeds, tmp_path, capsys):
    assert main.run(spark, job(tmp_path, raw, seeds, "history")) == 1
    printed = capsys.readouterr().out
    assert "accepted_values\tstg_subscriptions\tcustomer_status\t1" in printed
    values = [line.split("\t") for line in printed.splitlines() if line.startswith("accepted_values\tstg_subscriptions")]
    assert ["accepted_values", "stg_subscriptions", "customer_status", "unknown_status", "1"] in values
    zone = tmp_path / "zone"
    assert main.run(spark, job(tmp_path, raw, seeds, "archive", "--zone", str(zone))) == 0
    stored = tables.table(spark, main.settings(job(tmp_path, raw, seeds, "check")), "bronze", "shopify_orders")
    assert spark.read.parquet(f"{zone}/source_name=shopify_orders").count() == stored.count() > 0
    assert len(list(zone.glob("source_name=*"))) == len(SOURCES)
    assert main.run(spark, job(tmp_path, raw, seeds, "check", "--allow", "accepted_values")) == 0
    assert main.run(spark, job(tmp_path, raw, seeds, "audit")) == 0


def test_settings_from_the_command_line(raw, seeds, tmp_path):
    a = job(tmp_path, raw, seeds, "day", "--set", "churned_after_days=90", "--set", "json_lines=true", "--set", "reporting_timezone=UTC")
    s = main.settings(a)
    assert (s.churned_after_days, s.json_lines, s.reporting_timezone) == (90, True, "UTC")
    with pytest.raises(SystemExit):
        job(tmp_path, raw, seeds, "day", "--set", "unknown=1")


def test_arrivals_are_built_too(spark, raw, seeds, full, tmp_path):
    a = job(tmp_path / "lake", raw, seeds, "arrivals", "--progress", str(tmp_path / "progress"))
    assert main.run(spark, a) == 1
    s = main.settings(a)
    assert contents(spark, s) == contents(spark, full[0])


def test_failed_step_is_logged_and_stops(spark, raw, seeds, tmp_path):
    s = Settings(root=str(tmp_path), raw=str(raw))
    with pytest.raises(FileNotFoundError):
        daily_build.run_days(spark, s, [date(2026, 8, 20)], seeds)
    log = spark.read.parquet(s.path("ops", "run_log")).orderBy("finished_at").collect()
    assert [(r.step, r.status) for r in log] == [("seed", "built"), ("ingest", "failed")]


def test_freshness(spark, full):
    s, _ = full
    names = ("shopify_orders", "zendesk_tickets")
    got = daily_build.freshness({n: tables.table(spark, s, "bronze", n) for n in names}).collect()
    assert {(r.table_name, r.n_rows, r.days_behind) for r in got} == {("shopify_orders", 6, 0), ("zendesk_tickets", 2, 0)}


def test_stream_of_arriving_files_equals_daily_loads(spark, tmp_path):
    source_raw, raw = tmp_path / "src", tmp_path / "raw"
    source_raw.mkdir()
    raw.mkdir()
    write_all(source_raw)
    s = Settings(root=str(tmp_path / "lake"), raw=str(raw))

    def arrive(day):
        for f in source_raw.glob(f"*_{day}.*"):
            (raw / f.name).write_bytes(f.read_bytes())
        query = arrivals.ingest_arrivals(spark, s, str(tmp_path / "progress"))
        query.awaitTermination(120)
        assert query.exception() is None and not query.isActive

    arrive("2026-08-03")
    assert tables.table(spark, s, "bronze", "shopify_orders").count() == 3
    arrive("2026-08-04")
    arrive("2026-08-05")
    expected = Settings(root=str(tmp_path / "batch"), raw=str(raw))
    for day in (D3, D4, D5):
        bronze.ingest_day(spark, expected, day)
    for name in ("shopify_orders", "square_transactions", "recharge_subscriptions", "zendesk_tickets"):
        a, b = (tables.table(spark, x, "bronze", name).drop("_ingested_at").collect() for x in (s, expected))
        assert sorted(a, key=str) == sorted(b, key=str)


def test_other_files_are_ignored(spark):
    paths = ["/r/readme.txt", "/r/unknown_2026-08-03.csv", "/r/zendesk_tickets_2026-08-03.csv",
             "/r/shopify_orders_2026-08-03.json/part-0.json", "/r/shopify_orders_2026-99-03.json"]
    got = arrivals.deliveries(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert [(r.source, r.day) for r in got] == [("zendesk_tickets", D3), ("shopify_orders", D3)]


def test_late_older_snapshot_is_not_loaded(spark, raw, tmp_path):
    s = Settings(root=str(tmp_path), raw=str(raw))
    load = arrivals.load_arrivals(spark, s)
    for day, rows in (("2026-08-05", 3), ("2026-08-03", 3)):
        load(spark.createDataFrame([(f"{raw}/recharge_subscriptions_{day}.json",)], "path string"), 0)
        assert tables.table(spark, s, "bronze", "recharge_subscriptions").count() == rows
    assert tables.audit(spark, s, "recharge_subscriptions").count() == 0
