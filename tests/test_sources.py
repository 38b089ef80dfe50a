import json
import random
from dataclasses import replace
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

import deliveries as d
from cornermart import contracts
from cornermart.contracts import CONTRACTS, SOURCES, ContractError, bronze_schema, source
from cornermart.settings import Settings
from cornermart.sources import bronze, files, readers, records, seeds, tables, validate

DAY = date(2026, 8, 3)


@pytest.fixture
def lake(tmp_path):
    (tmp_path / "raw").mkdir()
    return Settings(root=str(tmp_path / "lake"), raw=str(tmp_path / "raw"))


def raw(lake):
    return Path(lake.raw)


# -- catalogue ---------------------------------------------------------------------------


def test_catalogue_is_complete():
    assert {s.name for s in SOURCES} == set(CONTRACTS)
    assert all(s.format in readers.READERS for s in SOURCES)
    assert all(s.load_strategy in ("append", "snapshot") for s in SOURCES)
    assert [s.name for s in SOURCES if not s.required] == ["zendesk_tickets"]


def test_signature_ignores_order_and_sees_nested_changes():
    schema = bronze_schema("shopify_orders")
    shuffled = StructType(list(reversed(schema.fields)))
    assert contracts.signature(schema) == contracts.signature(shuffled)
    assert contracts.schema_diff(schema, shuffled) == []
    narrower = StructType(
        [
            StructField(f.name, ArrayType(StructType([StructField("refund_id", LongType())])))
            if f.name == "refunds"
            else f
            for f in schema.fields
        ]
    )
    ((column, stored, declared),) = contracts.schema_diff(narrower, schema)
    assert (column, stored) == ("refunds", "array<struct<refund_id:bigint>>") and "amount:decimal(18,4)" in declared
    fewer = StructType(schema.fields[1:])
    assert contracts.schema_diff(fewer, schema) == [("order_id", None, "string")]
    assert contracts.schema_diff(schema, fewer) == [("order_id", "string", None)]


def test_run_date_parameter():
    assert contracts.parse_run_date("2026-08-03") == DAY
    assert contracts.parse_run_date(None) == date.today()
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        contracts.parse_run_date("03.08.2026")


# -- readers -----------------------------------------------------------------------------


def test_csv_stays_text_and_blank_is_null(spark, lake):
    path = d.write_csv(raw(lake), "shipstation_shipments", "2026-08-03", [
        d.ship("S1", "#1"), d.ship("S2", "", carrier="NA"), d.ship("S3", "#3", carrier='a "b", c'),
    ])
    got = readers.read_csv(spark, source("shipstation_shipments"), [str(path)])
    rows = {r.shipment_id: r for r in got.collect()}
    assert rows["S1"].tracking_number == "12345678901234567890"
    assert rows["S2"].shopify_order_id is None and rows["S2"].carrier is None
    assert rows["S3"].carrier == 'a "b", c'


def test_csv_columns_are_matched_by_name_across_files(spark, lake):
    cols = list(d.ship("S1", "#1"))
    a = d.write_csv(raw(lake), "shipstation_shipments", "2026-08-03", [d.ship("S1", "#1")], cols)
    b = d.write_csv(raw(lake), "shipstation_shipments", "2026-08-04", [d.ship("S2", "#2")], cols[::-1])
    got = readers.read_csv(spark, source("shipstation_shipments"), [str(a), str(b)])
    assert {(r.shipment_id, r.shopify_order_id) for r in got.collect()} == {("S1", "#1"), ("S2", "#2")}


def test_csv_quoted_line_breaks(spark, lake):
    path = d.write_csv(raw(lake), "zendesk_tickets", "2026-08-03", [d.ticket("Z1", subject="one\ntwo")])
    assert readers.read_csv(spark, source("zendesk_tickets"), [str(path)]).first().subject == "one\ntwo"


def test_csv_header_contract(spark, lake):
    row = d.ship("S1", "#1")
    less = {k: v for k, v in row.items() if k not in ("status", "carrier")}
    path = d.write_csv(raw(lake), "shipstation_shipments", "2026-08-03", [less])
    with pytest.raises(ContractError, match=r"not delivered \['carrier', 'status'\]"):
        readers.read_csv(spark, source("shipstation_shipments"), [str(path)])
    path = d.write_csv(raw(lake), "shipstation_shipments", "2026-08-03", [{**row, "zz": 1, "b": 2}])
    with pytest.raises(ContractError, match=r"not declared \['b', 'zz'\]"):
        readers.read_csv(spark, source("shipstation_shipments"), [str(path)])


def test_short_rows_are_padded_and_wide_rows_refused(spark, lake):
    path = raw(lake) / "zendesk_tickets_2026-08-03.csv"
    head = "ticket_id,requester_email,subject,created_at,tags,related_order_id\n"
    path.write_text(head + "Z1,a@x\n")
    loaded = bronze.load_day(spark, lake, source("zendesk_tickets"), DAY)
    assert (loaded.rows, loaded.short_rows) == (1, 1)
    row = tables.table(spark, lake, "bronze", "zendesk_tickets").first()
    assert (row.ticket_id, row.requester_email, row.subject) == ("Z1", "a@x", None)
    path.write_text(head + "Z1,a@x,s,t,u,v,w,x\n")
    with pytest.raises(ContractError, match="1 records are wider than their header"):
        bronze.load_day(spark, lake, source("zendesk_tickets"), DAY)


def test_json_keeps_nested_values_and_types(spark, lake):
    path = d.write_json(raw(lake), "shopify_orders", "2026-08-03", [d.web("#1"), d.web("#2", total_price="9")])
    got = readers.read_json(spark, source("shopify_orders"), [str(path)])
    got = validate.opened(got, "shopify_orders")
    kinds = [r[0] for r in got.select(validate.kind(validate.member("total_price"))).collect()]
    assert sorted(kinds) == ["number", "text"]
    typed = validate.typed(got, "shopify_orders").filter("order_id = '#1'").first()
    assert typed.line_items[0].sku == "COF-1" and typed.line_items[0].price == Decimal("20.5000")


def test_json_empty_array_has_no_rows(spark, lake):
    path = d.write_json(raw(lake), "shopify_orders", "2026-08-03", [])
    assert readers.read_json(spark, source("shopify_orders"), [str(path)]).count() == 0


def test_broken_json_is_an_error(spark, lake):
    path = raw(lake) / "shopify_orders_2026-08-03.json"
    path.write_text('[{"order_id": "#1"')
    with pytest.raises(Exception, match="(?i)malformed|parse|corrupt"):
        readers.read_json(spark, source("shopify_orders"), [str(path)]).collect()


@pytest.fixture
def small_ranges(spark):
    """Files are split into ranges of some hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for name in names:
        spark.conf.set(name, "300")
    yield
    for name in names:
        spark.conf.unset(name)


ODD_TEXT = ('}, {"', "[", "\\", '\\"', "a\nb", "é漢", "},{", "]", '"}', "")


def test_an_array_is_cut_by_many_tasks(spark, lake, small_ranges):
    rows = [d.web(f"#{k}", customer_email=ODD_TEXT[k % len(ODD_TEXT)] * (k % 4)) for k in range(200)]
    rows[50]["customer_email"] = "long" * 1000  # over several ranges
    path = Path(d.write_json(raw(lake), "shopify_orders", "2026-08-03", rows))
    other = path.with_name("shopify_orders_2026-08-04.json")
    other.write_text("\ufeff\n" + json.dumps([d.web(f"+{k}") for k in range(30)], indent=2, ensure_ascii=False) + "\n")
    got = readers.read_json(spark, source("shopify_orders"), [str(path), str(other)])
    assert got.rdd.getNumPartitions() > 50
    found = {(r.order_id, r.customer_email) for r in validate.typed(got, "shopify_orders").collect()}
    assert found == {(r["order_id"], r["customer_email"]) for r in rows} | {(f"+{k}", "a@x.com") for k in range(30)}
    assert got.count() == 230 and got.filter(F.col("_file").endswith("04.json")).count() == 30
    lines = path.with_name("lines.json")
    lines.write_text("\n".join(json.dumps(r) for r in rows))
    twin = readers.read_json(spark, replace(source("shopify_orders"), json_lines=True), [str(lines)])
    as_text = lambda df: sorted(r[0] for r in df.select(F.to_json("v")).collect())
    assert as_text(got.filter(F.col("_file").endswith("03.json"))) == as_text(twin)
    for report in (validate.column_report, validate.violation_counts):
        assert report(got, "shopify_orders").collect() == report(twin.unionByName(got.limit(0)), "shopify_orders").collect()


@pytest.mark.parametrize(
    "text",
    ['[{"a": 1} {"a": 2}]', '[{"a": 1},]', '[,{"a": 1}]', '[{"a": 1}', '{"a": 1}', '[{"a": 1}]]', '[{"a": 1}, {"a": "x]', '[{"a": 1},,{"b": 2}]'],
)
def test_broken_arrays_are_errors_wherever_they_are_cut(spark, lake, text, small_ranges):
    path = raw(lake) / "shopify_orders_2026-08-03.json"
    for wide in ("", " " * 400):
        path.write_text(text.replace("}", "}" + wide))
        with pytest.raises(Exception, match="(?i)malformed|parse|corrupt"):
            readers.read_json(spark, source("shopify_orders"), [str(path)]).collect()


def test_array_elements_that_are_no_objects(spark, lake):
    path = raw(lake) / "shopify_orders_2026-08-03.json"
    path.write_text('[1, {"a": [{"b": 2}]}, null, "x}", {"c": 3}, [4], true]')
    got = readers.read_json(spark, source("shopify_orders"), [str(path)])
    assert sorted(r[0] for r in got.select(F.to_json("v")).collect()) == sorted(
        ["1", '{"a":[{"b":2}]}', "null", '"x}"', '{"c":3}', "[4]", "true"]
    )


def test_a_csv_file_is_cut_by_many_tasks(spark, lake, small_ranges):
    texts = ("plain", "a\nb", 'say "x"\n\n"y"', ",\n,", '"', 'in "the" middle', "crlf\r\nend", " ")
    rows = [d.ticket(f"Z{k}", subject=texts[k % len(texts)] * (1 + k % 3)) for k in range(300)]
    rows[70]["subject"] = "wide\n" * 400  # over several ranges
    path = d.write_csv(raw(lake), "zendesk_tickets", "2026-08-03", rows)
    got = readers.read_csv(spark, source("zendesk_tickets"), [str(path)])
    assert got.rdd.getNumPartitions() > 50
    assert {(r.ticket_id, r.subject) for r in got.collect()} == {(r["ticket_id"], r["subject"]) for r in rows}
    assert got.count() == 300 and got.filter("_odd is not null").count() == 0


def test_quotes_inside_a_cell_open_nothing(spark, lake):
    path = raw(lake) / "zendesk_tickets_2026-08-03.csv"
    head = "ticket_id,requester_email,subject,created_at,tags,related_order_id"
    path.write_text(f'{head}\r\nZ1,a@x,5" pipe,,,\r\n\r\nZ2,a@x,"6"" pipe\n",,,\r\nZ3,,,,,')
    got = {r.ticket_id: r.subject for r in readers.read_csv(spark, source("zendesk_tickets"), [str(path)]).collect()}
    assert got == {"Z1": '5" pipe', "Z2": '6" pipe\n', "Z3": None}


def test_tables_of_ranges_compose_in_any_grouping():
    r = random.Random(2)
    for syntax, letters in ((records.JsonArray(), '{}[]"a\\"'), (records.CsvLines(), '",\na ')):
        for _ in range(300):
            parts = ["".join(r.choice(letters) for _ in range(r.randint(0, 9))).rstrip("\\") + syntax.separator for _ in range(6)]
            tables = [syntax.table(p.encode()) for p in parts]
            left = tables[0]
            for t in tables[1:]:
                left = records.chained(left, t)
            right = tables[-1]
            for t in tables[-2::-1]:
                right = records.chained(t, right)
            assert left == right == syntax.table("".join(parts).encode())
            assert records.follow((1, 2), left) == (left[2], left[3] + 2)


@pytest.mark.parametrize("lines", [False, True])
def test_arrays_and_lines_are_judged_alike(spark, lake, lines):
    """Counts, non-objects, keys that differ in case and empty files, however the file is laid out."""
    s = Settings(root=lake.root, raw=lake.raw, json_lines=lines)

    def deliver(*records):
        text = "\n".join(map(json.dumps, records)) if lines else json.dumps(list(records))
        (raw(lake) / "shopify_orders_2026-08-03.json").write_text(text)
        return readers.read_raw(spark, contracts.SourceSpec("shopify_orders", "json", "append", json_lines=lines),
                                [str(raw(lake) / "shopify_orders_2026-08-03.json")])

    frame = deliver(d.web("#1"), d.web("#2", extra=1), d.web("#3", Order_ID="x"))
    report = {tuple(r) for r in validate.column_report(frame, "shopify_orders").collect()}
    assert report == {("unexpected", "extra", 1), ("unexpected", "Order_ID", 1)}
    with pytest.raises(ContractError, match=r"not declared \['Order_ID', 'extra'\]"):
        bronze.load_day(spark, s, source("shopify_orders"), DAY)
    deliver(d.web("#1"), 5, [1])
    with pytest.raises(ContractError, match="2 records are no JSON objects"):
        bronze.load_day(spark, s, source("shopify_orders"), DAY)
    assert deliver().count() == 0
    assert validate.column_report(deliver(), "shopify_orders").count() == 0


def test_quoted_line_breaks_in_every_csv_source(spark, lake):
    path = raw(lake) / "square_transactions_2026-08-03.csv"
    rows = [d.pos("T1", item_name="dark\nroast", unit_price="9.00"), d.pos("T2")]
    d.write_csv(raw(lake), "square_transactions", "2026-08-03", rows)
    assert "\n" in path.read_text()
    assert bronze.load_day(spark, lake, source("square_transactions"), DAY) == bronze.Load("square_transactions", "loaded", 2)
    got = {r.transaction_id: r for r in tables.table(spark, lake, "bronze", "square_transactions").collect()}
    assert set(got) == {"T1", "T2"} and got["T1"].item_name == "dark\nroast" and got["T1"].unit_price == "9.00"


def test_json_lines_and_folders_of_part_files(spark, lake):
    folder = raw(lake) / "shopify_orders_2026-08-03.json"
    folder.mkdir()
    for i in range(3):
        (folder / f"part-{i}.json").write_text(json.dumps(d.web(f"#{i}")) + "\n" + json.dumps(d.web(f"#{i}b")))
    spec = contracts.SourceSpec("shopify_orders", "json", "append", json_lines=True)
    assert bronze.load_day(spark, lake, spec, DAY).rows == 6
    assert bronze.load_history(spark, lake, spec).rows == 6


# -- contract ----------------------------------------------------------------------------


def variants(spark, *records):
    rows = [(json.dumps(r) if isinstance(r, dict) else r,) for r in records]
    df = spark.createDataFrame(rows, "t string")
    return df.select(F.parse_json("t").alias("v"), F.lit("f.json").alias("_file"))


def offenders(spark, *records):
    got = validate.violations(variants(spark, *records), "shopify_orders").collect()
    return sorted((r.column_name, r.found) for r in got)


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, []),
        ({"total_price": 20}, []),
        ({"total_price": None, "refunds": None, "order_id": None}, []),
        ({"total_price": "20.5"}, [("total_price", "text")]),
        ({"total_price": True}, [("total_price", "boolean")]),
        ({"total_price": 1.23456}, [("total_price", "number")]),  # would lose digits
        ({"total_price": 1e20}, [("total_price", "number")]),  # does not fit
        ({"order_id": 7}, [("order_id", "number")]),
        ({"refunds": []}, []),
        ({"refunds": {}}, [("refunds", "object")]),
        ({"refunds": [None]}, [("refunds", "array")]),
        ({"refunds": ["R1"]}, [("refunds", "array")]),
        ({"refunds": [{"refund_id": "R", "amount": "5"}]}, [("refunds", "array")]),
        ({"refunds": [{"refund_id": "R", "amount": None}]}, []),
        ({"refunds": [{"unknown": 1}]}, []),
        ({"line_items": [{"qty": 1.5}]}, [("line_items", "array")]),
        ({"line_items": [{"qty": True}]}, [("line_items", "array")]),
        ({"line_items": [{"qty": 2}]}, []),
    ],
)
def test_value_contract(spark, changes, expected):
    assert offenders(spark, d.web("#1", **changes)) == expected


def test_only_five_offenders_are_quoted(spark, lake):
    rows = [d.web(f"#{i}", total_price=f"text{i}") for i in range(9)] + [d.web("#ok")]
    d.write_json(raw(lake), "shopify_orders", "2026-08-03", rows)
    with pytest.raises(ContractError) as error:
        bronze.load_day(spark, lake, source("shopify_orders"), DAY)
    assert "'total_price' expected decimal(18,4)" in str(error.value)
    assert str(error.value).count("got text") == 5


def test_json_columns_missing_and_extra(spark, lake):
    row = d.web("#1")
    row.pop("currency")
    d.write_json(raw(lake), "shopify_orders", "2026-08-03", [row])
    with pytest.raises(ContractError, match=r"not delivered \['currency'\]"):
        bronze.load_day(spark, lake, source("shopify_orders"), DAY)
    d.write_json(raw(lake), "shopify_orders", "2026-08-03", [d.web("#1"), d.web("#2", promo=1)])
    with pytest.raises(ContractError, match=r"\['promo'\]"):
        bronze.load_day(spark, lake, source("shopify_orders"), DAY)
    assert not tables.has_table(spark, lake, "bronze", "shopify_orders")


def test_records_must_be_objects(spark, lake):
    (raw(lake) / "shopify_orders_2026-08-03.json").write_text(json.dumps([d.web("#1"), 5]))
    with pytest.raises(ContractError, match="1 records are no JSON objects"):
        bronze.load_day(spark, lake, source("shopify_orders"), DAY)


def test_dates_accept_text(spark):
    from pyspark.sql.types import DateType, StringType

    df = spark.createDataFrame([('"2026-08-03"',), ("7",)], "t string").select(F.parse_json("t").alias("v"))
    assert [r[0] for r in df.select(validate.mismatches(F.col("v"), DateType())).collect()] == [False, True]
    assert [r[0] for r in df.select(validate.mismatches(F.col("v"), StringType())).collect()] == [False, True]


# -- loading -----------------------------------------------------------------------------


def test_missing_file_rules(spark, lake):
    assert bronze.load_day(spark, lake, source("zendesk_tickets"), DAY).status == "skipped"
    with pytest.raises(FileNotFoundError, match="shopify_orders"):
        bronze.load_day(spark, lake, source("shopify_orders"), DAY)
    with pytest.raises(FileNotFoundError):
        files.resolve_all(spark, lake, source("shopify_orders"))
    assert tables.table(spark, lake, "bronze", "zendesk_tickets").count() == 0


def test_empty_required_sources_are_refused(spark, lake):
    d.write_json(raw(lake), "shopify_orders", "2026-08-03", [])
    d.write_csv(raw(lake), "shipstation_shipments", "2026-08-03", [], list(d.ship("S", "#1")))
    for name in ("shopify_orders", "shipstation_shipments"):
        with pytest.raises(ContractError):
            bronze.load_day(spark, lake, source(name), DAY)
        with pytest.raises(ContractError):
            bronze.load_history(spark, lake, source(name))


def test_lineage_and_exact_types(spark, lake):
    d.write_json(raw(lake), "shopify_orders", "2026-08-03", [d.web("#1", total_price=0.1)])
    assert bronze.load_day(spark, lake, source("shopify_orders"), DAY).rows == 1
    stored = tables.table(spark, lake, "bronze", "shopify_orders")
    row = stored.first()
    assert (row._source_system, row._run_date) == ("shopify_orders", DAY)
    assert row._ingested_at is not None and row.total_price == Decimal("0.1000")
    assert tables.audit(spark, lake, "shopify_orders").count() == 0
    assert contracts.signature(stored.schema) == contracts.signature(bronze_schema("shopify_orders"))


def test_day_with_no_refunds_keeps_its_type(spark, lake):
    d.write_json(raw(lake), "shopify_orders", "2026-08-03", [d.web("#1")])
    bronze.load_day(spark, lake, source("shopify_orders"), DAY)
    refunds = tables.table(spark, lake, "bronze", "shopify_orders").schema["refunds"].dataType
    assert refunds.simpleString() == CONTRACTS["shopify_orders"]["refunds"].dataType.simpleString()


def test_reloading_a_day_replaces_only_that_day(spark, lake):
    spec = source("shopify_orders")
    d.write_json(raw(lake), spec.name, "2026-08-03", [d.web("#1"), d.web("#2")])
    d.write_json(raw(lake), spec.name, "2026-08-04", [d.web("#3")])
    for _ in range(2):
        bronze.load_day(spark, lake, spec, DAY)
        bronze.load_day(spark, lake, spec, date(2026, 8, 4))
    ids = lambda: sorted(r.order_id for r in tables.table(spark, lake, "bronze", spec.name).collect())
    assert ids() == ["#1", "#2", "#3"]
    d.write_json(raw(lake), spec.name, "2026-08-03", [d.web("#9")])
    bronze.load_day(spark, lake, spec, DAY)
    assert ids() == ["#3", "#9"]


def test_optional_day_delivered_again_empty_removes_the_day(spark, lake):
    spec = source("zendesk_tickets")
    d.write_csv(raw(lake), spec.name, "2026-08-03", [d.ticket("Z1")])
    d.write_csv(raw(lake), spec.name, "2026-08-04", [d.ticket("Z2")])
    bronze.load_history(spark, lake, spec)
    d.write_csv(raw(lake), spec.name, "2026-08-03", [], list(d.ticket("Z")))
    bronze.load_day(spark, lake, spec, DAY)
    assert [r.ticket_id for r in tables.table(spark, lake, "bronze", spec.name).collect()] == ["Z2"]


def test_history_appends_days_and_takes_the_newest_snapshot(spark, lake):
    for day, n in (("2026-08-03", 2), ("2026-08-04", 0), ("2026-08-05", 1)):
        d.write_csv(raw(lake), "zendesk_tickets", day, [d.ticket(f"Z{day}{i}") for i in range(n)], list(d.ticket("Z")))
        d.write_json(raw(lake), "recharge_subscriptions", day, [d.sub(f"RC-{day}-{i}") for i in range(n + 1)])
    assert bronze.load_history(spark, lake, source("zendesk_tickets")).rows == 3
    days = {str(r._run_date) for r in tables.table(spark, lake, "bronze", "zendesk_tickets").collect()}
    assert days == {"2026-08-03", "2026-08-05"}
    assert bronze.load_history(spark, lake, source("recharge_subscriptions")).rows == 2
    got = tables.table(spark, lake, "bronze", "recharge_subscriptions").collect()
    assert {str(r._run_date) for r in got} == {"2026-08-05"} and len(got) == 2


def test_snapshot_load_replaces_everything(spark, lake):
    spec = source("recharge_subscriptions")
    for day, n in (("2026-08-03", 3), ("2026-08-04", 1)):
        d.write_json(raw(lake), spec.name, day, [d.sub(f"RC-{i}") for i in range(n)])
        bronze.load_day(spark, lake, spec, date.fromisoformat(day))
        assert tables.table(spark, lake, "bronze", spec.name).count() == n


def test_an_older_snapshot_is_not_loaded(spark, lake):
    spec = source("recharge_subscriptions")
    for day, n in (("2026-08-03", 3), ("2026-08-04", 1)):
        d.write_json(raw(lake), spec.name, day, [d.sub(f"RC-{i}") for i in range(n)])
    assert bronze.load_day(spark, lake, spec, date(2026, 8, 4)).status == "loaded"
    assert bronze.load_day(spark, lake, spec, DAY).status == "outdated"
    assert bronze.load_day(spark, lake, spec, date(2026, 8, 4)).status == "loaded"
    assert tables.table(spark, lake, "bronze", spec.name).count() == 1


def test_drift_of_a_stored_table_stops_the_load(spark, lake):
    spec = source("shopify_orders")
    d.write_json(raw(lake), spec.name, "2026-08-03", [d.web("#1")])
    bronze.load_day(spark, lake, spec, DAY)
    old = spark.read.parquet(lake.path("bronze", spec.name)).withColumn("currency", F.lit(1))
    drifted = Settings(root=lake.root + "-old", raw=lake.raw)
    old.write.partitionBy("_run_date").parquet(drifted.path("bronze", spec.name))
    with pytest.raises(ContractError, match="another shape"):
        bronze.load_day(spark, drifted, spec, DAY)


def test_audit_reads_every_file(spark, lake, monkeypatch):
    """Two files of other shapes in one partition, one of them not the first, are both reported."""
    spec = source("shipstation_shipments")
    d.write_csv(raw(lake), spec.name, "2026-08-03", [d.ship(f"S{k}", f"#{k}") for k in range(5)])
    bronze.load_day(spark, lake, spec, DAY)
    folder = Path(lake.path("bronze", spec.name)) / "_run_date=2026-08-03"
    good = spark.read.parquet(str(folder))
    for k, df in enumerate((good.drop("carrier"), good.withColumn("status", F.lit(1)), good.withColumn("extra", F.lit("x")))):
        df.coalesce(1).write.parquet(f"{lake.root}/odd{k}")
        (part,) = Path(f"{lake.root}/odd{k}").glob("*.parquet")
        part.rename(folder / f"zz{k}-{part.name}")
    expected = {("carrier", None, "string"), ("status", "int", "string"), ("extra", "string", None)}
    for openable in (True, False):
        monkeypatch.setattr("cornermart.sources.footers.can_open", lambda uri, o=openable: o)
        rows = [tuple(r) for r in tables.audit(spark, lake, spec.name).collect()]
        assert {r[2:] for r in rows} == expected and len(rows) == 3
        assert {r[:2] for r in rows} == {(spec.name, "2026-08-03")}


def test_audit_names_each_drifted_partition(spark, lake):
    spec = source("shopify_orders")
    path = lake.path("bronze", spec.name)
    for day in ("2026-08-03", "2026-08-04", "2026-08-05"):
        d.write_json(raw(lake), spec.name, day, [d.web("#1")])
        bronze.load_day(spark, lake, spec, date.fromisoformat(day))
    good = spark.read.parquet(f"{path}/_run_date=2026-08-03")
    good.withColumn("currency", F.lit(1)).write.mode("overwrite").parquet(f"{path}/_run_date=2026-08-04")
    good.drop("total_price").withColumn("zz", F.lit("x")).write.mode("overwrite").parquet(f"{path}/_run_date=2026-08-05")
    found = {tuple(r)[1:] for r in tables.audit(spark, lake, spec.name).collect()}
    assert found == {
        ("2026-08-04", "currency", "int", "string"),
        ("2026-08-05", "total_price", None, "decimal(18,4)"),
        ("2026-08-05", "zz", "string", None),
    }


def test_drift_check_does_not_depend_on_the_number_of_days(spark, lake, monkeypatch):
    spec = source("shopify_orders")
    d.write_json(raw(lake), spec.name, "2026-08-03", [d.web("#1")])
    bronze.load_day(spark, lake, spec, DAY)
    monkeypatch.setattr(tables, "_schema", lambda *_: pytest.fail("no data file is opened"))
    bronze.load_day(spark, lake, spec, DAY)


def test_hive_layouts(spark, lake):
    assert files.hive_folder("/z/bronze", "s", DAY) == "/z/bronze/source_name=s/year=2026/month=08/day=03"
    hive = Settings(root=lake.root, raw=lake.raw, hive_raw_layout=True)
    from pathlib import Path

    folder = Path(files.hive_folder(lake.raw, "shopify_orders", DAY))
    folder.mkdir(parents=True)
    d.write_json(folder, "shopify_orders", "2026-08-03", [d.web("#1")])
    assert bronze.load_day(spark, hive, source("shopify_orders"), DAY).rows == 1
    assert bronze.load_history(spark, hive, source("shopify_orders")).rows == 1
    zone = lake.root + "/archive"
    tables.write_hive_layout(tables.table(spark, hive, "bronze", "shopify_orders"), zone)
    archived = list(Path(files.hive_folder(zone, "shopify_orders", DAY)).glob("*.parquet"))
    assert archived and spark.read.parquet(zone).first().order_id == "#1"


def test_seed_rates_keep_six_places(spark, tmp_path):
    paths = d.write_seeds(tmp_path)
    rates = seeds.read_seed(spark, "exchange_rates", paths["exchange_rates"])
    assert rates.filter("currency = 'CAD'").first().rate_to_usd == Decimal("0.723225")


# -- tables ------------------------------------------------------------------------------

SCHEMA = "k string, day date, v int"


def rows_of(spark, s):
    return sorted((r.k, str(r.day), r.v) for r in tables.table(spark, s, "x", "t", StructType.fromDDL(SCHEMA)).collect())


def test_upsert_moves_keys_and_drops_emptied_days(spark, lake):
    make = lambda *rows: spark.createDataFrame([(k, date(2026, 8, dd), v) for k, dd, v in rows], SCHEMA)
    up = lambda df, doomed=None: tables.upsert(df, lake, "x", "t", "k", "day", doomed)
    up(make(("a", 1, 1), ("b", 2, 1), ("c", 3, 1), ("d", 3, 1)))
    up(make(("a", 2, 2), ("c", 3, 2)))  # a moves from day 1 to day 2, c is updated in place
    assert rows_of(spark, lake) == [("a", "2026-08-02", 2), ("b", "2026-08-02", 1), ("c", "2026-08-03", 2), ("d", "2026-08-03", 1)]
    from pathlib import Path

    assert not (Path(lake.path("x", "t")) / "day=2026-08-01").exists()
    up(make(("a", 2, 2), ("c", 3, 2)))
    assert len(rows_of(spark, lake)) == 4
    stored = tables.table(spark, lake, "x", "t", StructType.fromDDL(SCHEMA))
    up(make(("e", 4, 1)), stored.filter("k in ('b', 'd')").select("k"))
    assert [r[0] for r in rows_of(spark, lake)] == ["a", "c", "e"]


def test_upsert_keeps_rows_without_a_day(spark, lake):
    df = spark.createDataFrame([("a", None, 1), ("b", date(2026, 8, 1), 1)], SCHEMA)
    tables.upsert(df, lake, "x", "t", "k", "day")
    tables.upsert(df.filter("k = 'a'").withColumn("v", F.lit(2)), lake, "x", "t", "k", "day")
    assert rows_of(spark, lake) == [("a", "None", 2), ("b", "2026-08-01", 1)]


def test_replace_self_reads_what_it_replaces(spark, lake):
    path = lake.path("x", "v")
    tables.replace_self(spark.range(3), path)
    for n in (4, 5, 6):
        tables.replace_self(tables.table(spark, lake, "x", "v").union(spark.range(1)), path)
        assert tables.table(spark, lake, "x", "v").count() == n
    broken = tables.table(spark, lake, "x", "v").select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.replace_self(broken, path)
    assert tables.table(spark, lake, "x", "v").count() == 6


@pytest.mark.parametrize("step", ["batch", "merged", "mark", "swap", "drop", "clean"])
def test_upsert_cut_off_at_any_step_loses_nothing(spark, lake, monkeypatch, step):
    make = lambda *rows: spark.createDataFrame([(k, date(2026, 8, dd), v) for k, dd, v in rows], SCHEMA)
    tables.upsert(make(("a", 1, 1), ("b", 2, 1), ("c", 2, 1), ("d", 3, 1)), lake, "x", "t", "k", "day")
    batch = make(("a", 2, 2), ("c", 2, 2))

    class Cut(RuntimeError):
        pass

    def fail(*_, **__):
        raise Cut

    with monkeypatch.context() as m:
        if step == "batch":
            m.setattr(tables, "values_of", fail)
        elif step == "merged":
            m.setattr(tables.fs, "write_text", fail)
        elif step == "mark":
            m.setattr(tables, "swap", fail)
        elif step == "swap":
            real = tables.swap

            def half(staged, path, partition, doomed, *rest, **more):  # a commit that has removed a day already
                tables.fs.remove(spark, f"{path}/day=2026-08-02")
                raise Cut

            m.setattr(tables, "swap", half)
            assert real is not half
        else:
            remove, calls = tables.fs.remove, []

            def some(session, uri):
                if ("day=" in uri) == (step == "drop") and (step == "drop" or uri.endswith("x-t") and calls):
                    raise Cut
                calls.append(uri)
                remove(session, uri)

            m.setattr(tables.fs, "remove", some)
        with pytest.raises(Cut):
            tables.upsert(batch, lake, "x", "t", "k", "day")
    tables.upsert(batch, lake, "x", "t", "k", "day")
    assert rows_of(spark, lake) == [("a", "2026-08-02", 2), ("b", "2026-08-02", 1), ("c", "2026-08-02", 2), ("d", "2026-08-03", 1)]
    from pathlib import Path

    assert not list(Path(lake.path("_staging", "")).glob("*"))


def test_upsert_removes_stale_rows(spark, lake):
    df = spark.createDataFrame([("a", date(2026, 8, 1), 1), (None, date(2026, 8, 1), 2), (None, date(2026, 8, 2), 3)], SCHEMA)
    tables.upsert(df, lake, "x", "t", "k", "day")
    batch = spark.createDataFrame([(None, date(2026, 8, 1), 9)], SCHEMA)
    tables.upsert(batch, lake, "x", "t", "k", "day", stale=F.col("day") == "2026-08-01")
    assert rows_of(spark, lake) == [("None", "2026-08-01", 9), ("None", "2026-08-02", 3)] or sorted(
        r[1:] for r in rows_of(spark, lake)
    ) == [("2026-08-01", 9), ("2026-08-02", 3)]


def test_upsert_computes_the_removed_keys_once(spark, lake):
    df = spark.createDataFrame([("a", date(2026, 8, 1), 1), ("b", date(2026, 8, 2), 2), ("c", date(2026, 8, 3), 3)], SCHEMA)
    tables.upsert(df, lake, "x", "t", "k", "day")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    doomed = spark.createDataFrame([("b",), ("c",), ("z",), (None,)], "k string").mapInArrow(counted, "k string")
    batch = spark.createDataFrame([("b", date(2026, 8, 4), 9)], SCHEMA)
    tables.upsert(batch, lake, "x", "t", "k", "day", doomed)
    assert rows_of(spark, lake) == [("a", "2026-08-01", 1), ("b", "2026-08-04", 9)]
    assert read.value == 4


def test_a_large_day_is_written_by_several_tasks(spark, lake):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 200_000, 1, 4).selectExpr("id", "uuid() as text", "date'2026-08-01' as day")
        tables.swap(df, lake.path("x", "large"), "day", set())
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    from pathlib import Path

    assert len(list((Path(lake.path("x", "large")) / "day=2026-08-01").glob("*.parquet"))) > 1
    assert spark.read.parquet(lake.path("x", "large")).count() == 200_000
