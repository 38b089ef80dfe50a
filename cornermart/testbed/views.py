"""Bronze-shaped views over the star-schema test tables.

Every row of orders, lineitem and events is used: an order is an online order, its line items are
a point-of-sale ticket, an event is a subscription record. Key arithmetic only fills attributes
the tables lack (clock times, currencies, cancellations); it never drops rows.
``oracle.py`` states the same views in the SQL of the comparison engine.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import gold, silver
from ..session import materialise, pin
from ..settings import Settings

_CLOCK = """concat(lpad(cast(6 + k % 17 as string), 2, '0'), ':', lpad(cast(k % 60 as string), 2, '0'), ':00',
    case k % 4 when 0 then '-04:00' when 1 then '-05:00' else '-07:00' end)"""
_REFUND = "k % 23 = 1 or (k % 37 = 0 and k % 2 = 0) or (month(d) = 6 and day(d) < 8 and k % 4 = 1)"


def _refund(number: int, share: str) -> str:
    return f"""named_struct(
        'refund_id', concat('RF-', k, '-{number}'),
        'amount', cast(total * {share} as decimal(18,4)),
        'created_at', concat(date_add(d, cast(k % 45 as int)), 'T', clock),
        'reason', case when k % 2 = 0 then 'damaged' else 'wrong_item' end)"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey as k",
        "o_custkey as c",
        "o_orderstatus as status",
        "o_orderpriority as priority",
        "cast(o_orderdate as date) as d",
        "cast(o_totalprice as decimal(18,2)) as total",
    )


def shopify_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).selectExpr(
        "*", f"{_CLOCK} as clock", f"{_REFUND} as refunded"
    )
    return orders.selectExpr(
        "concat('#', k) as order_id",
        "concat('user', c, '@example.com') as customer_email",
        "concat(d, 'T', clock) as created_at",
        "case when k % 13 = 0 then 'CAD' else 'USD' end as currency",
        "cast(total as decimal(18,4)) as total_price",
        "case when priority in ('1-URGENT', '2-HIGH') then 'recharge' else 'web' end as source_name",
        "case when refunded then 'partially_refunded' else 'paid' end as financial_status",
        "case when k % 37 = 0 then concat(d, 'T', clock) end as cancelled_at",
        f"""case when refunded
            then slice(array({_refund(1, "0.4")}, {_refund(2, "0.1")}), 1, if(k % 46 = 1, 2, 1))
            else array() end as refunds""",
        """array(named_struct('sku', concat('SKU-', k % 50), 'name', 'coffee', 'qty', 1L,
            'price', cast(total as decimal(18,4)))) as line_items""",
        "d as _run_date",
    )


def square_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a ticket's lines have in common is made once per ticket, ahead of the join."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    tickets = _orders(spark, sf_dir).selectExpr(
        "k",
        "concat('SQ-', k) as transaction_id",
        "case when k % 25 = 0 then 'STORE-99' else concat('STORE-0', 1 + k % 3) end as location_id",
        "case when k % 2 = 0 then 'card' else 'cash' end as payment_type",
        "concat(d, 'T', lpad(cast(7 + k % 12 as string), 2, '0'), ':00:00') as created_at_local",
        "case when k % 10 < 3 then concat('555-', c) end as customer_phone",
        "d as _run_date",
    )
    return lines.join(tickets, lines["l_orderkey"] == tickets["k"]).selectExpr(
        "transaction_id",
        "location_id",
        "concat('SKU-', l_partkey) as item_sku",
        "concat('part ', l_partkey) as item_name",
        "cast(cast(l_quantity as int) as string) as qty",
        "cast(cast(l_extendedprice as decimal(18,2)) as string) as unit_price",
        """cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)) as string)
            as discount""",
        "payment_type",
        "concat('E-', l_suppkey) as employee_id",
        "created_at_local",
        "customer_phone",
        "_run_date",
    )


def recharge_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per event; the event type becomes the status. Times move next to the last orders."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        "user_id as u",
        """case when event_type in ('signup', 'purchase') and user_id % 8 = 5 then 'view'
                when event_type = 'purchase' and user_id % 10 = 3 then 'expired'
                else event_type end as kind""",
        "ts - interval 23 years + make_dt_interval(cast(user_id % 180 as int)) as created",
        "cast(ts as date) as run_date",
    )
    stamp = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    return events.selectExpr(
        "concat('RC-', event_id) as subscription_id",
        "concat('user', u, '@example.com') as customer_email",
        """case kind when 'signup' then 'active' when 'purchase' then 'active' when 'view' then 'paused'
                when 'expired' then 'expired' else 'cancelled' end as status""",
        "case when event_id % 2 = 0 then 14L else 30L end as frequency_days",
        f"concat({stamp.format('created')}, '+00:00') as created_at",
        "cast(null as string) as next_charge_date",
        f"""case when kind in ('click', 'error')
            then concat({stamp.format("created + interval 5 days")}, '+00:00') end as cancelled_at""",
        """case kind when 'click' then 'customer_cancelled'
            when 'error' then 'payment_failed_max_retries' end as cancellation_reason""",
        "cast(null as string) as linked_shopify_order_id",
        "run_date as _run_date",
    )


def shipstation_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order ships; some in two parcels, which repeats their refunds."""
    parcels = _orders(spark, sf_dir).selectExpr(
        "*", "explode(sequence(1, case when k % 101 = 0 then 2 else 1 end)) as parcel"
    )
    return parcels.selectExpr(
        "concat('SH-', k, '-', parcel) as shipment_id",
        "concat('#', k) as shopify_order_id",
        "concat('9400', lpad(cast(k as string), 16, '0')) as tracking_number",
        "'UPS' as carrier",
        "cast(date_add(d, cast(k % 3 as int)) as string) as ship_date",
        """case status when 'F' then 'delivered' when 'O' then 'in_transit'
            else case when k % 2 = 0 then 'shipped' else 'delivery_exception' end end as status""",
        "concat(date_add(d, cast(k % 3 + parcel + k % 5 as int)), 'T18:00:00+00:00') as last_scan_at",
        "d as _run_date",
    )


def zendesk_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticket per message of a conversation."""
    messages = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return messages.selectExpr(
        "concat('ZD-', conv_id, '-', turn) as ticket_id",
        "case when conv_id % 3 <> 0 then concat('user', conv_id, '@example.com') end as requester_email",
        "text as subject",
        "concat(date_add(date'2001-01-01', cast(conv_id % 365 as int)), 'T09:00:00-04:00') as created_at",
        "case conv_id % 3 when 0 then 'refund,late' when 1 then 'damaged' else 'question' end as tags",
        "case when conv_id % 5 >= 3 then concat('#', conv_id) end as related_order_id",
        "date_add(date'2001-01-01', cast(conv_id % 365 as int)) as _run_date",
    )


def shopify_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders as raw JSON records with planted contract faults; ``financial_status`` is absent."""
    text = """concat('{"order_id":', case when k % 71 = 0 then cast(k as string) else concat('"#', k, '"') end,
        ',"customer_email":"user', c, '@example.com"',
        ',"created_at":"', d, 'T10:00:00-04:00"',
        ',"currency":', case when k % 13 = 0 then 'null' else '"USD"' end,
        ',"total_price":', case when k % 97 = 0 then concat('"', total, '"')
                                when k % 89 = 0 then 'true'
                                when k % 79 = 0 then concat(total, '123') else cast(total as string) end,
        ',"source_name":"web","cancelled_at":null',
        case when k % 83 = 0 then ',"promo_code":"X"' else '' end,
        case when k % 59 = 0 then ',"utm":7' else '' end,
        ',"refunds":', case when k % 67 = 0 then '[{"refund_id":"R","amount":"12"}]'
                            when k % 61 = 0 then '[{"refund_id":"R","amount":1.5,"extra":1}]'
                            when k % 53 = 0 then '[null]' else '[]' end,
        ',"line_items":', case when k % 73 = 0 then '[{"sku":"S","qty":1.5,"price":2}]'
                               when k % 47 = 0 then '{"sku":"S"}'
                               else '[{"sku":"S","qty":2,"price":3.25}]' end, '}')"""
    return (
        _orders(spark, sf_dir)
        .select(F.expr(text).alias("t"))
        .select(F.parse_json("t").alias("v"), F.lit("orders.parquet").alias("_file"))
    )


def _store_timezones(spark: SparkSession) -> DataFrame:
    """A literal table: its size is known, so no ticket is shuffled to look up its store."""
    return spark.sql(
        """select * from values ('STORE-01', 'America/New_York'), ('STORE-02', 'America/Chicago'),
            ('STORE-03', 'America/Los_Angeles') as zones(location_id, timezone_name)"""
    )


def _exchange_rates(spark: SparkSession) -> DataFrame:
    """A rate per currency and day; no CAD rate is published on two holidays a year."""
    days = spark.sql(
        "select explode(sequence(date'1990-01-01', date'2030-12-31')) as currency_date"
    )
    cad = days.filter("date_format(currency_date, 'MM-dd') not in ('01-01', '12-25')").selectExpr(
        "currency_date",
        "'CAD' as currency",
        "cast(cast(0.71 as decimal(10,6)) + cast(dayofyear(currency_date) % 20 as decimal(4,0)) * 0.001 as decimal(10,6)) as rate_to_usd",
    )
    usd = days.selectExpr(
        "currency_date", "'USD' as currency", "cast(1 as decimal(10,6)) as rate_to_usd"
    )
    return usd.unionByName(cad)


class Shop:
    """Bronze views, cleaned tables and business tables over one test-data folder, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings | None = None):
        self.spark, self.sf_dir, self.s = pin(spark), sf_dir, settings or Settings()
        self.zones = _store_timezones(spark)
        self.rates = _exchange_rates(spark)

    def _view(self, build) -> DataFrame:
        return build(self.spark, self.sf_dir)

    web = cached_property(lambda self: self._view(shopify_orders))
    pos = cached_property(lambda self: self._view(square_transactions))
    subs = cached_property(lambda self: self._view(recharge_subscriptions))
    ship = cached_property(lambda self: self._view(shipstation_shipments))
    tickets = cached_property(lambda self: self._view(zendesk_tickets))

    @cached_property
    def sales(self) -> DataFrame:
        """Ticket totals; stored, they serve customers and orders with one pass over the lines."""
        return silver.ticket_totals(self.pos)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return silver.customers(self.web, self.__dict__.get("sales", self.pos))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return silver.orders(self.web, self.pos, self.zones, self.rates, self.__dict__.get("sales"))

    @cached_property
    def stg_refunds(self) -> DataFrame:
        return silver.refunds(self.web, self.ship, self.rates, self.s.refund_window_days)

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return silver.subscriptions(self.subs)

    @cached_property
    def fact_weekly_revenue(self) -> DataFrame:
        return gold.weekly_revenue(self.stg_orders, self.s)

    @cached_property
    def fact_subscription_churn(self) -> DataFrame:
        return gold.subscription_churn(self.stg_subscriptions)

    @cached_property
    def fact_customer_health(self) -> DataFrame:
        return gold.customer_health(self.stg_orders, self.stg_customers, self.s)

    @cached_property
    def fact_customer_rfm(self) -> DataFrame:
        return gold.customer_rfm(
            self.stg_orders, self.stg_customers, self.stg_subscriptions, self.s
        )

    @cached_property
    def fact_refund_alerts(self) -> DataFrame:
        return gold.refund_alerts(self.stg_orders, self.stg_refunds, self.s)

    def store(self, *names: str) -> "Shop":
        """Materialise the named tables in this order, as a lake would, so later ones read them."""
        for name in names:
            self.__dict__[name] = materialise(getattr(self, name), name)
        return self

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in names}
