"""Comparison SQL: the test views and every query in the comparison engine's dialect.

Written against the declared semantics, with joins and windows stated plainly (NTILE and
ROW_NUMBER over the whole table, left joins, scalar subqueries), so it shares no shortcut with the
Spark code.
"""

from __future__ import annotations

TZ = "America/New_York"

_CLOCK = """lpad(CAST(6 + k % 17 AS VARCHAR), 2, '0') || ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || ':00'
    || CASE k % 4 WHEN 0 THEN '-04:00' WHEN 1 THEN '-05:00' ELSE '-07:00' END"""
_REFUND = "k % 23 = 1 OR (k % 37 = 0 AND k % 2 = 0) OR (month(d) = 6 AND day(d) < 8 AND k % 4 = 1)"


def _refund(number: int, share: str) -> str:
    return f"""struct_pack(
        refund_id := 'RF-' || k || '-{number}',
        amount := CAST(total * {share} AS DECIMAL(18,4)),
        created_at := CAST(d + CAST(k % 45 AS INTEGER) AS VARCHAR) || 'T' || {_CLOCK},
        reason := CASE WHEN k % 2 = 0 THEN 'damaged' ELSE 'wrong_item' END)"""


def _utc(text: str) -> str:
    """An instant's UTC clock."""
    return f"({text}::TIMESTAMPTZ AT TIME ZONE 'UTC')"


def _local(ts: str) -> str:
    """UTC clock -> clock of the reporting zone."""
    return f"timezone('{TZ}', timezone('UTC', {ts}))"


def _shop_clock_utc(text: str, zone: str) -> str:
    """Wall clock of a store's zone -> UTC clock."""
    return f"timezone('UTC', timezone({zone}, {text}::TIMESTAMP))"


def _labelled(value: str, labels: dict[str, str], otherwise: str) -> str:
    """A label looked up by value."""
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in labels.items())
    return f"COALESCE(MAP {{{pairs}}}[{value}], '{otherwise}')"


# Source states and their labels.
STATUS = {
    "active/": "is_active", "paused/": "is_paused",
    "cancelled/customer_cancelled": "is_voluntarily_cancelled",
    "cancelled/payment_failed_max_retries": "is_payment_failure_cancelled",
}
CHURN = {
    "is_active": "not_churned", "is_paused": "not_churned", "is_voluntarily_cancelled": "voluntarily_churned",
    "is_payment_failure_cancelled": "involuntarily_churned",
}
_STATE = "status || '/' || IF(status = 'cancelled', COALESCE(cancellation_reason, ''), '')"


def _days(a: str, b: str) -> str:
    return f"date_diff('day', CAST({a} AS DATE), CAST({b} AS DATE))"


# name -> SELECT; a statement takes the ones it needs, in this order.
CTES: dict[str, str] = {
    "base_orders": """
        SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS status, o_orderpriority AS priority,
            CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS total
        FROM orders""",
    "web": f"""
        SELECT '#' || k AS order_id, 'user' || c || '@example.com' AS customer_email,
            CAST(d AS VARCHAR) || 'T' || {_CLOCK} AS created_at,
            CASE WHEN k % 13 = 0 THEN 'CAD' ELSE 'USD' END AS currency,
            CAST(total AS DECIMAL(18,4)) AS total_price,
            CASE WHEN priority IN ('1-URGENT', '2-HIGH') THEN 'recharge' ELSE 'web' END AS source_name,
            CASE WHEN {_REFUND} THEN 'partially_refunded' ELSE 'paid' END AS financial_status,
            CASE WHEN k % 37 = 0 THEN CAST(d AS VARCHAR) || 'T' || {_CLOCK} END AS cancelled_at,
            CASE WHEN k % 46 = 1 THEN [{_refund(1, "0.4")}, {_refund(2, "0.1")}]
                 WHEN {_REFUND} THEN [{_refund(1, "0.4")}] ELSE [] END AS refunds,
            d AS _run_date
        FROM base_orders""",
    "pos": """
        SELECT 'SQ-' || k AS transaction_id,
            CASE WHEN k % 25 = 0 THEN 'STORE-99' ELSE 'STORE-0' || (1 + k % 3) END AS location_id,
            CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty,
            CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS unit_price,
            CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS discount,
            CAST(d AS VARCHAR) || 'T' || lpad(CAST(7 + k % 12 AS VARCHAR), 2, '0') || ':00:00' AS created_at_local,
            CASE WHEN k % 10 < 3 THEN '555-' || c END AS customer_phone,
            d AS _run_date
        FROM lineitem JOIN base_orders ON l_orderkey = k""",
    "base_events": """
        SELECT event_id, user_id AS u,
            CASE WHEN event_type IN ('signup', 'purchase') AND user_id % 8 = 5 THEN 'view'
                 WHEN event_type = 'purchase' AND user_id % 10 = 3 THEN 'expired' ELSE event_type END AS kind,
            ts - INTERVAL 23 YEAR + to_days(CAST(user_id % 180 AS INTEGER)) AS created, CAST(ts AS DATE) AS run_date
        FROM events""",
    "subs": """
        SELECT 'RC-' || event_id AS subscription_id, 'user' || u || '@example.com' AS customer_email,
            CASE kind WHEN 'signup' THEN 'active' WHEN 'purchase' THEN 'active' WHEN 'view' THEN 'paused'
                WHEN 'expired' THEN 'expired' ELSE 'cancelled' END AS status,
            CASE WHEN event_id % 2 = 0 THEN 14 ELSE 30 END AS frequency_days,
            strftime(created, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS created_at,
            CAST(NULL AS VARCHAR) AS next_charge_date,
            CASE WHEN kind IN ('click', 'error')
                THEN strftime(created + INTERVAL 5 DAY, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS cancelled_at,
            CASE kind WHEN 'click' THEN 'customer_cancelled'
                WHEN 'error' THEN 'payment_failed_max_retries' END AS cancellation_reason,
            CAST(NULL AS VARCHAR) AS linked_shopify_order_id,
            run_date AS _run_date
        FROM base_events""",
    "ship": """
        SELECT '#' || k AS shopify_order_id,
            CASE status WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'in_transit'
                ELSE CASE WHEN k % 2 = 0 THEN 'shipped' ELSE 'delivery_exception' END END AS status,
            CAST(d + CAST(k % 3 + parcel + k % 5 AS INTEGER) AS VARCHAR) || 'T18:00:00+00:00' AS last_scan_at,
            d AS _run_date
        FROM (SELECT *, unnest(CASE WHEN k % 101 = 0 THEN [1, 2] ELSE [1] END) AS parcel FROM base_orders)""",
    "tickets": """
        SELECT 'ZD-' || conv_id || '-' || turn AS ticket_id, DATE '2001-01-01' + CAST(conv_id % 365 AS INTEGER) AS _run_date
        FROM conversations""",
    "documents_json": """
        SELECT k, CAST('{"order_id":' || CASE WHEN k % 71 = 0 THEN CAST(k AS VARCHAR) ELSE '"#' || k || '"' END
            || ',"total_price":' || CASE WHEN k % 97 = 0 THEN '"' || total || '"' WHEN k % 89 = 0 THEN 'true'
                WHEN k % 79 = 0 THEN total || '123' ELSE CAST(total AS VARCHAR) END
            || CASE WHEN k % 83 = 0 THEN ',"promo_code":"X"' ELSE '' END
            || CASE WHEN k % 59 = 0 THEN ',"utm":7' ELSE '' END
            || ',"refunds":' || CASE WHEN k % 67 = 0 THEN '[{"refund_id":"R","amount":"12"}]'
                WHEN k % 61 = 0 THEN '[{"refund_id":"R","amount":1.5,"extra":1}]' WHEN k % 53 = 0 THEN '[null]' ELSE '[]' END
            || ',"line_items":' || CASE WHEN k % 73 = 0 THEN '[{"sku":"S","qty":1.5,"price":2}]'
                WHEN k % 47 = 0 THEN '{"sku":"S"}' ELSE '[{"sku":"S","qty":2,"price":3.25}]' END || '}' AS JSON) AS j
        FROM base_orders""",
    "zones": """
        SELECT * FROM (VALUES ('STORE-01', 'America/New_York'), ('STORE-02', 'America/Chicago'),
            ('STORE-03', 'America/Los_Angeles')) t(location_id, timezone_name)""",
    "rates": """
        SELECT currency_date, 'USD' AS currency, CAST(1 AS DECIMAL(10,6)) AS rate_to_usd
        FROM (SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS currency_date)
        UNION ALL
        SELECT currency_date, 'CAD', CAST(CAST(0.71 AS DECIMAL(10,6)) + CAST(dayofyear(currency_date) % 20 AS DECIMAL(4,0)) * 0.001 AS DECIMAL(10,6))
        FROM (SELECT CAST(unnest(generate_series(DATE '1990-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS currency_date)
        WHERE strftime(currency_date, '%m-%d') NOT IN ('01-01', '12-25')""",
    "customers_online": """
        SELECT customer_email AS customer_key, 'online' AS customer_type, min(_run_date) AS first_seen_run_date
        FROM web GROUP BY 1""",
    "customers_loyalty": """
        SELECT customer_phone AS customer_key, 'loyalty' AS customer_type, min(_run_date) AS first_seen_run_date
        FROM pos WHERE customer_phone IS NOT NULL GROUP BY 1""",
    "customers_walk_in": """
        SELECT location_id || '_' || CAST(CAST(CAST(created_at_local AS TIMESTAMP) AS DATE) AS VARCHAR) AS customer_key,
            'walk_in' AS customer_type, min(_run_date) AS first_seen_run_date
        FROM pos WHERE customer_phone IS NULL GROUP BY 1""",
    "stg_customers": """
        SELECT * FROM customers_online UNION ALL SELECT * FROM customers_loyalty
        UNION ALL SELECT * FROM customers_walk_in""",
    "square_rollup": """
        SELECT transaction_id AS order_id, location_id,
            COALESCE(customer_phone, location_id || '_' || CAST(CAST(CAST(created_at_local AS TIMESTAMP) AS DATE) AS VARCHAR)) AS customer_key,
            min(created_at_local) AS ticket_clock, min(_run_date) AS order_run_date,
            CAST(sum(CAST(qty AS DECIMAL(12,4)) * CAST(unit_price AS DECIMAL(18,4)) - CAST(discount AS DECIMAL(18,4))) AS DECIMAL(26,8)) AS amount_original
        FROM pos GROUP BY transaction_id, location_id, customer_phone, created_at_local""",
    "square_utc": f"""
        SELECT order_id, customer_key, 'retail' AS channel, 'USD' AS currency, amount_original, order_run_date,
            {_shop_clock_utc("ticket_clock", "timezone_name")} AS order_ts_raw
        FROM zones, square_rollup WHERE zones.location_id = square_rollup.location_id""",
    "online": f"""
        SELECT order_id, customer_email AS customer_key,
            IF(source_name = 'recharge', 'subscription', 'online_oneoff') AS channel,
            currency, CAST(total_price AS DECIMAL(26,8)) AS amount_original, _run_date AS order_run_date,
            {_utc("created_at")} AS order_ts_raw
        FROM web WHERE cancelled_at IS NULL""",
    "combined": "SELECT * FROM square_utc UNION ALL SELECT * FROM online",
    "stg_orders": """
        SELECT combined.*, amount_original * rate AS amount_usd
        FROM combined, LATERAL (SELECT COALESCE(max(rate_to_usd), 1::DECIMAL(10,6)) AS rate FROM rates
            WHERE rates.currency = combined.currency AND rates.currency_date = combined.order_ts_raw::DATE) p""",
    "exploded": f"""
        SELECT r.refund_id AS refund_id, order_id, customer_key, CAST(r.amount AS DECIMAL(26,8)) AS amount_original,
            currency, created_at, order_run_date, r.reason AS reason, {_utc("r.created_at")} AS refund_ts
        FROM (SELECT order_id, customer_email AS customer_key, currency, created_at, _run_date AS order_run_date,
                unnest(refunds) AS r FROM web WHERE len(refunds) > 0)""",
    "delivered": f"""
        SELECT shopify_order_id AS order_id, {_utc("last_scan_at")} AS delivered_at
        FROM ship WHERE status = 'delivered'""",
    "lagged": f"""
        SELECT exploded.*, delivered_at, {_days("delivered_at", "refund_ts")} AS days_since_delivery
        FROM exploded JOIN delivered USING (order_id)
        UNION ALL SELECT *, NULL, NULL FROM exploded WHERE NOT EXISTS (
            FROM delivered WHERE delivered.order_id = exploded.order_id)""",
    "flagged": """
        SELECT *, IF(delivered_at IS NULL, NULL, days_since_delivery <= 30) AS within_policy_window,
            IF(delivered_at IS NULL, NULL, days_since_delivery < 0) AS refunded_before_delivery_confirmed
        FROM lagged""",
    "stg_refunds": f"""
        SELECT refund_id, order_id, customer_key, amount_original, currency, amount_original * rate AS amount_usd,
            reason, delivered_at, refund_ts, days_since_delivery, order_run_date, within_policy_window,
            refunded_before_delivery_confirmed
        FROM flagged, LATERAL (SELECT COALESCE(max(rate_to_usd), 1::DECIMAL(10,6)) AS rate FROM rates
            WHERE rates.currency = flagged.currency AND rates.currency_date = {_utc("flagged.created_at")}::DATE) p""",
    "stg_subscriptions": f"""
        SELECT subscription_id, customer_email AS customer_key, {_utc("created_at")} AS subscription_created_at,
            {_utc("cancelled_at")} AS cancelled_at, frequency_days,
            {_labelled(_STATE, STATUS, "unknown_status")} AS customer_status
        FROM subs""",
    "fact_weekly_revenue": f"""
        SELECT CAST(date_trunc('week', {_local("order_ts_raw")}) AS DATE) AS week_start_date, channel,
            round(sum(amount_usd), 2) AS total_revenue
        FROM stg_orders GROUP BY 1, 2""",
    "latest": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_key
            ORDER BY subscription_created_at DESC, subscription_id DESC) AS rn FROM stg_subscriptions) WHERE rn = 1""",
    "fact_subscription_churn": f"""
        SELECT subscription_id, customer_key, {_labelled("customer_status", CHURN, "unmapped_status")} AS churn_status
        FROM latest""",
    "last_order": f"""
        SELECT customer_key, max({_local("order_ts_raw")}) AS last_order_date FROM stg_orders GROUP BY 1""",
    "fact_customer_health": f"""
        WITH aged AS (SELECT *, {_days("last_order_date", "max(last_order_date) OVER ()")} AS days_since_last_order
            FROM last_order)
        SELECT customer_key, customer_type, last_order_date, days_since_last_order,
            ['active', 'at_risk', 'churned'][1 + (days_since_last_order > 44)::INT + (days_since_last_order > 59)::INT]
                AS customer_health
        FROM aged JOIN stg_customers USING (customer_key) WHERE customer_type <> 'walk_in'""",
    "rfm_base": f"""
        SELECT customer_key, customer_type, round(sum(amount_usd), 2) AS spend_usd,
            max({_local("order_ts_raw")}) AS newest_order_at, count(*) AS n_orders
        FROM stg_orders JOIN stg_customers USING (customer_key) WHERE customer_type <> 'walk_in' GROUP BY ALL""",
    "tenure": f"""
        SELECT customer_key, {_days(f"min({_local('subscription_created_at')})", "any_value(reference)")} AS tenure_days
        FROM stg_subscriptions, (SELECT max(newest_order_at) AS reference FROM rfm_base)
        WHERE customer_key IS NOT NULL GROUP BY customer_key HAVING bool_or(customer_status = 'is_active')""",
    "quintiles": """
        SELECT *, ntile(5) OVER (ORDER BY spend_usd, customer_key, customer_type) AS monetary_score,
            ntile(5) OVER (ORDER BY n_orders, customer_key, customer_type) AS frequency_score,
            ntile(5) OVER (ORDER BY newest_order_at, customer_key, customer_type) AS recency_score
        FROM rfm_base""",
    "fact_customer_rfm": """
        SELECT customer_key, monetary_score, frequency_score, recency_score, tenure_bonus,
            monetary_score + frequency_score + recency_score + tenure_bonus AS total_score
        FROM (SELECT *, (SELECT COALESCE(max((tenure_days > 90)::INT + (tenure_days > 129)::INT), 0) FROM tenure
                WHERE tenure.customer_key = quintiles.customer_key) AS tenure_bonus FROM quintiles)""",
    "order_days": f"SELECT CAST({_local('order_ts_raw')} AS DATE) AS d FROM stg_orders",
    "refund_days": f"SELECT CAST({_local('refund_ts')} AS DATE) AS d FROM stg_refunds",
    "activity": "SELECT d AS day FROM order_days UNION SELECT d FROM refund_days",
    "spine": """
        SELECT CAST(unnest(generate_series((SELECT min(day) FROM activity), (SELECT max(day) FROM activity),
            INTERVAL 1 DAY)) AS DATE) AS day""",
    "happened": """
        SELECT d AS day, 1 AS o, 0 AS r FROM order_days UNION ALL SELECT d, 0, 1 FROM refund_days
        UNION ALL SELECT day, 0, 0 FROM spine""",
    "daily": """
        SELECT day, sum(o)::BIGINT AS daily_orders, sum(r)::BIGINT AS daily_refunds
        FROM happened WHERE day IS NOT NULL GROUP BY day""",
    "rolled": """
        SELECT t.day, t.daily_orders, t.daily_refunds, sum(b.daily_orders)::BIGINT AS orders_rolling,
            sum(b.daily_refunds)::BIGINT AS refunds_rolling
        FROM daily t JOIN daily b ON b.day BETWEEN t.day - 6 AND t.day GROUP BY ALL""",
    "baseline": "SELECT 100.0 * sum(r) / sum(o) AS baseline_rate FROM happened",
    "fact_refund_alerts": """
        SELECT rolled.*, rate AS refund_rate_pct, baseline_rate, IF(rate > 2 * baseline_rate, 'alert', 'normal') AS alert_system
        FROM baseline, rolled, LATERAL (SELECT round(100.0 * refunds_rolling / NULLIF(orders_rolling, 0), 2) AS rate) p""",
}


def _number(column: str) -> str:
    """Money as a double of 6 places."""
    return f"CAST(round({column}, 6) AS DOUBLE) AS {column}"


_ORDER = f"order_id, customer_key, channel, currency, {_number('amount_original')}, order_run_date, order_ts_raw"
_REFUND_OUT = f"""refund_id, order_id, customer_key, {_number("amount_original")}, currency, {_number("amount_usd")},
    reason, delivered_at, refund_ts, days_since_delivery, order_run_date, within_policy_window,
    refunded_before_delivery_confirmed"""
_RFM = f"customer_key, customer_type, {_number('spend_usd')}, newest_order_at, n_orders"

_UNIQUE = {
    "stg_customers": "customer_key", "stg_orders": "order_id", "stg_refunds": "refund_id",
    "stg_subscriptions": "subscription_id", "fact_customer_health": "customer_key",
    "fact_customer_rfm": "customer_key", "fact_subscription_churn": "customer_key", "fact_refund_alerts": "day",
}
_NOT_NULL = {
    "stg_customers": ["customer_key", "customer_type"],
    "stg_orders": ["order_id", "customer_key", "channel", "amount_usd"],
    "stg_refunds": ["refund_id", "order_id", "amount_usd"],
    "stg_subscriptions": ["subscription_id", "customer_status"],
    "fact_weekly_revenue": ["week_start_date", "channel", "total_revenue"],
    "fact_customer_health": ["customer_key", "customer_health", "days_since_last_order"],
    "fact_customer_rfm": ["customer_key"],
    "fact_subscription_churn": ["customer_key", "churn_status"],
    "fact_refund_alerts": ["day", "alert_system"],
}
_ACCEPTED = [
    ("stg_customers", "customer_type", "'online', 'loyalty', 'walk_in'"),
    ("stg_orders", "channel", "'retail', 'online_oneoff', 'subscription'"),
    ("stg_subscriptions", "customer_status",
     "'is_active', 'is_paused', 'is_voluntarily_cancelled', 'is_payment_failure_cancelled'"),
    ("fact_weekly_revenue", "channel", "'retail', 'online_oneoff', 'subscription'"),
    ("fact_customer_health", "customer_health", "'active', 'at_risk', 'churned'"),
    ("fact_customer_rfm", "monetary_score", "1, 2, 3, 4, 5"),
    ("fact_customer_rfm", "frequency_score", "1, 2, 3, 4, 5"),
    ("fact_customer_rfm", "recency_score", "1, 2, 3, 4, 5"),
    ("fact_customer_rfm", "tenure_bonus", "0, 1, 2"),
    ("fact_subscription_churn", "churn_status",
     "'voluntarily_churned', 'involuntarily_churned', 'not_churned'"),
    ("fact_refund_alerts", "alert_system", "'alert', 'normal'"),
]
_PARENTS = [
    ("stg_orders", "customer_key", "stg_customers", "customer_key"),
    ("stg_refunds", "order_id", "stg_orders", "order_id"),
]


def _unique() -> str:
    return " UNION ALL ".join(
        f"""SELECT 'unique' AS check_name, '{t}' AS table_name, '{c}' AS column_name, count(*) AS violations
        FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""
        for t, c in _UNIQUE.items()
    )


def _not_null() -> str:
    return " UNION ALL ".join(
        f"""SELECT 'not_null' AS check_name, '{t}' AS table_name, '{c}' AS column_name,
        count(*) AS violations FROM {t} WHERE {c} IS NULL"""
        for t, cs in _NOT_NULL.items()
        for c in cs
    )


def _accepted() -> str:
    return " UNION ALL ".join(
        f"""SELECT 'accepted_values' AS check_name, '{t}' AS table_name, '{c}' AS column_name,
        CAST({c} AS VARCHAR) AS bad_value, count(*) AS violations FROM {t} WHERE {c} NOT IN ({values}) GROUP BY {c}"""
        for t, c, values in _ACCEPTED
    )


def _relationships() -> str:
    return " UNION ALL ".join(
        f"""SELECT 'relationships' AS check_name, '{t}' AS table_name, '{c}' AS column_name,
        count(DISTINCT a.{c}) AS orphan_keys, count(*) AS violations
        FROM {t} a WHERE a.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} b WHERE b.{pc} = a.{c})"""
        for t, c, p, pc in _PARENTS
    )


def _freshness() -> str:
    named = {
        "shopify_orders": "web", "square_transactions": "pos", "recharge_subscriptions": "subs",
        "zendesk_tickets": "tickets", "shipstation_shipments": "ship",
    }
    each = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows, max(_run_date) AS latest_run_date FROM {v}"
        for n, v in named.items()
    )
    return f"""SELECT *, date_diff('day', latest_run_date, (SELECT max(latest_run_date) FROM ({each}))) AS days_behind
        FROM ({each})"""


_KIND = """CASE json_type({v}) WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array'
    WHEN 'OBJECT' THEN 'object' ELSE 'number' END"""
_REFUND_TYPE = "array<struct<refund_id:string,amount:decimal(18,4),created_at:string,reason:string>>"
_ITEM_TYPE = "array<struct<sku:string,name:string,qty:bigint,price:decimal(18,4)>>"


def _violations() -> str:
    def one(column: str, expected: str, broken: str) -> str:
        value = f"(j->'$.{column}')"
        return f"""SELECT '{column}' AS column_name, '{expected}' AS expected, {_KIND.format(v=value)} AS found,
            count(*) AS violations FROM documents_json WHERE {broken} GROUP BY 3"""

    price = "(j->'$.total_price')"
    amount, item = "(j->'$.refunds[0].amount')", "(j->'$.line_items[0].qty')"
    return " UNION ALL ".join(
        [
            one("order_id", "string", "json_type(j->'$.order_id') <> 'VARCHAR'"),
            one(
                "total_price", "decimal(18,4)",
                f"""json_type({price}) IN ('VARCHAR', 'BOOLEAN')
                OR CAST(CAST({price} AS VARCHAR) AS DECIMAL(38,18)) <> CAST(CAST({price} AS VARCHAR) AS DECIMAL(18,4))""",
            ),
            one("refunds", _REFUND_TYPE,
                f"json_type({amount}) = 'VARCHAR' OR json_type(j->'$.refunds[0]') = 'NULL'"),
            one("line_items", _ITEM_TYPE,
                f"json_type(j->'$.line_items') <> 'ARRAY' OR json_type({item}) = 'DOUBLE'"),
        ]
    )


_SUBS_OUT = """subscription_id, customer_email, status, frequency_days, created_at, next_charge_date, cancelled_at,
    cancellation_reason, linked_shopify_order_id, _run_date"""
_CUTOFF = "DATE '2000-01-01'"

BODIES: dict[str, str] = {
    "snapshot_latest": f"SELECT {_SUBS_OUT} FROM subs WHERE _run_date = (SELECT max(_run_date) FROM subs)",
    "contract_columns": """SELECT 'missing' AS issue, 'financial_status' AS column_name, count(*) AS n_rows FROM documents_json
        UNION ALL SELECT 'unexpected', key, count(*) FROM (SELECT unnest(json_keys(j)) AS key FROM documents_json)
        WHERE key IN ('promo_code', 'utm') GROUP BY key""",
    "contract_violations": _violations(),
    "partition_swap": """SELECT order_id, CAST(CASE WHEN _run_date >= DATE '2001-01-01'
            THEN CAST(total_price * 0.9 AS DECIMAL(18,4)) ELSE total_price END AS DOUBLE) AS total_price,
            financial_status, _run_date FROM web""",
    "incremental_new_rows": f"""SELECT order_id, customer_email, {_number("total_price")}, _run_date FROM web
        WHERE _run_date > (SELECT max(order_run_date) FROM online WHERE order_run_date < {_CUTOFF})""",
    "upsert_merge": f"""SELECT order_id, customer_key, channel,
            CASE WHEN order_run_date >= DATE '1999-12-01' THEN 're-' || currency ELSE currency END AS currency,
            {_number("amount_original")}, order_run_date, order_ts_raw FROM online""",
    "two_part_load": f"""SELECT refund_id, order_id, {_number("amount_usd")}, delivered_at, refund_ts, within_policy_window
        FROM stg_refunds""",
    "freshness": _freshness(),
    "ts_parse_utc": f"SELECT order_id, {_utc('created_at')} AS created_utc FROM web",
    "ts_naive_to_utc": """SELECT DISTINCT transaction_id,
            """ + _shop_clock_utc("created_at_local", "timezone_name") + """ AS created_utc
        FROM pos JOIN zones USING (location_id)""",
    "ts_utc_to_local": f"SELECT order_id, {_local('order_ts_raw')} AS ticket_clock FROM online",
    "week_start": f"SELECT order_id, CAST(date_trunc('week', {_local('order_ts_raw')}) AS DATE) AS week_start_date FROM online",
    "local_date": """SELECT transaction_id, CAST(CAST(created_at_local AS TIMESTAMP) AS DATE) AS local_day, count(*) AS n_lines
        FROM pos GROUP BY 1, 2""",
    "utc_date": f"SELECT order_id, CAST({_utc('created_at')} AS DATE) AS utc_day FROM web",
    "day_diff": f"SELECT refund_id, {_days(_utc('created_at'), 'refund_ts')} AS days FROM exploded",
    "customers_online": "SELECT * FROM customers_online",
    "customers_loyalty": "SELECT * FROM customers_loyalty",
    "customers_walk_in": "SELECT * FROM customers_walk_in",
    "stg_customers": "SELECT * FROM stg_customers",
    "square_order_rollup": f"""SELECT order_id, location_id, customer_key, ticket_clock, order_run_date,
        {_number("amount_original")} FROM square_rollup""",
    "square_orders_utc": f"SELECT {_ORDER} FROM square_utc",
    "online_orders": f"SELECT {_ORDER} FROM online",
    "orders_combined": f"SELECT {_ORDER} FROM combined",
    "orders_fx": f"""SELECT order_id, currency, {_number("amount_original")}, {_number("amount_usd")}
        FROM stg_orders WHERE channel <> 'retail'""",
    "stg_orders": f"SELECT {_ORDER}, {_number('amount_usd')} FROM stg_orders",
    "refunds_exploded": f"""SELECT refund_id, order_id, customer_key, {_number("amount_original")}, currency, created_at,
        order_run_date, reason, refund_ts FROM exploded""",
    "shipments_delivered": "SELECT * FROM delivered",
    "refund_delivery_lag": "SELECT refund_id, order_id, delivered_at, refund_ts, days_since_delivery FROM lagged",
    "refund_policy_flags": """SELECT refund_id, days_since_delivery, within_policy_window,
        refunded_before_delivery_confirmed FROM flagged""",
    "refunds_fx": f"""SELECT refund_id, e.currency, {_number("amount_original")},
        round(amount_original * rate, 6)::DOUBLE AS amount_usd
        FROM exploded e, LATERAL (SELECT COALESCE(max(rate_to_usd), 1::DECIMAL(10,6)) AS rate FROM rates
            WHERE rates.currency = e.currency AND rates.currency_date = {_utc("e.created_at")}::DATE) p""",
    "stg_refunds": f"SELECT {_REFUND_OUT} FROM stg_refunds",
    "stg_subscriptions": "SELECT * FROM stg_subscriptions",
    "fact_weekly_revenue": f"SELECT week_start_date, channel, {_number('total_revenue')} FROM fact_weekly_revenue",
    "latest_subscription": "SELECT * FROM latest",
    "fact_subscription_churn": "SELECT * FROM fact_subscription_churn",
    "customer_last_order": "SELECT * FROM last_order",
    "fact_customer_health": "SELECT * FROM fact_customer_health",
    "rfm_base": f"SELECT {_RFM} FROM rfm_base",
    "subscriber_tenure": "SELECT * FROM tenure",
    "rfm_quintiles": f"SELECT {_RFM}, monetary_score, frequency_score, recency_score FROM quintiles",
    "fact_customer_rfm": "SELECT * FROM fact_customer_rfm",
    "activity_dates": "SELECT * FROM activity",
    "calendar_spine": "SELECT * FROM spine",
    "refund_baseline": "SELECT * FROM baseline",
    "daily_order_refund": "SELECT * FROM daily",
    "refund_rolling": "SELECT * FROM rolled",
    "fact_refund_alerts": "SELECT * FROM fact_refund_alerts",
    "dq_unique": _unique(),
    "dq_not_null": _not_null(),
    "dq_accepted_values": _accepted(),
    "dq_relationships": _relationships(),
    "dq_cad_orders": f"""SELECT {_ORDER}, {_number("amount_usd")} FROM stg_orders
        WHERE currency = 'CAD' AND amount_usd = amount_original""",
    "dq_cad_refunds": f"""SELECT {_REFUND_OUT} FROM stg_refunds
        WHERE currency = 'CAD' AND amount_usd = amount_original""",
    "dq_duplicate_active": """SELECT customer_key, count(*) AS n_active FROM stg_subscriptions
        WHERE customer_status = 'is_active' GROUP BY 1 HAVING count(*) > 1""",
    "dq_negative_recency": "SELECT * FROM fact_customer_health WHERE days_since_last_order < 0",
    "dq_reactivated": """SELECT f.customer_key FROM fact_subscription_churn f JOIN (
            SELECT customer_key FROM stg_subscriptions GROUP BY 1 HAVING count(*) > 1
            AND sum(CASE WHEN customer_status = 'is_payment_failure_cancelled' THEN 1 ELSE 0 END) > 0
            AND sum(CASE WHEN customer_status = 'is_active' THEN 1 ELSE 0 END) > 0) r USING (customer_key)
        WHERE churn_status <> 'not_churned'""",
    "dq_refund_conservation": """SELECT counted_refunds, stored_refunds, CAST(counted_refunds <> stored_refunds AS BIGINT) AS mismatch
        FROM (SELECT CAST((SELECT sum(daily_refunds) FROM fact_refund_alerts) AS BIGINT) AS counted_refunds,
            (SELECT count(*) FROM stg_refunds) AS stored_refunds)""",
    "dq_rfm_sum": """SELECT * FROM fact_customer_rfm
        WHERE total_score <> monetary_score + frequency_score + recency_score + tenure_bonus""",
    "dq_tenure_history": f"""SELECT f.customer_key FROM fact_customer_rfm f
        JOIN (SELECT DISTINCT customer_key FROM stg_subscriptions WHERE customer_status = 'is_active') a USING (customer_key)
        JOIN (SELECT customer_key, min(subscription_created_at) AS began FROM stg_subscriptions GROUP BY 1) t
            USING (customer_key)
        WHERE f.tenure_bonus = 0
            AND {_days("t.began", f"(SELECT max({_local('order_ts_raw')}) FROM stg_orders)")} >= 90""",
    "dq_revenue_reconcile": f"""SELECT {_number("weekly_usd")}, {_number("orders_usd")},
            CAST(abs(weekly_usd - orders_usd) > 0.10 AS BIGINT) AS mismatch
        FROM (SELECT (SELECT sum(total_revenue) FROM fact_weekly_revenue) AS weekly_usd,
            (SELECT sum(amount_usd) FROM stg_orders) AS orders_usd)""",
}


def statements() -> dict[str, str]:
    """Each query prefixed with all shared views; unused ones cost nothing."""
    shared = ",\n".join(f"{name} AS ({body.strip()})" for name, body in CTES.items())
    return {name: f"WITH {shared}\n{body}" for name, body in BODIES.items()}
