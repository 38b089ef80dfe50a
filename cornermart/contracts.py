"""Source catalogue and the declared bronze schemas; nothing is ever inferred from a day's data."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

APPEND, SNAPSHOT = "append", "snapshot"
PARTITION = "_run_date"


class ContractError(ValueError):
    """A delivery does not match its declared schema."""


@dataclass(frozen=True)
class SourceSpec:
    """One upstream export. ``append``: each day is new facts; ``snapshot``: full state per day."""

    name: str
    format: str
    load_strategy: str
    required: bool = True
    json_lines: bool = False  # one object per line instead of one array per file: splittable


def _text(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


MONEY = DecimalType(18, 4)

LINEAGE = StructType(
    [
        StructField("_source_system", StringType()),
        StructField("_ingested_at", TimestampType()),
        StructField(PARTITION, DateType()),
    ]
)

# The five sources and their columns.
SOURCES = (
    SourceSpec("shopify_orders", "json", APPEND),
    SourceSpec("square_transactions", "csv", APPEND),
    SourceSpec("recharge_subscriptions", "json", SNAPSHOT),
    SourceSpec("zendesk_tickets", "csv", APPEND, required=False),
    SourceSpec("shipstation_shipments", "csv", APPEND),
)

CONTRACTS: dict[str, StructType] = {
    "shopify_orders": StructType(
        [
            *_text("order_id", "customer_email", "created_at", "currency"),
            StructField("total_price", MONEY),
            *_text("source_name", "financial_status", "cancelled_at"),
            StructField(
                "refunds",
                ArrayType(
                    StructType(
                        [
                            *_text("refund_id"),
                            StructField("amount", MONEY),
                            *_text("created_at", "reason"),
                        ]
                    )
                ),
            ),
            StructField(
                "line_items",
                ArrayType(
                    StructType(
                        [
                            *_text("sku", "name"),
                            StructField("qty", LongType()),
                            StructField("price", MONEY),
                        ]
                    )
                ),
            ),
        ]
    ),
    "recharge_subscriptions": StructType(
        [
            *_text("subscription_id", "customer_email", "status"),
            StructField("frequency_days", LongType()),
            *_text(
                "created_at",
                "next_charge_date",
                "cancelled_at",
                "cancellation_reason",
                "linked_shopify_order_id",
            ),
        ]
    ),
    "square_transactions": StructType(
        _text(
            "transaction_id", "location_id", "item_sku", "item_name", "qty", "unit_price", "discount",
            "payment_type", "employee_id", "created_at_local", "customer_phone",
        )
    ),
    "zendesk_tickets": StructType(
        _text("ticket_id", "requester_email", "subject", "created_at", "tags", "related_order_id")
    ),
    "shipstation_shipments": StructType(
        _text(
            "shipment_id", "shopify_order_id", "tracking_number", "carrier", "ship_date", "status",
            "last_scan_at",
        )
    ),
}

# Stored shapes of the incrementally built tables; refunds carry their partition day.
SILVER = {
    "stg_customers": "customer_key string, customer_type string, first_seen_run_date date",
    "stg_orders": (
        "order_id string, customer_key string, channel string, currency string,"
        " amount_original decimal(26,8), order_ts_raw timestamp_ntz, amount_usd decimal(37,14),"
        " order_run_date date"
    ),
    "stg_refunds": (
        "refund_id string, order_id string, customer_key string, amount_original decimal(26,8),"
        " currency string, amount_usd decimal(37,14), reason string, delivered_at timestamp_ntz,"
        " refund_ts timestamp_ntz, days_since_delivery int, order_run_date date,"
        " within_policy_window boolean, refunded_before_delivery_confirmed boolean,"
        " refund_date date"
    ),
}


def silver_schema(name: str) -> StructType:
    return StructType.fromDDL(SILVER[name])


def declared_schema(layer: str | None, name: str) -> StructType | None:
    """Schema of a stored table where one is declared; others are read as written."""
    if layer == "bronze" and name in CONTRACTS:
        return bronze_schema(name)
    return silver_schema(name) if layer == "silver" and name in SILVER else None


def source(name: str) -> SourceSpec:
    return next(s for s in SOURCES if s.name == name)


def bronze_schema(name: str) -> StructType:
    """Contract columns followed by the lineage columns."""
    return StructType([*CONTRACTS[name].fields, *LINEAGE.fields])


def signature(dtype: DataType) -> object:
    """Order- and nullability-independent shape of a type, nested parts included."""
    if isinstance(dtype, StructType):
        return frozenset((f.name, signature(f.dataType)) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return ("array", signature(dtype.elementType))
    return dtype.simpleString()


def schema_diff(stored: StructType, declared: StructType) -> list[tuple[str, str | None, str | None]]:
    """(column, stored type, declared type) of each column whose shapes differ, None where absent."""
    have, want = ({f.name: f.dataType for f in schema.fields} for schema in (stored, declared))
    return [
        (name, *(d.simpleString() if d is not None else None for d in (have.get(name), want.get(name))))
        for name in sorted(have.keys() | want.keys())
        if name not in have or name not in want or signature(have[name]) != signature(want[name])
    ]


def parse_run_date(text: str | None) -> date:
    """ISO day of a run; today when absent."""
    if text is None:
        return date.today()
    try:
        return date.fromisoformat(text)
    except ValueError as exc:
        raise ValueError(f"invalid run date {text!r}, expected YYYY-MM-DD") from exc
