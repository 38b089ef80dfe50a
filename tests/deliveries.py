"""Writes small raw deliveries in the shape of the five sources."""

from __future__ import annotations

import csv
import json
from pathlib import Path

WEB = {
    "customer_email": "a@x.com", "created_at": "2026-08-03T10:00:00-04:00", "currency": "USD",
    "total_price": 20.5, "source_name": "web", "financial_status": "paid", "cancelled_at": None,
    "refunds": [], "line_items": [{"sku": "COF-1", "name": "beans", "qty": 1, "price": 20.5}],
}
SUB = {
    "customer_email": "a@x.com", "status": "active", "frequency_days": 14,
    "created_at": "2026-05-01T09:00:00-04:00", "next_charge_date": "2026-09-01", "cancelled_at": None,
    "cancellation_reason": None, "linked_shopify_order_id": None,
}
POS = {
    "location_id": "STORE-01", "item_sku": "COF-1", "item_name": "beans", "qty": "1",
    "unit_price": "5.00", "discount": "0.00", "payment_type": "card", "employee_id": "E1",
    "created_at_local": "2026-08-03T09:00:00", "customer_phone": "",
}
SHIP = {
    "tracking_number": "12345678901234567890", "carrier": "UPS", "ship_date": "2026-08-04",
    "status": "delivered", "last_scan_at": "2026-08-05T12:00:00-04:00",
}
TICKET = {
    "requester_email": "a@x.com", "subject": "late", "created_at": "2026-08-03T10:00:00-04:00",
    "tags": "late,refund", "related_order_id": "",
}


def web(order_id, /, **changes):
    return {"order_id": order_id} | WEB | changes


def sub(subscription_id, **changes):
    return {"subscription_id": subscription_id, **SUB, **changes}


def pos(transaction_id, **changes):
    return {"transaction_id": transaction_id, **POS, **changes}


def ship(shipment_id, order_id, **changes):
    return {"shipment_id": shipment_id, "shopify_order_id": order_id, **SHIP, **changes}


def ticket(ticket_id, **changes):
    return {"ticket_id": ticket_id, **TICKET, **changes}


def refund(refund_id, amount, created_at, reason="damaged"):
    return {"refund_id": refund_id, "amount": amount, "created_at": created_at, "reason": reason}


def write_json(raw: Path, source: str, day: str, rows: list[dict]) -> Path:
    path = raw / f"{source}_{day}.json"
    path.write_text(json.dumps(rows, indent=2))
    return path


def write_csv(raw: Path, source: str, day: str, rows: list[dict], columns=None) -> Path:
    path = raw / f"{source}_{day}.csv"
    with path.open("w", newline="") as f:
        writer = csv.DictWriter(f, columns or list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)
    return path


def write_day(raw: Path, day: str, webs, poss, subs, ships, tickets=()) -> None:
    write_json(raw, "shopify_orders", day, webs)
    write_json(raw, "recharge_subscriptions", day, subs)
    write_csv(raw, "square_transactions", day, poss)
    write_csv(raw, "shipstation_shipments", day, ships)
    if tickets:
        write_csv(raw, "zendesk_tickets", day, list(tickets))


def write_seeds(folder: Path) -> dict[str, str]:
    rates, zones = folder / "exchange_rates.csv", folder / "store_timezones.csv"
    days = [f"2026-{m:02d}-{d:02d}" for m in (7, 8) for d in range(1, 32)]
    lines = [f"{d},{c},{r}" for d in days for c, r in (("USD", "1.00000000"), ("CAD", "0.72322456"))]
    rates.write_text("\n".join(["currency_date,currency,rate_to_usd", *lines]) + "\n")
    zones.write_text(
        "location_id,timezone_name\nSTORE-01,America/New_York\nSTORE-02,America/Chicago\n"
    )
    return {"exchange_rates": str(rates), "store_timezones": str(zones)}
