"""Small known inputs with known results."""

from __future__ import annotations

import json

# Nine orders of a garden shop: days with one, two and three orders, one cancelled.
ORDERS = [
    # customer, product, quantity, unit price, status, moment
    (11, "Clay Pot", 4, 6.5, "completed", "2023-11-03 07:05:00"),
    (12, "Garden Hose", 1, 31.2, "cancelled", "2023-11-03 12:40:00"),
    (13, "Seed Tray", 10, 1.75, "completed", "2023-11-03 18:00:10"),
    (11, "Watering Can", 1, 18.9, "pending", "2023-11-04 09:09:09"),
    (14, "Trellis", 2, 44.0, "completed", "2023-11-07 00:00:00"),
    (12, "Clay Pot", 6, 6.5, "completed", "2023-11-07 23:59:59"),
    (15, "Rake", 1, 27.35, "shipped", "2023-11-07 15:30:00"),
    (13, "Seed Tray", 2, 1.75, "shipped", "2024-02-29 10:10:10"),
    (16, "Wheelbarrow", 1, 139.99, "completed", "2024-02-29 11:11:11"),
]
# Seven events: four views by three users in three sessions, one purchase.
EVENTS = [
    # user, type, session, device, country, moment
    (31, "page_view", 1, "tv", "NO", "2023-11-03T05:00:00Z"),
    (31, "page_view", 1, "tv", "NO", "2023-11-03T05:01:00Z"),
    (32, "page_view", 2, "watch", "NZ", "2023-11-04T06:00:00Z"),
    (32, "click", 2, "watch", "NZ", "2023-11-04T06:00:30Z"),
    (33, "purchase", 3, "tv", "NO", "2023-11-04T07:00:00Z"),
    (34, "page_view", 4, "tv", "PT", "2023-11-05T08:00:00Z"),
    (34, "click", 4, "tv", "PT", "2023-11-05T08:10:00Z"),
]


def orders_csv() -> str:
    lines = ["order_id,customer_id,product_name,quantity,unit_price,total_amount,status,created_at"]
    for n, (customer, product, quantity, price, status, moment) in enumerate(ORDERS, 1):
        total = f"{quantity * price:.2f}"
        lines.append(f"G-{n},B-{customer},{product},{quantity},{price},{total},{status},{moment}")
    return "\n".join(lines) + "\n"


def events_json() -> str:
    purchases = 0
    rows = []
    for n, (user, kind, session, device, country, moment) in enumerate(EVENTS, 1):
        row = {
            "event_id": f"E-{n}",
            "user_id": f"U{user}",
            "event_type": kind,
            "session_id": f"S{session}",
            "device": device,
            "country": country,
            "timestamp": moment,
        }
        if kind == "purchase":
            purchases += 1
            row["order_id"] = f"G-{purchases}"
        rows.append(row)
    return json.dumps(rows, indent=1)


FAULT_DDL = (
    "order_id string, customer_id string, product_name string, quantity int, unit_price double,"
    " total_amount double, status string, created_at string"
)
# One row without an id, one pair of copies, one row that breaks two rules.
FAULTS = [
    (None, "B-7", "Lost Label", 3, 2.0, 6.0, "pending", "2024-03-01 01:00:00"),
    ("G-TWO", "B-8", "Twine", 5, 0.8, 4.0, "completed", "2024-03-01 02:00:00"),
    ("G-TWO", "B-8", "Twine", 5, 0.8, 4.0, "completed", "2024-03-01 02:00:00"),
    ("G-ZERO", "B-9", "Gift", 0, 5.0, -1.0, "odd", "2024-03-02 03:00:00"),
]
