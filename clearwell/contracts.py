"""Data contracts: the typed columns of a table and the rules its rows must meet."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


class ContractError(ValueError):
    """The input cannot be brought into the shape the contract asks for."""


@dataclass(frozen=True)
class Contract:
    """Columns in order with their Spark type names, and the row rules.

    A column under ``not_null`` is required: it is never invented when the input
    lacks it. Every other column of the contract is added as NULL.
    ``date_column`` names the column that dates a row; by default it is chosen
    from the well-known names.
    """

    name: str
    columns: Mapping[str, str] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    date_column: str | None = None


# The two contracts of the lake.
ORDERS = Contract(
    name="orders",
    columns={
        "order_id": "string",
        "customer_id": "string",
        "product_name": "string",
        "quantity": "int",
        "unit_price": "double",
        "total_amount": "double",
        "status": "string",
        "created_at": "timestamp",
    },
    not_null=("order_id", "customer_id"),
    positive=("quantity", "total_amount"),
)
EVENTS = Contract(
    name="events",
    columns={
        "event_id": "string",
        "user_id": "string",
        "event_type": "string",
        "page": "string",
        "session_id": "string",
        "device": "string",
        "country": "string",
        "timestamp": "timestamp",
        "order_id": "string",
    },
    not_null=("event_id", "user_id"),
)

_BY_TABLE = {contract.name: contract for contract in (ORDERS, EVENTS)}


def contract_for(table: str) -> Contract:
    """The contract of a table; an unknown table has no columns and no rules."""
    return _BY_TABLE.get(table, Contract(table))
