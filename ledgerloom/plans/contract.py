"""Schema validation of the raw tables: unreadable or ill-fitting cells, missing keys and unexpected values.

Nothing raises here, so a table that staging refuses can be looked into.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import boolean_value, datetime_value, lower_text, whole_number
from ledgerloom.functions.numbers import is_number, price_text, unfit_id, unfit_number
from ledgerloom.schema import AMOUNT, OPTIONAL_COLUMNS, PERCENT, PRICE, QUANTITY

# Kind of number -> its type.
NUMBER_TYPES = {"amount": AMOUNT, "quantity": QUANTITY, "price": PRICE, "list_price": PRICE, "percent": PERCENT}
# The widest type that numbers are compared in, to see whether decimals were lost.
WIDE = "decimal(38,18)"

# How each raw column must read; columns not listed are free text.
COLUMN_KINDS: dict[str, dict[str, str]] = {
    "customers": {"customer_id": "id", "signup_date": "datetime"},
    "customer_cards": {"customer_id": "id", "card_created_at": "datetime"},
    "products": {"standard_price": "list_price", "is_active": "boolean"},
    "orders_master": {"order_id": "id", "customer_id": "id", "order_date": "datetime"},
    "order_details": {
        "order_id": "id", "line_id": "id", "quantity": "quantity", "unit_price": "price", "discount_pct": "percent",
    },
    "payments": {
        "payment_id": "id", "order_id": "id", "payment_datetime": "datetime",
        "payment_amount": "amount", "points_used": "amount",
    },
    "points_thresholds": {"threshold_id": "id", "min_amount": "amount", "max_amount": "amount", "points_awarded": "amount"},
    "card_points_ledger": {"order_id": "id", "event_datetime": "datetime", "points_delta": "amount"},
}

# Columns that a staging row cannot do without.
REQUIRED: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "customer_cards": ("card_id", "customer_id"),
    "products": ("product_id",),
    "orders_master": ("order_id", "customer_id"),
    "order_details": ("order_id", "line_id"),
    "payments": ("payment_id", "order_id"),
    "points_thresholds": ("threshold_id", "min_amount", "points_awarded"),
    "card_points_ledger": ("card_id",),
}

# The documented value sets.
ALLOWED: dict[str, dict[str, tuple[str, ...]]] = {
    "payments": {
        "payment_type": ("card", "cash", "installment", "loyalty_card", "points", "refund"),
        "payment_status": ("success", "failed", "pending", "refunded"),
    },
    "customer_cards": {"card_status": ("active", "inactive", "blocked")},
}


def number_text(name: str, kind: str) -> str:
    """SQL of the text of a number cell; line prices may carry a suffix."""
    return price_text(name) if kind == "price" else f"`{name}`"


def unfit_cells(table: str, columns: Sequence[str]) -> list[tuple[str, Column]]:
    """``(column, cell is a number that its type cannot hold)`` for the ids and numbers of a raw table."""
    kinds = COLUMN_KINDS[table] | {c: "id" for c in OPTIONAL_COLUMNS.get(table, ()) if c in columns}
    found = []
    for name, kind in kinds.items():
        if kind == "id":
            found.append((name, F.expr(unfit_id(name))))
        elif kind in NUMBER_TYPES:
            found.append((name, F.expr(unfit_number(number_text(name, kind), NUMBER_TYPES[kind]))))
    return [(name, F.coalesce(unfit, F.lit(False))) for name, unfit in found]


def number_rules(name: str, kind: str) -> list[tuple[str, str, Column]]:
    """A cell is no number, is one that its type cannot hold, or loses decimals in it."""
    text = number_text(name, kind)
    value = f"try_cast({text} AS {NUMBER_TYPES[kind]})"
    return [
        (name, "unreadable", F.expr(f"`{name}` IS NOT NULL AND {value} IS NULL AND NOT {is_number(text)}")),
        (name, "out_of_range", F.expr(f"`{name}` IS NOT NULL AND {value} IS NULL AND {is_number(text)}")),
        (name, "rounded", F.expr(f"coalesce(try_cast({text} AS {WIDE}) <> {value}, false)")),
    ]


def table_rules(table: str, datetime_formats: Sequence[str] = ()) -> list[tuple[str, str, Column]]:
    """``(column, rule, is violated)`` for every rule of a raw table."""
    readers = {
        "datetime": lambda name: datetime_value(name, datetime_formats),
        "boolean": boolean_value,
    }
    rules = [(name, "missing", F.col(name).isNull()) for name in REQUIRED[table]]
    for name, kind in COLUMN_KINDS[table].items():
        if kind in NUMBER_TYPES:
            rules += number_rules(name, kind)
        elif kind == "id":
            lost = F.col(name).isNotNull() & whole_number(name, strict=False).isNull()
            unfit = F.coalesce(F.expr(unfit_id(name)), F.lit(False))
            rules += [(name, "unreadable", lost & ~unfit), (name, "out_of_range", unfit)]
        else:
            rules.append((name, "unreadable", F.col(name).isNotNull() & readers[kind](name).isNull()))
    rules += [
        (name, "unexpected", F.col(name).isNotNull() & ~lower_text(name).isin(*values))
        for name, values in ALLOWED.get(table, {}).items()
    ]
    return rules


def validate_table(raw: DataFrame, table: str, datetime_formats: Sequence[str] = ()) -> DataFrame:
    """``(table_name, column_name, rule, failed_count)`` from one pass over the raw table."""
    rules = table_rules(table, datetime_formats)
    counts = raw.agg(*(F.count_if(violated).alias(f"{name}_{rule}") for name, rule, violated in rules))
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("column_name"),
            F.lit(rule).alias("rule"),
            F.col(f"{name}_{rule}").alias("failed_count"),
        )
        for name, rule, _ in rules
    ]
    return counts.select(F.inline(F.array(*rows)))


def validate_raw(raw: dict[str, DataFrame], datetime_formats: Sequence[str] = ()) -> DataFrame:
    """All rules of all raw tables given."""
    return reduce(DataFrame.unionByName, (validate_table(df, table, datetime_formats) for table, df in raw.items()))
