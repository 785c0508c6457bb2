"""Staging layer: typed, normalised, deduplicated copies of the raw tables.

``typed_*`` functions are narrow projections of a raw table. A null business key can never
survive the key filter, so it is removed before deduplication, where it would otherwise be the
hottest key; every other required column is checked after it, because the *last* copy decides.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import (
    amount_value,
    boolean_value,
    datetime_value,
    lower_text,
    price_value,
    strip_text,
    title_text,
    upper_text,
    whole_number,
)
from ledgerloom.operators import (
    dedup_exact,
    dedup_latest,
    frequent_keys,
    require_keys,
    require_parsed_keys,
    require_parsed_text,
)
from ledgerloom.schema import AMOUNT, INGEST_ORDINAL, PERCENT, POINTS, PRICE, QUANTITY, RAW_COLUMNS


# Line numbers of an order that are brought together to find copies.
LINES_TOGETHER = 1024


def _blank_filled(name: str):
    return F.coalesce(upper_text(name), F.lit("")).alias(name)


def _zero_filled(name: str, decimal_type: str):
    return F.coalesce(amount_value(name, decimal_type), F.lit(0).cast(decimal_type)).alias(name)


def typed_orders(raw: DataFrame, datetime_formats: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        whole_number("order_id").alias("order_id"),
        whole_number("customer_id").alias("customer_id"),
        datetime_value("order_date", datetime_formats).alias("order_date"),
        lower_text("order_status").alias("order_status"),
        lower_text("sales_channel").alias("sales_channel"),
        upper_text("currency").alias("currency"),
        INGEST_ORDINAL,
    )


def stg_orders_master(raw: DataFrame, datetime_formats: Sequence[str] = ()) -> DataFrame:
    keyed = require_parsed_keys(typed_orders(raw, datetime_formats), "order_id")
    return require_keys(dedup_latest(keyed, "order_id"), "customer_id")


def typed_order_details(raw: DataFrame) -> DataFrame:
    quantity = amount_value("quantity", QUANTITY)
    return raw.select(
        whole_number("order_id").alias("order_id"),
        whole_number("line_id").alias("line_id"),
        _blank_filled("product_id"),
        F.coalesce(quantity, F.lit(1).cast(QUANTITY)).alias("quantity"),
        price_value("unit_price", PRICE).alias("unit_price"),
        _zero_filled("discount_pct", PERCENT),
    )


def keyed_order_details(raw: DataFrame) -> DataFrame:
    """Typed lines with their keys, exact copies among them."""
    return require_parsed_keys(typed_order_details(raw), "order_id", "line_id")


def stg_order_details(raw: DataFrame) -> DataFrame:
    """Exact copies of a line are dropped; the same product twice in one order is kept."""
    return distinct_lines(keyed_order_details(raw))


def distinct_lines(lines: DataFrame) -> DataFrame:
    """Typed lines without exact copies.

    Copies share order and line number, so lines meet by these, ``LINES_TOGETHER`` numbers of an order in one place: its
    amounts are summed there before they move, and an order of very many lines still spreads.
    """
    met = lines.withColumn("_lines", F.expr(f"line_id div {LINES_TOGETHER}")).repartition("order_id", "_lines")
    return dedup_exact(met, [*RAW_COLUMNS["order_details"], "_lines"]).drop("_lines")


def order_details_without(raw: DataFrame, orders: DataFrame) -> DataFrame:
    """The staged lines of orders that ``orders`` lacks, for plans that need no others.

    The order ids are told apart first, so whole lines meet, and are held to find copies, only where they are kept.
    """
    lines = keyed_order_details(raw)
    lacking = lines.select("order_id").distinct().join(orders.select("order_id"), "order_id", "left_anti")
    return dedup_exact(lines.join(lacking, "order_id", "left_semi"), RAW_COLUMNS["order_details"])


def typed_payments(raw: DataFrame, datetime_formats: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        whole_number("payment_id").alias("payment_id"),
        whole_number("order_id").alias("order_id"),
        datetime_value("payment_datetime", datetime_formats).alias("payment_datetime"),
        lower_text("payment_type").alias("payment_type"),
        lower_text("payment_status").alias("payment_status"),
        _zero_filled("payment_amount", AMOUNT),
        _blank_filled("card_id"),
        _zero_filled("points_used", POINTS),
        INGEST_ORDINAL,
    )


def stg_payments(raw: DataFrame, datetime_formats: Sequence[str] = ()) -> DataFrame:
    keyed = require_parsed_keys(typed_payments(raw, datetime_formats), "payment_id")
    return require_keys(dedup_latest(keyed, "payment_id"), "order_id")


def typed_customers(raw: DataFrame, datetime_formats: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        whole_number("customer_id").alias("customer_id"),
        strip_text("customer_name").alias("customer_name"),
        upper_text("segment").alias("segment"),
        title_text("country").alias("country"),
        datetime_value("signup_date", datetime_formats).alias("signup_date"),
        "email",
        INGEST_ORDINAL,
    )


def stg_customers(raw: DataFrame, datetime_formats: Sequence[str] = ()) -> DataFrame:
    return dedup_latest(require_parsed_keys(typed_customers(raw, datetime_formats), "customer_id"), "customer_id")


def typed_customer_cards(raw: DataFrame, datetime_formats: Sequence[str] = ()) -> DataFrame:
    return raw.select(
        _blank_filled("card_id"),
        whole_number("customer_id").alias("customer_id"),
        datetime_value("card_created_at", datetime_formats).alias("card_created_at"),
        lower_text("card_status").alias("card_status"),
        INGEST_ORDINAL,
    )


def stg_customer_cards(raw: DataFrame, datetime_formats: Sequence[str] = ()) -> DataFrame:
    keyed = require_parsed_text(typed_customer_cards(raw, datetime_formats), "card_id")
    return require_keys(dedup_latest(keyed, "card_id"), "customer_id")


def typed_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        _blank_filled("product_id"),
        strip_text("product_name").alias("product_name"),
        title_text("category").alias("category"),
        amount_value("standard_price", PRICE).alias("standard_price"),
        boolean_value("is_active").alias("is_active"),
        INGEST_ORDINAL,
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return dedup_latest(require_parsed_text(typed_products(raw), "product_id"), "product_id")


def stg_points_thresholds(raw: DataFrame) -> DataFrame:
    """Tiers are not deduplicated; a missing upper bound means the tier is open."""
    tiers = raw.select(
        whole_number("threshold_id").alias("threshold_id"),
        amount_value("min_amount").alias("min_amount"),
        amount_value("max_amount").alias("max_amount"),
        amount_value("points_awarded", POINTS).alias("points_awarded"),
    )
    return require_parsed_keys(tiers, "threshold_id", "min_amount", "points_awarded")


def stg_card_points_ledger(raw: DataFrame, datetime_formats: Sequence[str] = ()) -> DataFrame:
    """Ledger events are not deduplicated. An owner carried by the raw ledger is kept."""
    owner = [whole_number("customer_id").alias("customer_id")] if "customer_id" in raw.columns else []
    events = raw.select(
        "ledger_id",
        _blank_filled("card_id"),
        whole_number("order_id").alias("order_id"),
        datetime_value("event_datetime", datetime_formats).alias("event_datetime"),
        lower_text("event_type").alias("event_type"),
        _zero_filled("points_delta", POINTS),
        *owner,
    )
    return require_parsed_text(events, "card_id")


# Staging table -> (raw table, builder).
BUILDERS: dict[str, tuple[str, Callable[[DataFrame, Sequence[str]], DataFrame]]] = {
    "stg_orders_master": ("orders_master", stg_orders_master),
    "stg_order_details": ("order_details", lambda raw, _: stg_order_details(raw)),
    "stg_payments": ("payments", stg_payments),
    "stg_customers": ("customers", stg_customers),
    "stg_customer_cards": ("customer_cards", stg_customer_cards),
    "stg_products": ("products", lambda raw, _: stg_products(raw)),
    "stg_points_thresholds": ("points_thresholds", lambda raw, _: stg_points_thresholds(raw)),
    "stg_card_points_ledger": ("card_points_ledger", stg_card_points_ledger),
}


def build_staging(raw: dict[str, DataFrame], datetime_formats: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The staging table of every raw table given, all eight in a full run."""
    return {
        name: build(raw[source], datetime_formats) for name, (source, build) in BUILDERS.items() if source in raw
    }


# Join key -> (raw table and its typed form, staging table) that show how often each key occurs.
KEY_SOURCES: dict[str, tuple[str, Callable[[DataFrame], DataFrame], str]] = {
    "customer_id": ("orders_master", typed_orders, "stg_orders_master"),
    "product_id": ("order_details", typed_order_details, "stg_order_details"),
    "card_id": ("card_points_ledger", stg_card_points_ledger, "stg_card_points_ledger"),
}


def raw_frequent_keys(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Frequent join keys read straight from the raw rows, for callers that have no written staging."""
    return {
        key: frequent_keys(require_parsed_keys(typed(raw[source]), key), key)
        for key, (source, typed, _) in KEY_SOURCES.items()
        if source in raw
    }


def staged_frequent_keys(stg: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Frequent join keys of written staging tables; reads one column of each."""
    return {key: frequent_keys(stg[table], key) for key, (_, _, table) in KEY_SOURCES.items() if table in stg}
