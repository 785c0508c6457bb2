"""Data-quality report: 17 checks from a handful of one-row aggregates, read in one action.

Facts already carry the outcome of their joins as flags, so most checks are conditional counts.
The others count per key before joining: both sides of each join are unique on its key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import whole_number
from ledgerloom.operators import duplicate_rows, require_parsed_keys


class Check(NamedTuple):
    severity: str
    description: str


# Check names, severities and descriptions in report order.
CHECKS: dict[str, Check] = {
    "duplicate_orders": Check("warning", "Rows in orders_master with a duplicated order_id (before dedup)."),
    "duplicate_payment_ids": Check("warning", "Rows in payments with a duplicated payment_id (before dedup)."),
    "orders_without_customer": Check(
        "warning", "Orders whose customer_id does not exist in the customers table."
    ),
    "order_details_without_order": Check(
        "error", "Order detail lines whose order_id does not exist in orders_master."
    ),
    "order_lines_with_invalid_product": Check(
        "warning", "Order lines referencing a product_id not found in the products table."
    ),
    "payments_without_order": Check("error", "Payments whose order_id does not exist in orders_master."),
    "payments_with_invalid_card": Check(
        "warning", "Payments referencing a card_id not present in customer_cards."
    ),
    "payments_with_card_not_owned_by_customer": Check(
        "error", "Payments where the card registered owner differs from the order customer."
    ),
    "payments_using_inactive_or_blocked_card": Check(
        "warning", "Payments made with a card whose status is inactive or blocked."
    ),
    "orders_without_payment": Check("info", "Orders that have no associated payment record."),
    "cancelled_orders_with_successful_payment": Check(
        "warning", "Orders marked cancelled that still have at least one successful payment."
    ),
    "paid_orders_without_successful_payment": Check(
        "error", "Orders marked paid but lacking any successful payment event."
    ),
    "orders_with_negative_expected_amount": Check("error", "Orders whose sum of line_net amounts is negative."),
    "orders_overpaid": Check("info", "Orders where net_collected_amount exceeds the order_expected_amount."),
    "points_used_without_card": Check("warning", "Point-redemption payments where no card_id is recorded."),
    "points_ledger_invalid_card": Check(
        "error", "Points ledger entries referencing a card_id not present in customer_cards."
    ),
    "negative_points_balance": Check("error", "Cards whose cumulative points balance is negative."),
}

Tables = dict[str, DataFrame]


def _total(column: str):
    return F.coalesce(F.sum(column), F.lit(0)).alias(column)


def _raw_id(raw: DataFrame, key: str) -> DataFrame:
    """Raw ids compared as numbers where they are numbers (``1`` and ``1.0`` repeat each other)."""
    ids = raw.select(F.coalesce(whole_number(key, strict=False).cast("string"), F.col(key)).alias(key))
    return require_parsed_keys(ids, key)


def repeated_orders(raw: Tables, stg: Tables, marts: Tables) -> DataFrame:
    return duplicate_rows(_raw_id(raw["orders_master"], "order_id"), "order_id", "duplicate_orders")


def repeated_payments(raw: Tables, stg: Tables, marts: Tables) -> DataFrame:
    return duplicate_rows(_raw_id(raw["payments"], "payment_id"), "payment_id", "duplicate_payment_ids")


def orphans_of_orders(raw: Tables, stg: Tables, marts: Tables) -> DataFrame:
    """Order lines and payments without an order share one anti-join on counts per order.

    ``stg["orphan_lines"]``, if given, holds the lines that can be without one.
    """
    lines, payments = "order_details_without_order", "payments_without_order"
    references = stg.get("orphan_lines", stg["stg_order_details"]).select("order_id", F.lit(1).alias(lines), F.lit(0).alias(payments))
    references = references.unionByName(
        stg["stg_payments"].select("order_id", F.lit(0).alias(lines), F.lit(1).alias(payments))
    )
    per_order = references.groupBy("order_id").agg(_total(lines), _total(payments))
    orphans = per_order.join(stg["stg_orders_master"].select("order_id"), "order_id", "left_anti")
    return orphans.agg(_total(lines), _total(payments))


def order_states(raw: Tables, stg: Tables, marts: Tables) -> DataFrame:
    """Every check that a flag of ``fact_orders`` answers."""
    successful = F.col("has_successful_payment")
    return marts["fact_orders"].agg(
        F.count_if(~F.col("has_customer")).alias("orders_without_customer"),
        F.count_if(~F.col("has_any_payment")).alias("orders_without_payment"),
        F.count_if((F.col("order_status") == "cancelled") & successful).alias(
            "cancelled_orders_with_successful_payment"
        ),
        F.count_if((F.col("order_status") == "paid") & ~successful).alias("paid_orders_without_successful_payment"),
        F.count_if(F.col("order_expected_amount") < 0).alias("orders_with_negative_expected_amount"),
        F.count_if("is_overpaid").alias("orders_overpaid"),
    )


def line_products(raw: Tables, stg: Tables, marts: Tables) -> DataFrame:
    return marts["fact_order_lines"].agg(
        F.count_if(~F.col("has_valid_product")).alias("order_lines_with_invalid_product")
    )


def card_payments(raw: Tables, stg: Tables, marts: Tables) -> DataFrame:
    """Checks on payments that name a card.

    Payments are counted per (order, card), given their order's customer, and counted again per
    (card, customer). A payment is by the owner when that pair is a registered (card, owner)
    pair; the rest of a known card's payments are not, a missing order customer included.
    """
    per_order = (
        stg["stg_payments"].where("card_id <> ''").groupBy("order_id", "card_id").agg(F.count(F.lit(1)).alias("n"))
    )
    buyers = stg["stg_orders_master"].select("order_id", "customer_id")
    per_buyer = (
        per_order.join(buyers, "order_id", "left").groupBy("card_id", "customer_id").agg(F.sum("n").alias("n"))
    )
    owned = stg["stg_customer_cards"].select("card_id", "customer_id", F.lit(True).alias("is_owner"))
    per_card = (
        per_buyer.join(owned, ["card_id", "customer_id"], "left")
        .groupBy("card_id")
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("is_owner"), F.col("n")).otherwise(0)).alias("n_owner"))
    )
    states = stg["stg_customer_cards"].select("card_id", "card_status", F.lit(True).alias("is_known"))
    known = F.coalesce("is_known", F.lit(False))
    unusable = F.coalesce(F.col("card_status").isin("inactive", "blocked"), F.lit(False))

    def total(condition, count, name):
        return F.coalesce(F.sum(F.when(condition, count)), F.lit(0)).alias(name)

    return per_card.join(states, "card_id", "left").agg(
        total(~known, F.col("n"), "payments_with_invalid_card"),
        total(known, F.col("n") - F.col("n_owner"), "payments_with_card_not_owned_by_customer"),
        total(known & unusable, F.col("n"), "payments_using_inactive_or_blocked_card"),
    )


def points_payments(raw: Tables, stg: Tables, marts: Tables) -> DataFrame:
    redeemed = F.col("is_points_payment") & (F.col("points_used") > 0)
    return marts["fact_payments"].agg(
        F.count_if(redeemed & (F.col("card_id") == "")).alias("points_used_without_card")
    )


def ledger_cards(raw: Tables, stg: Tables, marts: Tables) -> DataFrame:
    """Unknown cards and negative balances of the staged ledger, from one row per card."""
    per_card = (
        stg["stg_card_points_ledger"]
        .groupBy("card_id")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("points_delta").alias("balance"))
    )
    known = stg["stg_customer_cards"].select("card_id", F.lit(True).alias("is_known"))
    return per_card.join(known, "card_id", "left").agg(
        F.coalesce(F.sum(F.when(F.col("is_known").isNull(), F.col("events"))), F.lit(0)).alias(
            "points_ledger_invalid_card"
        ),
        F.count_if(F.col("balance") < 0).alias("negative_points_balance"),
    )


# Each aggregate with the checks it answers.
AGGREGATES: dict[Callable[[Tables, Tables, Tables], DataFrame], tuple[str, ...]] = {
    repeated_orders: ("duplicate_orders",),
    repeated_payments: ("duplicate_payment_ids",),
    orphans_of_orders: ("order_details_without_order", "payments_without_order"),
    order_states: (
        "orders_without_customer", "orders_without_payment", "cancelled_orders_with_successful_payment",
        "paid_orders_without_successful_payment", "orders_with_negative_expected_amount", "orders_overpaid",
    ),
    line_products: ("order_lines_with_invalid_product",),
    card_payments: (
        "payments_with_invalid_card", "payments_with_card_not_owned_by_customer",
        "payments_using_inactive_or_blocked_card",
    ),
    points_payments: ("points_used_without_card",),
    ledger_cards: ("points_ledger_invalid_card", "negative_points_balance"),
}


def _report_rows(counts: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Turn a one-row aggregate into one report row per check."""
    position = {name: number for number, name in enumerate(CHECKS)}
    rows = [
        F.struct(
            F.lit(position[name]).alias("_position"),
            F.lit(name).alias("check_name"),
            F.lit(CHECKS[name].severity).alias("severity"),
            F.col(name).cast("bigint").alias("failed_count"),
            F.lit(CHECKS[name].description).alias("description"),
        )
        for name in names
    ]
    return counts.select(F.inline(F.array(*rows)))


def quality_check(name: str, raw: Tables, stg: Tables, marts: Tables) -> DataFrame:
    """The report row of one check; only the aggregate behind it runs."""
    aggregate = next(build for build, names in AGGREGATES.items() if name in names)
    return _report_rows(aggregate(raw, stg, marts), (name,)).drop("_position")


def quality_report(raw: Tables, stg: Tables, marts: Tables) -> DataFrame:
    """All checks in report order."""
    parts = [_report_rows(build(raw, stg, marts), names) for build, names in AGGREGATES.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("_position").drop("_position")
