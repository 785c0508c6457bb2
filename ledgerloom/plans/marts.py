"""Mart layer: dimensions and the order-line, payment and order facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import latest_value, spread_join
from ledgerloom.plans.loyalty import fact_card_points_ledger
from ledgerloom.plans.staging import staged_frequent_keys
from ledgerloom.schema import AMOUNT, DISCOUNT_RATE, FACT_COLUMNS

# Payment types that stand for loyalty points.
POINTS_PAYMENT_TYPES = ("points", "loyalty_card")


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers


def dim_products(stg_products: DataFrame) -> DataFrame:
    return stg_products


def price_lines(details: DataFrame) -> DataFrame:
    """Add the gross and net amount of each line, both exact."""
    rate = (F.col("discount_pct") / 100).cast(DISCOUNT_RATE)
    gross = F.col("quantity") * F.col("unit_price")
    return details.withColumn("line_gross", gross).withColumn("line_net", F.col("line_gross") * (1 - rate))


def fact_order_lines(details: DataFrame, products: DataFrame, frequent_products: DataFrame) -> DataFrame:
    """One row per order line, flagged and categorised by its product.

    Priced above the join: gross and net are wide decimals, which need not move with the line.
    """
    catalog = products.select("product_id", F.col("category").alias("product_category"), F.lit(True).alias("_known"))
    lines = spread_join(details, catalog, "product_id", frequent_products, ["order_id", "line_id"])
    flagged = price_lines(lines).withColumn("has_valid_product", F.coalesce("_known", F.lit(False)))
    return flagged.select(*FACT_COLUMNS["fact_order_lines"])


def _is(column: str, *values: str):
    return F.coalesce(F.col(column).isin(*values), F.lit(False))


def fact_payments(payments: DataFrame) -> DataFrame:
    """One row per payment event with status flags and signed amounts split into cash and refund."""
    none = F.lit(0).cast(AMOUNT)
    flagged = payments.withColumns(
        {
            "is_successful_payment": _is("payment_status", "success"),
            "is_refund": _is("payment_status", "refunded") | _is("payment_type", "refund"),
            "is_pending": _is("payment_status", "pending"),
            "is_failed": _is("payment_status", "failed"),
            "is_points_payment": _is("payment_type", *POINTS_PAYMENT_TYPES),
            "is_installment_payment": _is("payment_type", "installment"),
        }
    )
    collected = F.col("is_successful_payment") & (F.col("payment_amount") > 0)
    split = flagged.withColumns(
        {
            "cash_collected_amount": F.when(collected, F.col("payment_amount")).otherwise(none),
            "refund_amount": F.when(F.col("is_refund"), F.abs("payment_amount")).otherwise(none),
        }
    )
    return split.select(*FACT_COLUMNS["fact_payments"])


def order_amounts(lines: DataFrame) -> DataFrame:
    """Expected amount per order; an order whose lines all lack a price is worth 0."""
    return lines.groupBy("order_id").agg(F.coalesce(F.sum("line_net"), F.lit(0)).alias("order_expected_amount"))


def payment_aggregates(payments: DataFrame) -> DataFrame:
    """Payment totals, counts, flags and the latest status per order, in one aggregation."""
    return payments.groupBy("order_id").agg(
        F.sum("cash_collected_amount").alias("total_cash_collected_amount"),
        F.sum("refund_amount").alias("total_refund_amount"),
        F.sum("points_used").alias("points_used"),
        F.count("payment_id").alias("payment_event_count"),
        F.count_if("is_installment_payment").alias("installment_event_count"),
        F.bool_or("is_successful_payment").alias("has_successful_payment"),
        F.bool_or("is_pending").alias("has_pending_payment"),
        latest_value(F.col("payment_status"), F.col("payment_datetime"), F.col("payment_id")).alias(
            "latest_payment_status"
        ),
    )


def latest_payment_status(payments: DataFrame) -> DataFrame:
    """Status of the last payment event per order on its own."""
    return payment_aggregates(payments).select("order_id", "latest_payment_status")


def fact_orders(
    orders: DataFrame,
    customers: DataFrame,
    amounts: DataFrame,
    payments_by_order: DataFrame,
    frequent_customers: DataFrame,
) -> DataFrame:
    """One row per order with its money, payment state and revenue flags.

    The joins on ``order_id`` come first: all three sides are already partitioned by it.
    """
    segments = customers.select("customer_id", F.col("segment").alias("customer_segment"), F.lit(True).alias("_known"))
    joined = orders.join(amounts, "order_id", "left").join(payments_by_order, "order_id", "left")
    joined = spread_join(joined, segments, "customer_id", frequent_customers, ["order_id"])

    # An order without lines or payments has no row in the aggregates: its sums and counts are 0, its flags false.
    measures = {f.name: f.dataType.typeName() for side in (amounts, payments_by_order) for f in side.schema if f.name != "order_id"}
    flags = [name for name, kind in measures.items() if kind == "boolean"]
    joined = joined.na.fill(0, [name for name, kind in measures.items() if kind in ("decimal", "long")])
    joined = joined.na.fill(False, [*flags, "_known"])

    net = F.col("net_collected_amount")
    expected = F.col("order_expected_amount")
    paid = F.coalesce(F.col("order_status") == "paid", F.lit(False))
    with_net = joined.withColumn(
        "net_collected_amount", F.col("total_cash_collected_amount") - F.col("total_refund_amount")
    )
    flagged = with_net.withColumns(
        {
            "has_customer": F.col("_known"),
            "has_any_payment": F.col("payment_event_count") > 0,
            "has_refund": F.col("total_refund_amount") > 0,
            "is_fully_paid": (expected > 0) & (net >= expected),
            "is_partially_paid": (net > 0) & (net < expected),
            "is_overpaid": (expected > 0) & (net > expected),
            "is_valid_revenue": paid & F.col("has_successful_payment") & (net > 0),
        }
    )
    return flagged.select(*FACT_COLUMNS["fact_orders"])


def build_fact_orders(stg: dict[str, DataFrame], frequent: dict[str, DataFrame]) -> DataFrame:
    """``fact_orders`` from staging; the product join is not needed for the amounts."""
    return fact_orders(
        stg["stg_orders_master"],
        stg["stg_customers"],
        order_amounts(price_lines(stg["stg_order_details"])),
        payment_aggregates(fact_payments(stg["stg_payments"])),
        frequent["customer_id"],
    )


def build_marts(stg: dict[str, DataFrame], frequent: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The six mart tables. ``frequent`` lists the frequent join keys; by default staging is asked."""
    frequent = frequent or staged_frequent_keys(stg)
    orders = build_fact_orders(stg, frequent)
    return {
        "dim_customers": dim_customers(stg["stg_customers"]),
        "dim_products": dim_products(stg["stg_products"]),
        "fact_order_lines": fact_order_lines(stg["stg_order_details"], stg["stg_products"], frequent["product_id"]),
        "fact_payments": fact_payments(stg["stg_payments"]),
        "fact_orders": orders,
        "fact_card_points_ledger": fact_card_points_ledger(
            orders, stg["stg_customer_cards"], stg["stg_points_thresholds"], stg["stg_card_points_ledger"], frequent
        ),
    }
