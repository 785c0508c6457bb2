"""Analytics layer: revenue reports, card summary and KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import guarded_ratio, rounded_double

# The KPI names in report order.
KPI_NAMES = (
    "total_orders", "valid_revenue_orders", "conversion_rate",
    "total_expected_revenue", "total_cash_collected", "total_refunds", "net_collected_revenue",
    "avg_order_value", "partial_payment_orders", "overpaid_orders", "cancelled_orders_with_payment",
    "active_cards", "points_earned", "points_redeemed", "points_liability",
    "orders_paid_with_points", "loyalty_revenue_share",
)

# The columns of the facts that the KPIs read.
KPI_ORDER_COLUMNS = (
    "customer_id", "order_status", "order_expected_amount", "total_cash_collected_amount", "total_refund_amount",
    "net_collected_amount", "points_used", "has_any_payment", "is_partially_paid", "is_overpaid", "is_valid_revenue",
)
KPI_LEDGER_COLUMNS = ("card_id", "points_delta", "customer_id", "card_status")


def revenue_by_day(orders: DataFrame) -> DataFrame:
    """Valid revenue per order date; orders without a date are not reported."""
    return (
        orders.where("is_valid_revenue AND order_date IS NOT NULL")
        .groupBy(F.to_date("order_date").alias("order_date"))
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("order_expected_amount").alias("total_expected_revenue"),
            F.sum("total_cash_collected_amount").alias("total_cash_collected"),
            F.sum("total_refund_amount").alias("total_refunds"),
            F.sum("net_collected_amount").alias("net_collected_revenue"),
        )
        .orderBy("order_date")
    )


def segment_report(per_segment: DataFrame) -> DataFrame:
    """The segment report from counts and sums per segment."""
    net = F.col("net_collected_revenue")
    return per_segment.select(
        "customer_segment",
        "order_count",
        "total_expected_revenue",
        "net_collected_revenue",
        (net.cast("double") / F.col("order_count")).alias("avg_order_value"),
    ).orderBy(F.desc("net_collected_revenue"))


def revenue_by_customer_segment(orders: DataFrame) -> DataFrame:
    """Valid revenue per customer segment; orders without a segment are not reported."""
    per_segment = (
        orders.where("is_valid_revenue AND customer_segment IS NOT NULL")
        .groupBy("customer_segment")
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("order_expected_amount").alias("total_expected_revenue"),
            F.sum("net_collected_amount").alias("net_collected_revenue"),
        )
    )
    return segment_report(per_segment)


def card_totals(ledger: DataFrame) -> DataFrame:
    """Exact point totals per card. The status depends on the card, so it groups for free."""
    delta = F.col("points_delta")
    return ledger.groupBy("card_id", "card_status").agg(
        F.coalesce(F.sum(F.when(delta > 0, delta)), F.lit(0)).alias("earned"),
        F.coalesce(F.sum(F.when(delta < 0, -delta)), F.lit(0)).alias("redeemed"),
        F.sum(delta).alias("balance"),
        F.count(delta).alias("transaction_count"),
        F.max("customer_id").alias("customer_id"),
    )


def card_summary(totals: DataFrame) -> DataFrame:
    """The card report from the totals per card."""
    return totals.select(
        "card_id",
        F.col("earned").cast("bigint").alias("points_earned"),
        F.col("redeemed").cast("bigint").alias("points_redeemed"),
        F.col("balance").alias("points_balance"),
        "transaction_count",
        "customer_id",
        "card_status",
    )


def loyalty_card_summary(ledger: DataFrame) -> DataFrame:
    """Points earned, redeemed and left per card."""
    return card_summary(card_totals(ledger))


def order_measures(orders: DataFrame) -> DataFrame:
    """One row of order counts and valid-revenue sums."""
    valid = F.col("is_valid_revenue")

    def valid_sum(name: str):
        return F.coalesce(F.sum(F.when(valid, F.col(name))), F.lit(0))

    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(valid).alias("valid_revenue_orders"),
        valid_sum("order_expected_amount").alias("expected"),
        valid_sum("total_cash_collected_amount").alias("cash"),
        valid_sum("total_refund_amount").alias("refunds"),
        valid_sum("net_collected_amount").alias("net"),
        F.count_if("is_partially_paid").alias("partial_payment_orders"),
        F.count_if("is_overpaid").alias("overpaid_orders"),
        F.count_if((F.col("order_status") == "cancelled") & F.col("has_any_payment")).alias(
            "cancelled_orders_with_payment"
        ),
        F.count_if(valid & (F.col("points_used") > 0)).alias("orders_paid_with_points"),
    )


def _point_measures(totals: DataFrame) -> DataFrame:
    """One row of point sums over the per-card totals."""
    return totals.agg(
        F.count_if(F.col("card_status") == "active").alias("active_cards"),
        F.coalesce(F.sum("earned"), F.lit(0)).cast("bigint").alias("points_earned"),
        F.coalesce(F.sum("redeemed"), F.lit(0)).cast("bigint").alias("points_redeemed"),
        F.coalesce(F.sum(F.when(F.col("balance") > 0, F.col("balance"))), F.lit(0))
        .cast("bigint")
        .alias("points_liability"),
    )


def _loyal_revenue(orders: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: valid revenue of customers who own an active card that appears in the ledger.

    Revenue is summed per customer first, so both sides of the join are unique on the key.
    """
    per_customer = (
        orders.where("is_valid_revenue").groupBy("customer_id").agg(F.sum("net_collected_amount").alias("net"))
    )
    loyal = ledger.where("card_status = 'active'").select("customer_id").distinct()
    return per_customer.join(loyal, "customer_id", "left_semi").agg(
        F.coalesce(F.sum("net"), F.lit(0)).alias("loyal_net")
    )


def kpi_summary(orders: DataFrame, ledger: DataFrame) -> DataFrame:
    """The 17 KPIs as ``(kpi_name, kpi_value)`` rows, in report order."""
    return kpi_rows(order_measures(orders), card_totals(ledger), _loyal_revenue(orders, ledger))


def kpi_rows(order_sums: DataFrame, totals: DataFrame, loyal_revenue: DataFrame) -> DataFrame:
    """The KPIs from one row of order measures; the point sums over the cards and the loyal revenue enter as scalars."""
    points = _point_measures(totals).select(F.struct("*").alias("points")).scalar()
    measures = order_sums.select("*", points.alias("points"), loyal_revenue.scalar().alias("loyal_net"))
    values = {
        "conversion_rate": rounded_double(guarded_ratio(F.col("valid_revenue_orders"), F.col("total_orders")), 6),
        "total_expected_revenue": rounded_double(F.col("expected"), 2),
        "total_cash_collected": rounded_double(F.col("cash"), 2),
        "total_refunds": rounded_double(F.col("refunds"), 2),
        "net_collected_revenue": rounded_double(F.col("net"), 2),
        "avg_order_value": rounded_double(guarded_ratio(F.col("net"), F.col("valid_revenue_orders")), 2),
        "active_cards": F.col("points.active_cards"),
        "points_earned": F.col("points.points_earned"),
        "points_redeemed": F.col("points.points_redeemed"),
        "points_liability": F.col("points.points_liability"),
        "loyalty_revenue_share": rounded_double(guarded_ratio(F.col("loyal_net"), F.col("net")), 6),
    }
    rows = [
        F.struct(F.lit(name).alias("kpi_name"), values.get(name, F.col(name)).cast("double").alias("kpi_value"))
        for name in KPI_NAMES
    ]
    return measures.select(F.inline(F.array(*rows)))


def build_analytics(marts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four analytics tables."""
    orders, ledger = marts["fact_orders"], marts["fact_card_points_ledger"]
    return {
        "revenue_by_day": revenue_by_day(orders),
        "revenue_by_customer_segment": revenue_by_customer_segment(orders),
        "loyalty_card_summary": loyalty_card_summary(ledger),
        "kpi_summary": kpi_summary(orders, ledger),
    }
