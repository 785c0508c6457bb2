"""Points spent: redemption events of points payments, and the balance a card had at a payment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import frequent_keys, running_total, spread_join


def points_spent(payments: DataFrame) -> DataFrame:
    """Points payments that name a card and use points."""
    return payments.where("is_points_payment AND points_used > 0 AND card_id <> ''")


def redemption_events(payments: DataFrame, ledger: DataFrame) -> DataFrame:
    """Redeem events of successful points payments that the ledger lacks for the card and order."""
    spent = points_spent(payments).where("is_successful_payment")
    events = spent.select(
        "payment_id", "card_id", "order_id",
        F.col("payment_datetime").alias("event_datetime"),
        F.lit("redeem").alias("event_type"),
        (-F.col("points_used")).alias("points_delta"),
        F.lit("computed_redemption").alias("ledger_source"),
    )
    already = (
        ledger.where("event_type = 'redeem' AND order_id IS NOT NULL").select("card_id", "order_id").distinct()
    )
    frequent = frequent_keys(spent, "order_id")
    return spread_join(events, already, "order_id", frequent, ["payment_id"], "left_anti", ["card_id"])


def balance_at_payment(payments: DataFrame, ledger: DataFrame, folder: str) -> DataFrame:
    """Card balance at each points payment, on one timeline of ledger events and computed redemptions.

    A payment sees all ledger events up to and including its time, and the redemptions (not booked in the ledger) of
    the payments before it: earlier ones, and those of its time with a smaller id. Events of unknown time come last; a
    payment of unknown time sees the whole ledger. ``folder`` holds the ordered rows between two passes.
    """
    movements = ledger.groupBy("card_id", F.col("event_datetime").alias("at")).agg(
        F.sum("points_delta").alias("points_delta")
    )
    redeemed = redemption_events(payments, ledger).select("payment_id", "points_delta")
    asked = (
        points_spent(payments)
        .select("card_id", F.col("payment_datetime").alias("at"), "payment_id", "order_id", "points_used")
        .join(redeemed, "payment_id", "left")
    )
    timeline = movements.unionByName(asked, allowMissingColumns=True).select(
        "card_id", F.col("at").isNull().alias("undated"), "at",
        F.col("payment_id").isNotNull().alias("is_payment"),
        "payment_id", "order_id", "points_used", "points_delta",
    )
    order = ["undated", "at", "is_payment", "payment_id"]
    totals = running_total(timeline, "card_id", order, "points_delta", "total", folder)
    # Its own redemption is no part of what a payment finds.
    found = (F.col("total") - F.coalesce("points_delta", F.lit(0))).alias("points_balance")
    return totals.where("is_payment").select(
        "payment_id", "card_id", "order_id", F.col("at").alias("payment_datetime"), "points_used", found
    )
