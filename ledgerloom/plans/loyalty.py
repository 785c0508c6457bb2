"""Loyalty ledger: raw point events plus the earn events that valid orders should have produced."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import spread_join, tier_lookup
from ledgerloom.plans.staging import stg_points_thresholds
from ledgerloom.schema import FACT_COLUMNS
from ledgerloom.sources import read_raw_csv

# The columns of ``fact_orders`` that earning reads.
EARNING_COLUMNS = ("order_id", "customer_id", "order_date", "order_expected_amount", "is_valid_revenue")


def computed_earn(
    orders: DataFrame, cards: DataFrame, tiers: DataFrame, ledger: DataFrame, frequent_customers: DataFrame
) -> DataFrame:
    """Earn events by tier for each valid order and each active card of its customer.

    Points depend on the order alone, so they are looked up before the card join fans out.
    Earns that the raw ledger already holds for the same card and order are left out.
    """
    eligible = orders.where("is_valid_revenue").select(
        "order_id", "customer_id", F.col("order_date").alias("event_datetime"), "order_expected_amount"
    )
    earning = tier_lookup(eligible, "order_expected_amount", tiers).where("points_delta > 0")
    active = cards.where("card_status = 'active'").select("card_id", "customer_id", "card_status")
    earned = spread_join(
        earning.drop("order_expected_amount"), active, "customer_id", frequent_customers, ["order_id"], "inner"
    )
    already_earned = (
        ledger.where("event_type = 'earn' AND order_id IS NOT NULL").select("card_id", "order_id").distinct()
    )
    return earned.join(already_earned, ["card_id", "order_id"], "left_anti").select(
        "card_id", "order_id", "event_datetime",
        F.lit("earn").alias("event_type"),
        "points_delta",
        F.lit("computed_threshold").alias("ledger_source"),
        "customer_id", "card_status",
    )


def points_for_amounts(
    rows: DataFrame, amount: str, tiers: DataFrame | None = None, raw_folder: str | None = None
) -> DataFrame:
    """Add ``points_delta`` for ``amount``; without ``tiers`` the raw thresholds of ``raw_folder`` are read."""
    if tiers is None:
        raw = read_raw_csv(rows.sparkSession, f"{raw_folder}/points_thresholds.csv", "points_thresholds")
        tiers = stg_points_thresholds(raw)
    return tier_lookup(rows, amount, tiers)


def raw_events(ledger: DataFrame, cards: DataFrame, frequent_cards: DataFrame) -> DataFrame:
    """Raw ledger events with the card's owner and status; events of unknown cards are kept."""
    owners = cards.select("card_id", F.col("customer_id").alias("_owner"), "card_status")
    events = spread_join(ledger, owners, "card_id", frequent_cards, ["ledger_id", "order_id", "event_datetime"])
    owner = F.coalesce("customer_id", "_owner") if "customer_id" in ledger.columns else F.col("_owner")
    return events.select(
        "ledger_id", "card_id", "order_id", "event_datetime", "event_type", "points_delta",
        F.lit("raw").alias("ledger_source"),
        owner.alias("customer_id"),
        "card_status",
    )


def fact_card_points_ledger(
    orders: DataFrame, cards: DataFrame, tiers: DataFrame, ledger: DataFrame, frequent: dict[str, DataFrame]
) -> DataFrame:
    """Raw events and computed earns in one ledger. Computed earns already know their card's owner."""
    raw = raw_events(ledger, cards, frequent["card_id"])
    earned = computed_earn(orders, cards, tiers, ledger, frequent["customer_id"])
    return (
        raw.unionByName(earned, allowMissingColumns=True)
        .withColumn("is_valid_card", F.col("customer_id").isNotNull())
        .select(*FACT_COLUMNS["fact_card_points_ledger"])
    )


def card_balance(ledger: DataFrame) -> DataFrame:
    """Points balance per card."""
    return ledger.groupBy("card_id").agg(F.sum("points_delta").alias("points_balance"))
