"""Reports kept by signed deltas: what the old rows of changed orders and cards added is taken back, the new is added.

A report is a sum per group. Each refresh writes one small table of sums over its old rows (negative) and new rows; the
state of a report is the sum of the tables in force, and a group whose row count is back at zero is gone. Money is exact
decimal, so the sums equal those over all rows. After a number of deltas they are summed into one.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans.analytics import card_summary, kpi_rows, segment_report
from ledgerloom.sources.manifest import published

# Deltas of a report that are summed into one.
COMPACT_AT = 8

ROWS = "group_rows"


class Report(NamedTuple):
    """Groups of a report: which rows count, by what, and the amounts that are summed."""

    condition: str
    keys: list[str]
    key_values: Callable[[], list[Column]]
    amounts: dict[str, str]


def named(*columns: str) -> Callable[[], list[Column]]:
    return lambda: [F.col(c) for c in columns]


def counted(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS INT) + 0L"


MONEY = {
    "order_expected_amount": "order_expected_amount",
    "total_cash_collected_amount": "total_cash_collected_amount",
    "total_refund_amount": "total_refund_amount",
    "net_collected_amount": "net_collected_amount",
}


def of_valid(amount: str) -> str:
    """The amount of an order that counts as revenue; nothing of others."""
    return f"CASE WHEN is_valid_revenue THEN {amount} ELSE 0 END"


ORDER_DELTAS: dict[str, Report] = {
    "by_day": Report(
        "is_valid_revenue AND order_date IS NOT NULL", ["order_date"], lambda: [F.to_date("order_date").alias("order_date")], MONEY
    ),
    "by_segment": Report(
        "is_valid_revenue AND customer_segment IS NOT NULL", ["customer_segment"], named("customer_segment"), MONEY
    ),
    "by_customer": Report(
        "is_valid_revenue", ["customer_id"], named("customer_id"), {"net_collected_amount": "net_collected_amount"}
    ),
    "all_orders": Report(
        "true",
        ["one"],
        lambda: [F.lit(1).alias("one")],
        {
            "valid_revenue_orders": counted("is_valid_revenue"),
            "expected": of_valid("order_expected_amount"),
            "cash": of_valid("total_cash_collected_amount"),
            "refunds": of_valid("total_refund_amount"),
            "net": of_valid("net_collected_amount"),
            "partial_payment_orders": counted("is_partially_paid"),
            "overpaid_orders": counted("is_overpaid"),
            "cancelled_orders_with_payment": counted("order_status = 'cancelled' AND has_any_payment"),
            "orders_paid_with_points": counted("is_valid_revenue AND points_used > 0"),
        },
    ),
}

# By owner as well, so that a card's owner is known after any of its events is taken back.
POINT_DELTAS: dict[str, Report] = {
    "by_card": Report(
        "true",
        ["card_id", "card_status", "customer_id"],
        named("card_id", "card_status", "customer_id"),
        {
            "earned": "greatest(points_delta, 0)",
            "redeemed": "greatest(-points_delta, 0)",
            "balance": "points_delta",
            "transaction_count": counted("points_delta IS NOT NULL"),
        },
    )
}


def sums(rows: DataFrame, keys: list[str], amounts: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(ROWS).alias(ROWS), *(F.sum(a).alias(a) for a in amounts))


def signed_deltas(report: Report, old: DataFrame, new: DataFrame) -> DataFrame:
    """What the groups of a report change by when ``old`` rows give way to ``new`` ones."""

    def part(rows: DataFrame, sign: str) -> DataFrame:
        amounts = [F.expr(f"{sign}({amount})").alias(name) for name, amount in report.amounts.items()]
        return rows.where(report.condition).select(*report.key_values(), F.expr(f"{sign}1L").alias(ROWS), *amounts)

    changed = sums(part(old, "-").union(part(new, "+")), report.keys, list(report.amounts))
    return changed.where(" OR ".join(f"{name} <> 0" for name in (ROWS, *report.amounts)))


def read_deltas(spark: SparkSession, folder: str, versions: list[int], keys: list[str]) -> DataFrame:
    """The groups of a report: the sum of its deltas in force."""
    rows = spark.read.parquet(*(f"{folder}/version={n}" for n in versions))
    amounts = [c for c in rows.columns if c not in (*keys, ROWS)]
    return sums(rows, keys, amounts).where(f"{ROWS} <> 0")


def write_deltas(folder: str, versions: list[int], number: int, delta: DataFrame, keys: list[str]) -> list[int]:
    """Write ``delta`` as version ``number`` and return the versions then in force; many are summed into the new one."""
    path = f"{folder}/version={number}"
    if len(versions) < COMPACT_AT:
        delta.write.mode("overwrite").parquet(path)
        return [*versions, number]
    spark = delta.sparkSession
    earlier = spark.read.parquet(*(f"{folder}/version={n}" for n in versions))
    amounts = [c for c in delta.columns if c not in (*keys, ROWS)]
    whole = sums(earlier.unionByName(delta), keys, amounts).where(f"{ROWS} <> 0")
    whole.write.mode("overwrite").parquet(path)
    return [number]


# The reports


def report_groups(spark: SparkSession, state: str, *names: str) -> dict[str, DataFrame]:
    """The groups of the named reports, all as of one manifest."""
    versions = published(spark, f"{state}/facts")["deltas"]
    every = ORDER_DELTAS | POINT_DELTAS
    return {n: read_deltas(spark, f"{state}/reports/{n}", versions[n], every[n].keys) for n in names}


def current_reports(spark: SparkSession, state: str) -> dict[str, DataFrame]:
    """The four analytics tables as of the last refresh, without a look at the facts."""
    groups = report_groups(spark, state, *ORDER_DELTAS, *POINT_DELTAS)
    money = {
        "order_expected_amount": "total_expected_revenue",
        "total_cash_collected_amount": "total_cash_collected",
        "total_refund_amount": "total_refunds",
        "net_collected_amount": "net_collected_revenue",
    }
    named_money = [F.col(old).alias(new) for old, new in money.items()]
    by_day = groups["by_day"].select("order_date", F.col(ROWS).alias("order_count"), *named_money)
    by_segment = groups["by_segment"].select("customer_segment", F.col(ROWS).alias("order_count"), *named_money)
    totals = (
        groups["by_card"]
        .groupBy("card_id", "card_status")
        .agg(
            *(F.sum(c).alias(c) for c in ("earned", "redeemed", "balance", "transaction_count")),
            F.max("customer_id").alias("customer_id"),
        )
    )
    loyal = groups["by_card"].where("card_status = 'active'").select("customer_id").distinct()
    loyal_net = groups["by_customer"].join(loyal, "customer_id", "left_semi").agg(
        F.coalesce(F.sum("net_collected_amount"), F.lit(0)).alias("loyal_net")
    )
    # No order at all has no group; its counts are zero.
    every = groups["all_orders"]
    measures = every.agg(
        F.coalesce(F.sum(ROWS), F.lit(0)).alias("total_orders"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ORDER_DELTAS["all_orders"].amounts),
    )
    return {
        "revenue_by_day": by_day.orderBy("order_date"),
        "revenue_by_customer_segment": segment_report(by_segment),
        "loyalty_card_summary": card_summary(totals),
        "kpi_summary": kpi_rows(measures, totals, loyal_net),
    }
