"""Shape of the physical plans: what must never appear, and what must."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL, plan_text

from ledgerloom_checks import registry
from ledgerloom_checks.raw_inputs import raw_tables
from ledgerloom.plans import marts
from ledgerloom.plans.run import write_staging
from ledgerloom.sources import work_folder

PLANNED = [
    "norm_title", "stg_orders_master", "stg_order_details", "fact_order_lines", "fact_orders", "tier_lookup",
    "fact_card_points_ledger", "revenue_by_day", "loyalty_card_summary", "dq_payments_without_order",
    "dq_payments_with_card_not_owned_by_customer", "dq_negative_points_balance",
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_workers_and_no_unkeyed_joins(spark, name):
    text = plan_text(registry.queries()[name](spark, SMALL))
    for node in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_facts_scan_only_the_columns_they_need(spark):
    stg = write_staging(spark, raw_tables(spark, SMALL), work_folder(spark, "plans"))
    amounts = marts.order_amounts(marts.price_lines(stg["stg_order_details"]))
    text = plan_text(amounts)
    assert re.search(r"ReadSchema: struct<order_id:bigint,quantity:[^>]*discount_pct:decimal\(9,4\)>", text)
    assert "line_id" not in text and "product_id" not in text
    assert text.count("Exchange hashpartitioning") == 1  # partial sums before the only shuffle


def test_order_joins_reuse_the_order_partitioning(spark):
    """Staged orders, line sums and payment totals meet on order_id with one exchange each."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stg, frequent = registry._inputs(spark, SMALL, *registry.ORDER_INPUTS)
        text = plan_text(marts.build_fact_orders(stg, frequent))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*), 8\)", text)
    keys = [re.sub(r"#\w+", "", keys) for keys in exchanges]
    # Orders dedup, line sums and payment totals; no order side is exchanged again for the joins.
    assert keys.count("order_id") == 3
    assert keys.count("payment_id") == 1
    assert keys.count("customer_id, _bucket") == 2


def test_eligible_orders_are_filtered_before_the_tier_and_card_joins(spark, monkeypatch):
    from ledgerloom.operators import tiers
    from ledgerloom.plans import loyalty, staging

    stg = write_staging(spark, raw_tables(spark, SMALL), work_folder(spark, "plans"))
    facts = marts.build_marts(stg)
    folder = work_folder(spark, "orders")
    facts["fact_orders"].write.parquet(folder)
    orders = spark.read.parquet(folder)
    ordered, seen = tiers.ordered_chunks, []

    def chunks(df, *arguments):
        seen.append(plan_text(df))
        return ordered(df, *arguments)

    monkeypatch.setattr(tiers, "ordered_chunks", chunks)
    earn = loyalty.computed_earn(
        orders, stg["stg_customer_cards"], stg["stg_points_thresholds"], stg["stg_card_points_ledger"],
        staging.staged_frequent_keys(stg)["customer_id"],
    )
    (amounts,) = seen
    assert "EqualTo(is_valid_revenue,true)" in amounts or "PushedFilters: [IsNotNull(is_valid_revenue)" in amounts
    assert "EqualTo(card_status,active)" in plan_text(earn)


def test_amounts_are_not_exploded_for_their_tiers(spark):
    rows = spark.range(1000).selectExpr("id", "cast(id as decimal(18,4)) AS amount")
    tiers = spark.sql("SELECT 10BD AS min_amount, 20BD AS max_amount, 3BD AS points_awarded").selectExpr(
        "cast(min_amount as decimal(18,4)) AS min_amount", "cast(max_amount as decimal(18,4)) AS max_amount",
        "cast(points_awarded as decimal(18,4)) AS points_awarded",
    )
    from ledgerloom.operators import tier_lookup

    found = tier_lookup(rows, "amount", tiers)
    assert "Generate" not in plan_text(found)
    assert {r.id for r in found.collect() if r.points_delta} == set(range(10, 21))
