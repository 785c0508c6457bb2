"""Lines without an order, told apart before lines are made distinct."""

from __future__ import annotations

from collections import Counter

from conftest import plan_text, raw_frame

from ledgerloom.plans import staging


def test_only_lines_without_an_order_are_made_distinct(spark):
    lines = [("1", "1", "p", "2", "3", "")] * 2 + [("9", "1", "p", "2", "3", "")] * 3 + [("9", "2", "q", "", "4", "5"), ("", "1", "p", "", "", "")]
    raw = {
        "order_details": raw_frame(spark, "order_details", lines),
        "orders_master": raw_frame(spark, "orders_master", [("1", "7", "2026-01-01", "paid", "web", "chf")]),
    }
    stg = staging.build_staging(raw)
    found = staging.order_details_without(raw["order_details"], stg["stg_orders_master"])
    expected = stg["stg_order_details"].join(stg["stg_orders_master"], "order_id", "left_anti")
    assert Counter(found.collect()) == Counter(expected.select(*found.columns).collect())
    assert found.count() == 2
    # The whole lines that meet are those that the join has left.
    plan = plan_text(found)
    assert plan.index("HashAggregate") < plan.index("LeftSemi") < plan.index("LeftAnti")
