"""Columns parsed from text are computed once, also where a filter asks for them."""

from __future__ import annotations

import pytest
from conftest import plan_text, raw_frame

from ledgerloom.plans import quality, staging

ROWS = {
    "orders_master": [("1", "7", "2026-01-01", "paid", "web", "chf"), ("x", "7", "2026-01-01", "paid", "web", "chf"),
                      ("", "7", "", "paid", "web", "chf"), ("1.0", "8", "2026-01-02", "paid", "web", "chf")],
    "order_details": [("1", "1", "p", "2", "3", ""), ("", "1", "p", "2", "3", ""), ("1", "y", "p", "2", "3", "")],
    "payments": [("5", "1", "2026-01-01", "card", "success", "3", "c", ""), ("NA", "1", "", "card", "success", "3", "c", "")],
    "customers": [("7", "n", "a", "b", "2026-01-01", "e"), ("?", "n", "a", "b", "2026-01-01", "e")],
    "customer_cards": [(" c1", "7", "2026-01-01", "active"), ("", "7", "2026-01-01", "active")],
}


@pytest.mark.parametrize("table", ROWS)
def test_no_filter_parses_again(spark, table):
    staged = staging.build_staging({table: raw_frame(spark, table, ROWS[table])})[f"stg_{table}"]
    filters = [line for line in plan_text(staged).splitlines() if " Filter " in line]
    assert filters and not any("try_cast" in line or "RLIKE" in line for line in filters)
    assert staged.count() == 1


def test_repeated_ids_are_parsed_once(spark):
    raw = {"orders_master": raw_frame(spark, "orders_master", ROWS["orders_master"])}
    counted = quality.repeated_orders(raw, {}, {})
    filters = [line for line in plan_text(counted).splitlines() if " Filter " in line]
    assert filters and not any("try_cast" in line for line in filters)
    assert counted.first().duplicate_orders == 2
