"""A refresh reads the lines and payments of orders whose lines and payments have changed, and no others."""

from __future__ import annotations

import pytest
from test_incremental import Feed, check_all, first_drop

from ledgerloom.streaming import facts, refresh


@pytest.mark.parametrize(
    ("drop", "lines", "payments"),
    [
        # A customer, or an order's own row, leaves the sums as they are.
        ({"customers": [("5", "n", "new", "c", "d", "e")]}, set(), set()),
        ({"orders_master": [("2", "5", "2026-03-05", "cancelled", "app", "chf")]}, set(), set()),
        # A payment that moves changes both of its orders.
        ({"payments": [("7", "2", "2026-01-06", "card", "success", "20.00", "", "")]}, set(), {7, 8}),
        ({"order_details": [("1", "2", "p2", "1", "3", "0")]}, {1}, set()),
        # An order that the fact does not hold yet has no sums there, though its line came before.
        ({"orders_master": [("3", "6", "2026-03-05", "paid", "web", "chf")]}, {3}, {9}),
    ],
)
def test_sums_that_stay_are_not_made_again(spark, tmp_path, monkeypatch, drop, lines, payments):
    feed = Feed(spark, tmp_path)
    first = first_drop()
    first["order_details"].append(("3", "1", "p1", "1", "7", "0"))
    first["payments"].append(("9", "3", "2026-03-06", "card", "success", "7", "", ""))
    feed.drop(**first)
    refresh(spark, feed.state, ledger=False)
    feed.drop(**drop)
    asked = {}
    current = facts.Refresh.current

    def recorded(self, table, keys, key):
        asked[table] = {r[0] for r in keys.select(key).distinct().collect()}
        return current(self, table, keys, key)

    with monkeypatch.context() as patch:
        patch.setattr(facts.Refresh, "current", recorded)
        refresh(spark, feed.state, ledger=False)
    assert (asked["order_details"], asked["payments"]) == (lines, payments)
    check_all(feed, ledger=False)
