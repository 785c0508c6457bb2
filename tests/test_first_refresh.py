"""A first refresh builds from the whole tables; versions of one batch are not reduced again."""

from __future__ import annotations

import random

from conftest import plan_text
from test_incremental import Feed, check_all, first_drop, random_rows

from ledgerloom.streaming import current_table, facts, refresh
from ledgerloom.streaming.incremental import compact


def test_a_first_refresh_asks_for_no_affected_rows(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path)
    feed.drop(**random_rows(random.Random(3), 0))

    def asked(*args):
        raise AssertionError("asked for affected rows")

    with monkeypatch.context() as patch:
        patch.setattr(facts, "versions_of", asked)
        refresh(spark, feed.state)
    check_all(feed)
    feed.drop(**random_rows(random.Random(5), 1))
    refresh(spark, feed.state)
    check_all(feed)


def test_versions_of_one_batch_or_base_are_not_reduced_again(spark, tmp_path):
    feed = Feed(spark, tmp_path, facts.ORDER_INPUTS)
    feed.drop(**first_drop())
    place = f"{feed.state}/payments"
    assert "Window" not in plan_text(current_table(spark, "payments", place))
    feed.drop(payments=[("7", "2", "2026-01-06", "card", "failed", "20.00", "", "")])
    assert "Window" in plan_text(current_table(spark, "payments", place))
    # The ordinal, which names files, does not move: the batch tells versions apart.
    assert "_ingest_seq" not in plan_text(current_table(spark, "payments", place))
    compact(spark, "payments", place)
    rows = current_table(spark, "payments", place)
    assert "Window" not in plan_text(rows)
    assert sorted((r.payment_id, r.order_id) for r in rows.collect()) == [(7, 2), (8, 2)]
