"""Incremental facts and reports against a whole rebuild, after drops that move, lose and change rows."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import plan_text

from ledgerloom.plans import build_analytics, build_marts, build_staging
from ledgerloom.schema import RAW_COLUMNS
from ledgerloom.sources import conform_raw
from ledgerloom.sources.manifest import last_number, publish, published
from ledgerloom.sources.monthly import MONTH
from ledgerloom.streaming import compact, current_fact, current_reports, ingest_new_files, rebuild_fact_orders, refresh
from ledgerloom.streaming import current_fact_orders, facts, stored

TABLES = (*facts.ORDER_INPUTS, *facts.LEDGER_INPUTS)


class Feed:
    """Raw drops: a file per table and drop, and the rows of all drops in order for a whole rebuild."""

    def __init__(self, spark, folder, tables=TABLES):
        self.spark, self.folder, self.tables = spark, folder, tables
        self.state = str(folder / "state")
        self.rows = {t: [] for t in tables}
        self.drops = 0

    def drop(self, **rows):
        for table, lines in rows.items():
            path = self.folder / "raw" / table
            path.mkdir(parents=True, exist_ok=True)
            text = "\n".join([",".join(RAW_COLUMNS[table]), *(",".join(cells) for cells in lines)]) + "\n"
            (path / f"{self.drops:04}.csv").write_text(text)
            self.rows[table] += lines
            ingest_new_files(self.spark, str(path), table, f"{self.state}/{table}")
        self.drops += 1

    def whole(self):
        raw = {}
        for table, lines in self.rows.items():
            names = RAW_COLUMNS[table]
            schema = ", ".join([*(f"{n} string" for n in names), "_ingest_seq bigint"])
            raw[table] = conform_raw(self.spark.createDataFrame([(*r, i) for i, r in enumerate(lines)], schema), table)
        stg = build_staging(raw)
        return build_marts(stg | {"stg_products": build_staging({"products": self.no_products()})["stg_products"]})

    def no_products(self):
        schema = ", ".join([*(f"{n} string" for n in RAW_COLUMNS["products"]), "_ingest_seq bigint"])
        return conform_raw(self.spark.createDataFrame([], schema), "products")


def rows_of(df, names):
    return Counter(map(tuple, df.select(*names).collect()))


def check_all(feed, ledger=True):
    marts = feed.whole()
    names = [facts.ORDERS, *([facts.LEDGER] if ledger else [])]
    for fact in names:
        columns = marts[fact].columns
        assert rows_of(current_fact(feed.spark, feed.state, fact), columns) == rows_of(marts[fact], columns), fact
    if ledger:
        reports = current_reports(feed.spark, feed.state)
        for name, expected in build_analytics(marts).items():
            assert rows_of(reports[name], expected.columns) == rows_of(expected, expected.columns), name


ORDER = "order_id customer_id order_date order_status sales_channel currency".split()


def first_drop():
    return {
        "orders_master": [("1", "5", "2026-01-05", "paid", "web", "chf"), ("2", "6", "2026-02-05", "paid", "web", "chf")],
        "order_details": [("1", "1", "p1", "1", "20", "0"), ("2", "1", "p1", "2", "10", "0")],
        "payments": [("7", "1", "2026-01-06", "card", "success", "20.00", "", ""), ("8", "2", "2026-02-06", "card", "success", "5", "", "")],
        "customers": [("5", "n", "b2b", "c", "d", "e"), ("6", "n", "vip", "c", "d", "e")],
    }


def net(feed):
    return {
        r.order_id: (r.payment_event_count, float(r.net_collected_amount))
        for r in current_fact_orders(feed.spark, feed.state).collect()
    }


@pytest.mark.parametrize("target", ["2", ""])
def test_a_moved_or_lost_payment_leaves_its_old_order(spark, tmp_path, target):
    feed = Feed(spark, tmp_path, facts.ORDER_INPUTS)
    feed.drop(**first_drop())
    rebuild_fact_orders(spark, feed.state)
    assert net(feed) == {1: (1, 20.0), 2: (1, 5.0)}
    feed.drop(payments=[("7", target, "2026-01-06", "card", "success", "20.00", "", "")])
    rebuild_fact_orders(spark, feed.state)
    assert net(feed) == {1: (0, 0.0), 2: (2, 25.0) if target else (1, 5.0)}


def test_a_payment_is_followed_through_a_base_of_batches_already_seen(spark, tmp_path):
    feed = Feed(spark, tmp_path, facts.ORDER_INPUTS)
    feed.drop(**first_drop())
    rebuild_fact_orders(spark, feed.state)
    feed.drop(payments=[("7", "2", "2026-01-06", "card", "success", "20.00", "", "")])
    # The base up to the newest batch no longer knows the first order; the older batch still does.
    compact(spark, "payments", f"{feed.state}/payments")
    rebuild_fact_orders(spark, feed.state)
    assert net(feed) == {1: (0, 0.0), 2: (2, 25.0)}


def test_only_touched_months_are_written_and_a_month_is_read_alone(spark, tmp_path):
    feed = Feed(spark, tmp_path, facts.ORDER_INPUTS)
    feed.drop(**first_drop())
    rebuild_fact_orders(spark, feed.state)
    # The order moves from February to March; January is not touched.
    feed.drop(orders_master=[("2", "6", "2026-03-05", "paid", "web", "chf")])
    rebuild_fact_orders(spark, feed.state)
    folders = published(spark, f"{feed.state}/facts")["months"][facts.ORDERS]["folders"]
    assert folders == {f"{MONTH}=2026-01": 0, f"{MONTH}=2026-03": 1}
    month = current_fact(spark, feed.state, facts.ORDERS).where(f"{MONTH} = '2026-03'")
    assert [r.order_id for r in month.collect()] == [2]
    assert "PartitionFilters: [isnotnull(partition_month" in plan_text(month)
    assert len(month.inputFiles()) >= 1 and all("2026-0" in f for f in month.inputFiles())


def test_a_refresh_that_fails_leaves_the_old_state(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path, facts.ORDER_INPUTS)
    feed.drop(**first_drop())
    rebuild_fact_orders(spark, feed.state)
    before = net(feed)
    feed.drop(payments=[("7", "2", "2026-01-06", "card", "success", "20.00", "", "")])

    def fail(*args):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(facts, "publish", fail)
        with pytest.raises(OSError, match="no space"):
            rebuild_fact_orders(spark, feed.state)
    assert net(feed) == before
    rebuild_fact_orders(spark, feed.state)
    assert net(feed) == {1: (0, 0.0), 2: (2, 25.0)}


def test_a_manifest_number_is_taken_once(spark, tmp_path):
    folder = str(tmp_path)
    publish(spark, folder, 0, {"a": 1})
    with pytest.raises(RuntimeError, match="published"):
        publish(spark, folder, 0, {"a": 2})
    assert published(spark, folder) == {"a": 1} and last_number(spark, folder) == 0


def test_a_batch_written_half_does_not_count(spark, tmp_path):
    feed = Feed(spark, tmp_path, facts.ORDER_INPUTS)
    feed.drop(**first_drop())
    (tmp_path / "state" / "payments" / "changes" / "batch_id=9").mkdir()
    assert stored.last_batch(spark, f"{feed.state}/payments") == 0


def random_rows(rng, drop):
    """Rows of one drop: few keys, so that versions of one key meet, move and vanish."""
    many = 14 if drop == 0 else 5

    def day():
        return rng.choice(["2026-01-05", "2026-01-20", "2026-02-03", "2026-03-09", "bad"])

    def order():
        return str(rng.randrange(8)) if rng.random() < 0.9 else "NA"

    def buyer():
        return str(rng.randrange(4)) if rng.random() < 0.9 else ""

    rows = {
        "orders_master": [(order(), buyer(), day(), rng.choice(["paid", "paid", "cancelled"]), "web", "chf") for _ in range(many)],
        "order_details": [(order(), str(rng.randrange(3)), "p", str(rng.randrange(1, 4)), rng.choice(["10", "25.5", ""]), "0") for _ in range(many)],
        "payments": [
            (str(rng.randrange(9)), order(), day(), rng.choice(["card", "points", "refund"]), rng.choice(["success", "success", "failed"]), rng.choice(["20", "60", "-5"]), rng.choice(["c1", ""]), rng.choice(["3", ""]))
            for _ in range(many)
        ],
        "customers": [(str(rng.randrange(4)), "n", rng.choice(["a", "b", ""]), "c", "d", "e") for _ in range(3)],
        "customer_cards": [(rng.choice(["c1", "c2", "c3"]), buyer(), "2026-01-01", rng.choice(["active", "active", "blocked"])) for _ in range(2)],
        "points_thresholds": [(str(drop), str(rng.choice([0, 20, 40])), rng.choice(["", "45", "90"]), str(rng.randrange(1, 9)))] if drop % 2 == 0 else [],
        "card_points_ledger": [
            (f"L{drop}-{i}", rng.choice(["c1", "c2", "c9", ""]), order(), day(), rng.choice(["earn", "redeem"]), rng.choice(["5", "-4", "x"]))
            for i in range(3)
        ],
    }
    # Some drops leave tables out.
    return {t: lines for t, lines in rows.items() if lines and (drop == 0 or rng.random() < 0.7)}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_drops_give_what_a_whole_rebuild_gives(spark, tmp_path, seed):
    rng = random.Random(seed)
    feed = Feed(spark, tmp_path)
    for drop in range(3):
        feed.drop(**random_rows(rng, drop))
        refresh(spark, feed.state)
        if drop == 1:
            for table in ("payments", "card_points_ledger"):
                compact(spark, table, f"{feed.state}/{table}")
    check_all(feed)


def test_many_deltas_become_one(spark, tmp_path, monkeypatch):
    from ledgerloom.streaming import reports

    monkeypatch.setattr(reports, "COMPACT_AT", 2)
    rng = random.Random(9)
    feed = Feed(spark, tmp_path)
    for drop in range(3):
        feed.drop(**random_rows(rng, drop))
        refresh(spark, feed.state)
    assert published(spark, f"{feed.state}/facts")["deltas"]["by_day"] == [2]
    check_all(feed)


def test_a_ledger_begun_later_covers_all_orders(spark, tmp_path):
    rng = random.Random(4)
    feed = Feed(spark, tmp_path)
    feed.drop(**random_rows(rng, 0))
    refresh(spark, feed.state, ledger=False)
    assert set(published(spark, f"{feed.state}/facts")["months"]) == {facts.ORDERS}
    refresh(spark, feed.state)
    check_all(feed)
