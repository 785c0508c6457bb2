"""Steps of ingest and refresh: headers without the rest of a file, lines in one place, key lists of their own size."""

from __future__ import annotations

import gzip
import random
import re

from conftest import plan_text
from test_incremental import Feed, check_all, first_drop, random_rows

from ledgerloom.plans.marts import order_amounts, price_lines
from ledgerloom.sources.raw import first_line
from ledgerloom.streaming import current_table, facts, refresh


def test_the_header_is_the_first_line_of_plain_and_compressed_files(spark, tmp_path):
    texts = {"a b%20.csv": "x,y\n1,2\n", "crlf.csv": "x,ü\r\n1,2\r\n", "one.csv": "x,y", "blank.csv": "\n1\n", "none.csv": ""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
        (tmp_path / f"{name}.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "zero.csv.gz").write_bytes(b"")
    expected = {"a b%20.csv": "x,y", "crlf.csv": "x,ü", "one.csv": "x,y", "blank.csv": "", "none.csv": None}
    for name, header in expected.items():
        assert first_line(spark, str(tmp_path / name)) == header
        assert first_line(spark, str(tmp_path / f"{name}.gz")) == header
    assert first_line(spark, str(tmp_path / "zero.csv.gz")) is None


def test_of_a_file_the_driver_reads_the_header_alone(spark, tmp_path):
    path = tmp_path / "long.csv.gz"
    whole = gzip.compress(b"x,y\n" + random.Random(1).randbytes(400_000).hex().encode())
    # To read on would raise at the end of what is there.
    path.write_bytes(whole[: len(whole) // 2])
    assert first_line(spark, str(path)) == "x,y"


def test_stored_lines_are_summed_before_they_move(spark, tmp_path):
    feed = Feed(spark, tmp_path, ("order_details",))
    feed.drop(order_details=[("1", "1", "p1", "1", "20", "0")] * 2)
    feed.drop(order_details=[("1", "1", "p1", "1", "20", "0"), ("1", "2", "p1", "1", "5", "0")])
    amounts = order_amounts(price_lines(current_table(spark, "order_details", f"{feed.state}/order_details")))
    exchanges = [re.sub(r"#\w+", "", keys) for keys in re.findall(r"Exchange hashpartitioning\(([^)]*), 8\)", plan_text(amounts))]
    assert exchanges == ["order_id", "order_id, _lines"]
    assert [(r.order_id, r.order_expected_amount) for r in amounts.collect()] == [(1, 25)]


def test_key_lists_are_written_apart_and_versions_of_one_base_are_not_reduced(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path)
    feed.drop(**first_drop())
    refresh(spark, feed.state, ledger=False)
    feed.drop(payments=[("7", "2", "2026-01-06", "card", "success", "20.00", "", "")])
    lists, written = {}, facts.Refresh.written

    def recorded(self, df, purpose):
        table = written(self, df, purpose)
        if purpose.endswith("-again"):
            lists[purpose] = sorted(tuple(r) for r in table.collect())
        return table

    step = facts.Refresh(spark, feed.state, facts.ORDER_INPUTS)
    assert "Window" not in plan_text(step.replaced("payments", "payment_id"))
    monkeypatch.setattr(facts.Refresh, "written", recorded)
    refresh(spark, feed.state, ledger=False)
    assert lists == {"lines-again": [], "payments-again": [(1,), (2,)]}
    check_all(feed, ledger=False)


def test_facts_after_random_drops(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for number in range(3):
        feed.drop(**random_rows(random.Random(40 + number), number))
        refresh(spark, feed.state)
    check_all(feed)
