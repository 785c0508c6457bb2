"""Tables of a drop and deltas of reports are worked on at the same time."""

from __future__ import annotations

import threading

import pytest
from test_incremental import Feed, first_drop

from ledgerloom.sources.tables import side_by_side
from ledgerloom.streaming import facts, refresh
from ledgerloom_checks import registry


def test_jobs_run_at_the_same_time(spark):
    met = threading.Barrier(3, timeout=60)
    jobs = {n: lambda n=n: (met.wait() >= 0, spark.range(n).count())[1] for n in (1, 2, 3)}
    assert side_by_side(spark, jobs) == {1: 1, 2: 2, 3: 3}


def test_a_job_that_fails_is_told(spark):
    def fails():
        raise KeyError("no such table")

    with pytest.raises(KeyError):
        side_by_side(spark, {"a": fails, "b": lambda: 1})


def test_tables_of_a_drop_arrive_side_by_side(spark, tmp_path, monkeypatch):
    met, seen = threading.Barrier(2, timeout=60), []

    def ingest(spark, folder, table, state):
        seen.append(table)
        met.wait()

    rows = {"payments": spark.createDataFrame([], ", ".join(f"{c} string" for c in registry.RAW_COLUMNS["payments"]))}
    rows["customers"] = spark.createDataFrame([], ", ".join(f"{c} string" for c in registry.RAW_COLUMNS["customers"]))
    monkeypatch.setattr(registry, "raw_cells", lambda *args: rows)
    monkeypatch.setattr(registry, "raw_drops", lambda cells: [cells])
    monkeypatch.setattr(registry, "ingest_new_files", ingest)
    monkeypatch.setattr(registry, "refresh", lambda *args: None)
    registry.dropped_state(spark, str(tmp_path), tuple(rows), ledger=False)
    assert sorted(seen) == ["customers", "payments"]


def test_reports_are_written_side_by_side(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path, facts.ORDER_INPUTS)
    feed.drop(**first_drop())
    met, write = threading.Barrier(len(facts.ORDER_DELTAS), timeout=60), facts.write_deltas

    def together(*args):
        met.wait()
        return write(*args)

    monkeypatch.setattr(facts, "write_deltas", together)
    refresh(spark, feed.state, ledger=False)
    assert facts.published(spark, f"{feed.state}/facts")["deltas"] == {name: [0] for name in facts.ORDER_DELTAS}
