from __future__ import annotations

import random
from collections import Counter, defaultdict
from decimal import Decimal

from conftest import raw_frame

from ledgerloom.operators import running_total, value_spans
from ledgerloom.plans import contract, marts, redemption
from ledgerloom.plans.staging import build_staging, staged_frequent_keys
from ledgerloom.schema import RAW_COLUMNS
from ledgerloom.sources import work_folder
from ledgerloom.streaming import (
    changed_keys,
    compact,
    current_fact,
    current_fact_orders,
    current_table,
    ingest_new_files,
    rebuild_fact_orders,
    restrict_to_orders,
)


def hot_events(n=3000):
    """A third of the events belong to key 7."""
    rnd = random.Random(11)
    return [(7 if i % 3 == 0 else rnd.randrange(40), i, rnd.randrange(-5, 6)) for i in rnd.sample(range(n), n)]


def test_running_total_matches_brute_force_on_a_hot_key(spark):
    rows = hot_events()
    df = spark.createDataFrame(rows, "k bigint, t bigint, v bigint").repartition(6)
    result = running_total(df, "k", ["t"], "v", "total", work_folder(spark, "total"))
    expected, sums = {}, defaultdict(int)
    for k, t, v in sorted(rows, key=lambda r: r[1]):
        sums[k] += v
        expected[t] = sums[k]
    assert {r.t: r.total for r in result.collect()} == expected


def test_a_hot_key_spans_several_chunks(spark):
    folder = work_folder(spark, "chunks")
    df = spark.createDataFrame(hot_events(), "k bigint, t bigint, v bigint")
    # So few rows would be one chunk; adaptive execution joins small neighbours.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        running_total(df, "k", ["t"], "v", "total", folder).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    chunks = spark.read.parquet(folder).groupBy("k", "_chunk").count().collect()
    assert sum(r.k == 7 for r in chunks) >= 3
    assert max(r["count"] for r in chunks) <= 700


def test_value_spans_match_brute_force_on_a_hot_key(spark):
    rnd = random.Random(3)
    rows = [(k, t, rnd.choice(["A", "A", "A", "B", None])) for k, t, _ in hot_events(1500)]
    df = spark.createDataFrame(rows, "k bigint, t bigint, s string").repartition(5)
    expected = []
    for key in {r[0] for r in rows}:
        starts, previous = [], object()
        for _, t, s in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            if s != previous:
                starts.append((s, t))
            previous = s
        for (s, t), end in zip(starts, [t for _, t in starts[1:]] + [None]):
            expected.append((key, s, t, end, end is None))
    result = value_spans(df, "k", "t", "s", work_folder(spark, "spans"))
    assert Counter(map(tuple, result.collect())) == Counter(expected)


def payments(spark, rows):
    return marts.fact_payments(build_staging({"payments": raw_frame(spark, "payments", rows)})["stg_payments"])


def ledger(spark, rows):
    return build_staging({"card_points_ledger": raw_frame(spark, "card_points_ledger", rows)})["stg_card_points_ledger"]


PAID = [
    ("1", "10", "2026-01-05", "points", "success", "0", "c1", "50"),
    ("2", "11", None, "loyalty_card", "success", "0", "C1", "20"),
    ("3", "12", "2026-01-05", "points", "failed", "0", "C1", "5"),
    ("4", "13", "2026-01-05", "points", "success", "0", None, "5"),
    ("5", "14", "2026-01-05", "card", "success", "9", "C1", "5"),
    ("6", "15", "2026-01-04", "points", "success", "0", "C2", "5"),
]
POINTS = [
    ("L1", "C1", None, "2026-01-01", "earn", "100"),
    ("L2", "C1", None, "2026-01-05", "earn", "7"),
    ("L3", "C1", "11", "2026-01-06", "redeem", "-20"),
    ("L4", "C1", None, "bad", "correction", "1000"),
    ("L5", "C2", None, "2026-01-05", "earn", "3"),
]


def test_redemptions_come_from_successful_points_payments_not_yet_booked(spark):
    events = redemption.redemption_events(payments(spark, PAID), ledger(spark, POINTS)).collect()
    assert {(r.payment_id, r.card_id, r.points_delta) for r in events} == {(1, "C1", Decimal(-50)), (6, "C2", Decimal(-5))}


def test_balance_counts_events_up_to_the_payment_and_redemptions_before_it(spark):
    rows = redemption.balance_at_payment(payments(spark, PAID), ledger(spark, POINTS), work_folder(spark, "b")).collect()
    # Payment 1 spends 50 that no event books; payment 2 is booked by L3; 3 has failed.
    assert {r.payment_id: r.points_balance for r in rows} == {1: 107, 2: 1037, 3: 57, 6: 0}


def test_points_are_not_spent_twice(spark):
    spent = [
        ("9", "20", "2026-01-05", "points", "success", "0", "c1", "60"),
        ("3", "21", "2026-01-05", "points", "success", "0", "c1", "70"),
        ("5", "22", "2026-01-04", "points", "failed", "0", "c1", "80"),
        ("7", "23", None, "points", "success", "0", "c1", "1"),
        ("8", "24", "2026-01-06", "points", "success", "0", "c1", "2"),
    ]
    events = [("L1", "C1", None, "2026-01-01", "earn", "100"), ("L2", "C1", "24", "2026-01-06", "redeem", "-2")]
    rows = redemption.balance_at_payment(payments(spark, spent), ledger(spark, events), work_folder(spark, "b")).collect()
    # In order of time and id: 5 fails, 3 finds 100, 9 finds 30, 8 is booked already, 7 of unknown time comes last.
    assert {r.payment_id: r.points_balance for r in rows} == {5: 100, 3: 100, 9: 30, 8: -32, 7: -32}


def test_schema_violations(spark):
    raw = {"payments": raw_frame(spark, "payments", [*PAID, ("x", None, "soon", "barter", "success", "1,0", None, None)])}
    counts = {(r.column_name, r.rule): r.failed_count for r in contract.validate_raw(raw).collect()}
    assert {k for k, n in counts.items() if n} == {
        ("payment_id", "unreadable"), ("order_id", "missing"), ("payment_datetime", "unreadable"),
        ("payment_type", "unexpected"), ("payment_amount", "unreadable"),
    }
    assert counts["payment_status", "unexpected"] == 0
    lines = [("1", "1", "p", "2000000000", "1.23456 chf", "0.5"), ("1", "2", "p", "x", None, "1e6")]
    raw = {"order_details": raw_frame(spark, "order_details", lines)}
    counts = {(r.column_name, r.rule): r.failed_count for r in contract.validate_raw(raw).collect()}
    assert {k: n for k, n in counts.items() if n} == {
        ("quantity", "out_of_range"): 1, ("quantity", "unreadable"): 1, ("unit_price", "rounded"): 1, ("discount_pct", "out_of_range"): 1,
    }


def drop_file(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(RAW_COLUMNS["orders_master"]), *(",".join(r) for r in rows)]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_incremental_ingest_reads_new_files_only_and_keeps_the_last_row(spark, tmp_path):
    raw, state = tmp_path / "raw", str(tmp_path / "state")

    def ingest():
        ingest_new_files(spark, str(raw), "orders_master", state)
        return {r.order_id: (r.customer_id, r.order_status) for r in current_table(spark, "orders_master", state).collect()}

    drop_file(raw, "a.csv", [("1", "5", "2026-01-01", "pending", "web", "chf"), ("1", "5", "2026-01-01", "paid", "web", "chf"), ("2", "6", "2026-01-01", "paid", "web", "chf")])
    assert ingest() == {1: (5, "paid"), 2: (6, "paid")}
    assert ingest() == {1: (5, "paid"), 2: (6, "paid")}
    drop_file(raw, "0_later.csv", [("2", "NA", "2026-01-01", "paid", "web", "chf"), ("3", "7", "2026-01-02", "paid", "web", "chf")])
    assert ingest() == {1: (5, "paid"), 3: (7, "paid")}  # the last copy of 2 has no customer
    assert {r.order_id for r in changed_keys(spark, "orders_master", state, after_batch=0).collect()} == {2, 3}


def write_csv(folder, name, header, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *rows]) + "\n")


def test_files_are_read_by_column_name_and_keep_optional_columns(spark, tmp_path):
    raw, state = tmp_path / "raw", str(tmp_path / "state")
    write_csv(raw, "a one.csv", "ledger_id,card_id,order_id,event_datetime,event_type,points_delta", "L1,c1,1,2026-01-01,earn,5")
    write_csv(raw, "b.csv", "points_delta,customer_id,event_type,event_datetime,order_id,card_id,ledger_id", "7,42,redeem,2026-01-02,2,c2,L2")
    ingest_new_files(spark, str(raw), "card_points_ledger", state)
    write_csv(raw, "c.csv", "ledger_id,card_id,order_id,event_datetime,event_type,points_delta", "L1,c1,1,2026-01-01,earn,5")
    ingest_new_files(spark, str(raw), "card_points_ledger", state)
    rows = [(r.ledger_id, r.card_id, r.order_id, int(r.points_delta), r.customer_id) for r in current_table(spark, "card_points_ledger", state).collect()]
    assert Counter(rows) == Counter([("L1", "C1", 1, 5, None), ("L2", "C2", 2, 7, 42), ("L1", "C1", 1, 5, None)])


def test_compacted_tables_stay_what_they_were(spark, tmp_path):
    raw, state = tmp_path / "raw", str(tmp_path / "state")
    drop_file(raw, "a.csv", [("1", "5", "2026-01-01", "paid", "web", "chf"), ("2", "6", "2026-01-01", "paid", "web", "chf")])
    ingest_new_files(spark, str(raw), "orders_master", state)
    compact(spark, "orders_master", state)
    drop_file(raw, "b.csv", [("2", "6", "2026-01-01", "cancelled", "web", "chf")])
    ingest_new_files(spark, str(raw), "orders_master", state)
    for _ in range(2):
        assert {r.order_id: r.order_status for r in current_table(spark, "orders_master", state).collect()} == {1: "paid", 2: "cancelled"}
        compact(spark, "orders_master", state)


def test_rebuilt_facts_follow_orders_lines_payments_and_customers(spark, tmp_path):
    state = str(tmp_path / "state")
    headers = {t: ",".join(RAW_COLUMNS[t]) for t in ("orders_master", "order_details", "payments", "customers")}

    def drop(name, **rows):
        for table, lines in rows.items():
            write_csv(tmp_path / table, f"{name}.csv", headers[table], *lines)
        for table in headers:
            ingest_new_files(spark, str(tmp_path / table), table, f"{state}/{table}")
        rebuild_fact_orders(spark, state)
        return {r.order_id: (r.customer_segment, int(r.order_expected_amount), r.has_any_payment) for r in current_fact_orders(spark, state).collect()}

    first = drop(
        "a",
        orders_master=["1,5,2026-01-01,paid,web,chf", "2,6,2026-02-01,paid,web,chf", "3,6,bad,paid,web,chf"],
        order_details=["1,1,p1,2,10,0"], payments=["1,1,2026-01-02,card,success,20,,"], customers=["5,n,b2b,c,d,e", "6,n,vip,c,d,e"],
    )
    assert first == {1: ("B2B", 20, True), 2: ("VIP", 0, False), 3: ("VIP", 0, False)}
    second = drop(
        "b", orders_master=["3,NA,bad,paid,web,chf"], order_details=["2,1,p1,1,7,0"],
        payments=["2,2,2026-02-02,card,success,7,,"], customers=["5,n,vip,c,d,e"],
    )
    assert second == {1: ("VIP", 20, True), 2: ("VIP", 7, True)}
    # The order without a date is gone, and its month with it.
    assert {r.partition_month for r in current_fact(spark, state, "fact_orders").collect()} == {"2026-01", "2026-02"}


def test_affected_orders_rebuild_like_the_whole_table(spark):
    from ledgerloom_checks.raw_inputs import raw_tables
    from conftest import SMALL

    stg = build_staging(raw_tables(spark, SMALL, "orders_master", "order_details", "payments", "customers"))
    frequent = staged_frequent_keys(stg)
    affected = stg["stg_payments"].where("order_id % 10 = 3").select("order_id").distinct()
    part = marts.build_fact_orders(restrict_to_orders(stg, affected), frequent)
    whole = marts.build_fact_orders(stg, frequent).join(affected, "order_id", "left_semi")
    assert part.count() > 0
    assert Counter(map(tuple, part.collect())) == Counter(map(tuple, whole.collect()))
