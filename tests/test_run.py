from __future__ import annotations

import sys
from collections import Counter

import pytest
from conftest import SMALL, raw_frame
from pyspark.sql import functions as F

from ledgerloom_checks.raw_inputs import raw_cells, raw_tables
from ledgerloom.plans import drop_runs, marts, published_layers, run_layers, run_summary
from ledgerloom.plans.loyalty import points_for_amounts
from ledgerloom.__main__ import main
from ledgerloom.plans.history import arrival_times, customer_segment_history
from ledgerloom.plans.run import MONTH, run, write_layer
from ledgerloom.plans.staging import build_staging
from ledgerloom.schema import RAW_COLUMNS
from ledgerloom.sources import conform_raw, load_raw, read_raw_csv, work_folder, write_table

ORDER = ("order_id", "customer_id", "order_date", "order_status", "sales_channel", "currency")


def contents(tables):
    return {name: Counter(map(tuple, df.collect())) for name, df in tables.items()}


def write_text(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    write_text(tmp_path / "orders_master.csv", "currency,order_id,extra,customer_id,order_date,order_status,sales_channel\nchf,1,z,2,2026-01-01, paid ,web\n")
    row = read_raw_csv(spark, str(tmp_path / "orders_master.csv"), "orders_master").first()
    assert tuple(row)[:6] == ("1", "2", "2026-01-01", " paid ", "web", "chf")


def test_csv_quotes_and_missing_tokens(spark, tmp_path):
    text = 'customer_id,customer_name,segment,country,signup_date,email\n1,"Ann ""A"", Ltd",N/A,"","NULL",a@b\n'
    write_text(tmp_path / "customers.csv", text)
    row = read_raw_csv(spark, str(tmp_path / "customers.csv"), "customers").first()
    assert tuple(row)[:6] == ("1", 'Ann "A", Ltd', None, None, None, "a@b")


def test_quoted_line_breaks_are_read(spark, tmp_path):
    text = 'customer_id,customer_name,segment,country,signup_date,email\n1,"Ann\nB",x,y,z,e\n'
    write_text(tmp_path / "customers.csv", text)
    row = read_raw_csv(spark, str(tmp_path / "customers.csv"), "customers").first()
    assert row.customer_name == "Ann\nB"


def test_tiers_default_to_the_raw_thresholds(spark, tmp_path):
    text = "threshold_id,min_amount,max_amount,points_awarded\n1,0,49.99,1\n2,50,,3\n"
    write_text(tmp_path / "points_thresholds.csv", text)
    rows = spark.sql("SELECT CAST(60 AS DECIMAL(18,4)) AS amount")
    assert points_for_amounts(rows, "amount", raw_folder=str(tmp_path)).first().points_delta == 3


def test_a_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="order_status"):
        conform_raw(spark.createDataFrame([("1",)], "order_id string"), "orders_master")


def test_keep_last_follows_file_order_over_many_splits(spark, tmp_path):
    lines = [f"{i % 50},{i},2026-01-01,s{i},web,chf" for i in range(5000)]
    write_text(tmp_path / "orders_master.csv", "\n".join([",".join(ORDER), *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = read_raw_csv(spark, str(tmp_path / "orders_master.csv"), "orders_master")
        staged = build_staging({"orders_master": raw})["stg_orders_master"].collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r.order_id: r.customer_id for r in staged} == {k: 4950 + k for k in range(50)}


def test_newer_files_win(spark, tmp_path):
    import os

    for name, status, age in (("b_first", "old", 2000), ("a_second", "new", 1000)):
        path = tmp_path / "orders_master.csv" / f"{name}.csv"
        write_text(path, f"{','.join(ORDER)}\n1,2,2026-01-01,{status},web,chf\n")
        stamp = path.stat().st_mtime - age
        os.utime(path, (stamp, stamp))
    raw = read_raw_csv(spark, str(tmp_path / "orders_master.csv"), "orders_master")
    assert build_staging({"orders_master": raw})["stg_orders_master"].first().order_status == "new"


def test_run_twice_gives_the_same_tables(spark, tmp_path):
    for table, df in raw_cells(spark, SMALL, *RAW_COLUMNS).items():
        write_table(df.select(*RAW_COLUMNS[table]).coalesce(1), f"{tmp_path}/raw/{table}.csv", "csv")
    first = run(spark, f"{tmp_path}/raw", f"{tmp_path}/out")
    before = {layer: contents(getattr(first, layer)) for layer in ("staging", "marts", "analytics", "data_quality")}
    second = run(spark, f"{tmp_path}/raw", f"{tmp_path}/out")
    after = {layer: contents(getattr(second, layer)) for layer in before}
    assert before == after
    assert first.row_counts == second.row_counts
    assert sorted(before["staging"]) == sorted(
        f"stg_{t}" for t in RAW_COLUMNS
    )
    for layer, tables in before.items():
        for name, rows in tables.items():
            assert first.row_counts[name] == rows.total(), (layer, name)


def test_a_run_that_fails_leaves_the_last_whole_one(spark, tmp_path, monkeypatch):
    module = sys.modules["ledgerloom.plans.run"]
    for table, df in raw_cells(spark, SMALL, *RAW_COLUMNS).items():
        write_table(df.select(*RAW_COLUMNS[table]).coalesce(1), f"{tmp_path}/raw/{table}.csv", "csv")
    out = f"{tmp_path}/out"
    with pytest.raises(FileNotFoundError):
        published_layers(spark, out)
    first = run(spark, f"{tmp_path}/raw", out)
    before = contents(published_layers(spark, out).analytics)
    assert before == contents(first.analytics)

    def fail(marts):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(module, "build_analytics", fail)
        with pytest.raises(OSError, match="no space"):
            run(spark, f"{tmp_path}/raw", out)
    assert contents(published_layers(spark, out).analytics) == before
    # What each table cost.
    costs = {r.table_name: r for r in published_layers(spark, out).metrics.collect()}
    assert costs.keys() == first.row_counts.keys()
    orders = costs["fact_orders"]
    assert orders.rows == first.row_counts["fact_orders"] and orders.seconds > 0 and orders.tasks > 1
    assert orders.bytes_shuffled > 0 and orders.bytes_written > 0 and orders.longest_task_seconds >= orders.median_task_seconds > 0
    run(spark, f"{tmp_path}/raw", out)
    drop_runs(spark, out, keep=1)
    assert contents(published_layers(spark, out).analytics) == before
    assert len([p for p in (tmp_path / "out" / "runs").iterdir()]) == 2  # the last one, and the one that failed


def test_rejected_rows_are_set_apart_and_counted(spark, tmp_path):
    from ledgerloom.plans import rejects
    from ledgerloom.plans.run import write_staging

    good = [(str(i), "1", "2026-01-05", "card", "success", "10", "", "") for i in range(40)]
    bad = [
        ("99999999999999999999", "1", "2026-01-05", "card", "success", "10", "", ""),
        ("7", "2", "2026-01-05", "card", "success", "123456789012345.5", "", "1e30"),
        ("8", "12.5", "2026-01-05", "card", "success", "x", "", ""),
    ]
    raw = {"payments": raw_frame(spark, "payments", [*good, *bad])}
    splits = {t: rejects.counted_split(df, t) for t, df in raw.items()}
    counts = {}
    staged = write_staging(spark, {t: s.rows for t, s in splits.items()}, str(tmp_path), counts)["stg_payments"]
    cells = {(r.arrival, r.column_name, r.cell) for r in rejects.rejected_rows(spark, raw, splits).collect()}
    assert cells == {("40", "payment_id", "99999999999999999999"), ("41", "payment_amount", "123456789012345.5"), ("41", "points_used", "1e30")}
    # Payment 7 keeps its version before; 8 has lost its order id with its last version, a documented drop.
    assert {r.payment_id for r in staged.collect()} == set(range(40)) - {8}
    tally = splits["payments"].tally.get
    replaced_or_dropped = 2
    assert tally == {"rows": 43, "rejected": 2}
    assert counts["stg_payments"].rows + tally["rejected"] + replaced_or_dropped == tally["rows"]
    rejects.check_shares(splits, 0.05)
    with pytest.raises(rejects.TooManyRejected, match="2 of 43"):
        rejects.check_shares(splits, 0.04)
    # Without the split, such a number raises rather than lose its row.
    with pytest.raises(Exception, match="payment_id: an id outside bigint"):
        build_staging(raw)["stg_payments"].collect()


def test_written_and_planned_runs_agree(spark):
    raw = raw_tables(spark, SMALL)
    layers = run_layers(spark, raw, work_folder(spark, "agree"))
    planned = marts.build_marts(build_staging(raw))
    written = {name: df.drop(MONTH) for name, df in layers.marts.items()}
    assert contents(written) == contents(planned)
    summary = {(r.section, r.name): r.value for r in run_summary(spark, layers).collect()}
    assert summary["severity", "error"] == 7 and summary["severity", "warning"] == 8
    assert summary["marts", "fact_orders"] == planned["fact_orders"].count()


def test_partitioned_sink_keeps_null_dates(spark, tmp_path):
    rows = [(str(i), "1", "bad" if i % 7 == 0 else f"2026-01-{1 + i % 3:02d}", "paid", "w", "c") for i in range(1, 60)]
    orders = build_staging({"orders_master": raw_frame(spark, "orders_master", rows)})["stg_orders_master"]
    dated = orders.withColumn("order_day", F.to_date("order_date"))
    assert write_table(dated, str(tmp_path / "by_day"), partition_by="order_day") == 59
    back = spark.read.parquet(str(tmp_path / "by_day"))
    assert back.count() == 59 and back.where("order_day IS NULL").count() == 8
    pruned = back.where("order_day = '2026-01-02'")
    assert "PartitionFilters: [isnotnull(order_day" in pruned._jdf.queryExecution().executedPlan().toString()


def test_work_folder_uses_the_shared_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(shared)
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_command_line_reads_formats_and_line_breaks(spark, tmp_path, capsys):
    """Day-first dates and a quoted line break reach the report of a full run."""
    for table, df in raw_cells(spark, SMALL, *RAW_COLUMNS).items():
        cells = df.select(*RAW_COLUMNS[table])
        if table == "orders_master":
            cells = cells.withColumn("order_date", F.regexp_replace("order_date", r"^(\d+)-(\d+)-(\d+)$", "$3.$2.$1"))
        if table == "customers":
            cells = cells.withColumn("customer_name", F.concat(F.lit("Line one\n"), "customer_name"))
        write_table(cells.coalesce(1), f"{tmp_path}/raw/{table}.csv", "csv")
    main([f"{tmp_path}/raw", f"{tmp_path}/out", "--datetime-format", "dd.MM.yyyy", "--datetime-format", "yyyy-MM-dd"])
    assert "valid_revenue_orders" in capsys.readouterr().out
    layers = published_layers(spark, f"{tmp_path}/out")
    assert layers.analytics["revenue_by_day"].count() > 10
    names = layers.marts["dim_customers"]
    assert names.where("customer_name NOT LIKE 'Line one\n%'").count() == 0


def test_facts_are_pruned_by_month(spark, tmp_path):
    rows = [(str(i), "1", "bad" if i % 7 == 0 else f"2026-0{1 + i % 3}-05", "paid", "w", "c") for i in range(1, 60)]
    orders = build_staging({"orders_master": raw_frame(spark, "orders_master", rows)})["stg_orders_master"]
    back = write_layer(spark, {"fact_orders": orders}, str(tmp_path))["fact_orders"]
    assert back.count() == 59 and back.where(f"{MONTH} IS NULL").count() == 8
    plan = back.where(f"{MONTH} = '2026-02'")._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({MONTH}" in plan


def test_history_bounds_as_arrival_times(spark, tmp_path):
    import os

    for i, segment in enumerate(("b2b", "vip", "vip")):
        path = tmp_path / "customers.csv" / f"{i}.csv"
        write_text(path, f"customer_id,customer_name,segment,country,signup_date,email\n1,n,{segment},c,d,e\n")
        os.utime(path, (1_700_000_000 + 100 * i,) * 2)
    raw = read_raw_csv(spark, str(tmp_path / "customers.csv"), "customers")
    spans = arrival_times(customer_segment_history(raw, work_folder(spark, "history"))).orderBy("valid_from").collect()
    assert [(r.segment, r.valid_from.timestamp(), r.valid_to and r.valid_to.timestamp()) for r in spans] == [
        ("B2B", 1_700_000_000, 1_700_000_100),
        ("VIP", 1_700_000_100, None),
    ]
