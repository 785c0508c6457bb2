"""The full run: raw -> staging -> marts -> quality report and analytics.

Each layer is written once and read back by the next, so no table is computed twice, later
scans read only the columns they need, and a lost executor never reaches behind a layer. A run is
published as a whole when its last table is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans.analytics import build_analytics
from ledgerloom.plans.loyalty import fact_card_points_ledger
from ledgerloom.plans.marts import (
    build_fact_orders,
    dim_customers,
    dim_products,
    fact_order_lines,
    fact_payments,
)
from ledgerloom.plans.quality import quality_report
from ledgerloom.plans.rejects import MOST_REJECTED, check_shares, counted_split, fitting_rows, rejected_rows
from ledgerloom.plans.staging import build_staging, staged_frequent_keys
from ledgerloom.sources import load_raw, read_tables
from ledgerloom.sources.manifest import file_system, last_number, publish, published
from ledgerloom.sources.metrics import SCHEMA as METRICS
from ledgerloom.sources.metrics import group_cost
from ledgerloom.sources.monthly import MONTH, month_of
from ledgerloom.sources.tables import Written, write_measured

Tables = dict[str, DataFrame]
Writes = dict[str, Written]

# Fact -> the time by whose month its files are partitioned.
PARTITION_TIMES = {
    "fact_payments": "payment_datetime",
    "fact_orders": "order_date",
    "fact_card_points_ledger": "event_datetime",
}


LAYERS = ("staging", "marts", "analytics", "data_quality")


class Layers(NamedTuple):
    """Written tables by layer, read back, with the row counts seen while writing and what each write cost."""

    staging: Tables
    marts: Tables
    analytics: Tables
    data_quality: Tables
    row_counts: dict[str, int]
    metrics: DataFrame


def write_layer(spark: SparkSession, tables: Tables, folder: str, counts: Writes | None = None) -> Tables:
    """Write ``tables`` below ``folder`` and return them as fresh scans.

    Facts with a time get a month column that their files are partitioned by, so a scan of a period reads its months only.
    """
    dated = {name: PARTITION_TIMES[name] for name in tables if name in PARTITION_TIMES}
    tables = tables | {
        name: tables[name].select("*", month_of(time)) for name, time in dated.items()
    }
    written = write_measured(tables, folder, partition_by=dict.fromkeys(dated, MONTH))
    if counts is not None:
        counts.update(written)
    return read_tables(spark, folder, tables)


def write_staging(
    spark: SparkSession,
    raw: Tables,
    folder: str,
    counts: Writes | None = None,
    datetime_formats: Sequence[str] = (),
) -> Tables:
    return write_layer(spark, build_staging(raw, datetime_formats), f"{folder}/staging", counts)


def write_facts(
    spark: SparkSession,
    stg: Tables,
    folder: str,
    counts: Writes | None = None,
    frequent: Tables | None = None,
) -> Tables:
    """Write the dimensions and every fact but the ledger from written staging tables."""
    frequent = frequent or staged_frequent_keys(stg)
    facts = {
        "dim_customers": dim_customers(stg["stg_customers"]),
        "dim_products": dim_products(stg["stg_products"]),
        "fact_order_lines": fact_order_lines(stg["stg_order_details"], stg["stg_products"], frequent["product_id"]),
        "fact_payments": fact_payments(stg["stg_payments"]),
        "fact_orders": build_fact_orders(stg, frequent),
    }
    return write_layer(spark, facts, f"{folder}/marts", counts)


def write_marts(spark: SparkSession, stg: Tables, folder: str, counts: Writes | None = None) -> Tables:
    """Write all marts; the ledger reads the written ``fact_orders``."""
    frequent = staged_frequent_keys(stg)
    marts = write_facts(spark, stg, folder, counts, frequent)
    ledger = fact_card_points_ledger(
        marts["fact_orders"], stg["stg_customer_cards"], stg["stg_points_thresholds"],
        stg["stg_card_points_ledger"], frequent,
    )
    return marts | write_layer(spark, {"fact_card_points_ledger": ledger}, f"{folder}/marts", counts)


def run_layers(
    spark: SparkSession,
    raw: Tables,
    folder: str,
    datetime_formats: Sequence[str] = (),
    most_rejected: float = MOST_REJECTED,
) -> Layers:
    """Build and write every table below ``folder``.

    Rows with a number that does not fit are set apart in ``data_quality/rejected_rows``; if they are more than the
    share ``most_rejected`` of a table, the run ends there.
    """
    counts: Writes = {}
    splits = {table: counted_split(df, table) for table, df in raw.items()}
    stg = write_staging(spark, {t: split.rows for t, split in splits.items()}, folder, counts, datetime_formats)
    rejected = {"rejected_rows": rejected_rows(spark, raw, splits)}
    report = write_layer(spark, rejected, f"{folder}/data_quality", counts)
    check_shares(splits, most_rejected)
    marts = write_marts(spark, stg, folder, counts)
    fitting = {t: fitting_rows(df, t) if splits[t].tally.get["rejected"] else df for t, df in raw.items()}
    checks = {"data_quality_report": quality_report(fitting, stg, marts)}
    report |= write_layer(spark, checks, f"{folder}/data_quality", counts)
    analytics = write_layer(spark, build_analytics(marts), f"{folder}/analytics", counts)
    layers = dict(zip(LAYERS, (stg, marts, analytics, report), strict=True))
    metrics = write_metrics(spark, layers, counts, f"{folder}/run_metrics")
    return Layers(**layers, row_counts={name: written.rows for name, written in counts.items()}, metrics=metrics)


def write_metrics(spark: SparkSession, layers: dict[str, Tables], counts: Writes, path: str) -> DataFrame:
    """One row per table: how long its write took, rows, bytes and tasks."""
    rows = [
        (layer, name, counts[name].seconds, counts[name].rows, *group_cost(spark, counts[name].group))
        for layer, tables in layers.items()
        for name in tables
    ]
    spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema(METRICS).parquet(path)


def run(
    spark: SparkSession,
    raw_folder: str,
    out_folder: str,
    datetime_formats: Sequence[str] = (),
    multi_line: bool = True,
    most_rejected: float = MOST_REJECTED,
) -> Layers:
    """Run everything from raw CSV files. Times are read as ISO, or by the first of ``datetime_formats`` that fits.

    The tables are written below a folder of this run and published together at the end: until then, and if the run
    fails, :func:`published_layers` gives those of the run before.
    """
    number = last_number(spark, out_folder) + 1
    place = f"runs/{number}-{uuid.uuid4().hex[:8]}"
    raw = load_raw(spark, raw_folder, multi_line)
    layers = run_layers(spark, raw, f"{out_folder}/{place}", datetime_formats, most_rejected)
    tables = {layer: sorted(getattr(layers, layer)) for layer in LAYERS}
    publish(spark, out_folder, number, {"folder": place, "tables": tables, "row_counts": layers.row_counts})
    return layers


def published_layers(spark: SparkSession, out_folder: str) -> Layers:
    """The tables of the last run that was written to the end."""
    found = published(spark, out_folder)
    if not found:
        raise FileNotFoundError(f"{out_folder}: no run has been published")
    tables = {
        layer: read_tables(spark, f"{out_folder}/{found['folder']}/{layer}", names) for layer, names in found["tables"].items()
    }
    metrics = spark.read.schema(METRICS).parquet(f"{out_folder}/{found['folder']}/run_metrics")
    return Layers(**tables, row_counts=found["row_counts"], metrics=metrics)


def drop_runs(spark: SparkSession, out_folder: str, keep: int = 2) -> None:
    """Delete the tables of published runs but the last ``keep``; a reader of those may still be at work."""
    last = last_number(spark, out_folder)
    for number in range(last - max(keep, 1), -1, -1):
        files, place = file_system(spark, f"{out_folder}/{published(spark, out_folder, number)['folder']}")
        if not files.exists(place):
            break
        files.delete(place, True)


def run_summary(spark: SparkSession, layers: Layers) -> DataFrame:
    """``(section, name, value)``: rows per table, checks by severity, and the checks that failed."""
    tables = [
        (layer, name, layers.row_counts[name])
        for layer in ("staging", "marts")
        for name in getattr(layers, layer)
    ]
    counted = spark.createDataFrame(tables, "section string, name string, value bigint")
    report = layers.data_quality["data_quality_report"]
    severities = report.groupBy("severity").count().selectExpr("'severity' AS section", "severity AS name", "count AS value")
    failed = report.where("failed_count > 0").selectExpr(
        "'failed_check' AS section", "check_name AS name", "failed_count AS value"
    )
    return counted.unionByName(severities).unionByName(failed)
