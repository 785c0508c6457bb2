"""The registered queries: each runs one operator or table over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom_checks.oracle import UNFIT_SQL
from ledgerloom_checks.raw_inputs import raw_cells, raw_tables
from ledgerloom.functions import (
    amount_value,
    datetime_value,
    lower_text,
    price_value,
    strip_text,
    title_text,
    upper_text,
    whole_number,
)
from ledgerloom.operators import dedup_exact, dedup_latest, require_parsed_keys, tier_lookup
from ledgerloom.plans import analytics, contract, history, loyalty, marts, quality, redemption, rejects, staging
from ledgerloom.plans.run import MONTH, run_layers, run_summary, write_facts, write_layer, write_staging
from ledgerloom.schema import PERCENT, PRICE, QUANTITY, RAW_COLUMNS
from ledgerloom.sources import conform_raw, read_raw_csv, work_folder, write_table
from ledgerloom.sources.tables import CSV_OPTIONS, side_by_side
from ledgerloom.streaming import (
    compact,
    current_fact,
    current_fact_orders,
    current_reports,
    current_table,
    ingest_new_files,
    refresh,
)
from ledgerloom.streaming.facts import LEDGER

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles by way of four exact decimals, the form both engines can be compared in."""
    return df.selectExpr(
        *(
            f"CAST(CAST(`{f.name}` AS DECIMAL(18,4)) AS DOUBLE) AS `{f.name}`"
            if isinstance(f.dataType, T.DecimalType)
            else f"`{f.name}`"
            for f in df.schema.fields
        )
    )


# Raw scan and column expressions


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the raw orders as CSV and read them back the way raw files are read."""
    path = f"{work_folder(spark, 'raw')}/orders_master.csv"
    cells = raw_cells(spark, sf_dir, "orders_master")["orders_master"].select(*RAW_COLUMNS["orders_master"])
    write_table(cells, path, "csv")
    return read_raw_csv(spark, path, "orders_master").select(*RAW_COLUMNS["orders_master"])


def _raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return raw_tables(spark, sf_dir, table)[table]


def norm_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "order_details").select(
        whole_number("order_id").alias("order_id"),
        amount_value("quantity", QUANTITY).alias("quantity"),
        amount_value("discount_pct", PERCENT).alias("discount_pct"),
    )


def norm_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "orders_master").select(
        "order_id", datetime_value("order_date").alias("order_date")
    )


def norm_datetime_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same dates written day first, read by a format."""
    day_first = F.regexp_replace("order_date", r"^(\d+)-(\d+)-(\d+)$", "$3.$2.$1")
    raw = _raw(spark, sf_dir, "orders_master").withColumn("order_date", day_first)
    return raw.select("order_id", datetime_value("order_date", ["dd.MM.yyyy", "yyyy/MM/dd"]).alias("order_date"))


def norm_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "orders_master").select(
        "_ingest_seq",
        lower_text("order_status").alias("order_status"),
        lower_text("sales_channel").alias("sales_channel"),
    )


def norm_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "payments").select("_ingest_seq", upper_text("card_id").alias("card_id"))


def norm_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    countries = _raw(spark, sf_dir, "customers").select("_ingest_seq", title_text("country").alias("country"))
    return countries.unionAll(_raw(spark, sf_dir, "products").select("_ingest_seq", title_text("category")))


def norm_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "customers").select(
        "_ingest_seq", strip_text("customer_name").alias("customer_name")
    )


def norm_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "order_details").select(
        F.col("unit_price").alias("raw_price"), price_value("unit_price", PRICE).alias("unit_price")
    )


def norm_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir, "order_details")
    typed = staging.typed_order_details(raw.withColumn("unit_price", F.lit(None).cast("string")))
    return typed.select(
        F.col("order_id").cast("string"), F.col("line_id").cast("string"), "product_id", "quantity", "discount_pct"
    )


def query_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = require_parsed_keys(staging.typed_orders(_raw(spark, sf_dir, "orders_master")), "order_id")
    return dedup_latest(typed, "order_id")


def query_dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(_raw(spark, sf_dir, "order_details"), RAW_COLUMNS["order_details"])


# Staging and marts, planned from the raw tables in one go

Tables = dict[str, DataFrame]

# Raw tables behind each fact.
ORDER_INPUTS = ("orders_master", "order_details", "payments", "customers")
LEDGER_INPUTS = (*ORDER_INPUTS, "customer_cards", "points_thresholds", "card_points_ledger")


def _inputs(spark: SparkSession, sf_dir: str, *tables: str) -> tuple[Tables, Tables]:
    """Staging tables and frequent keys of the raw ``tables``."""
    raw = raw_tables(spark, sf_dir, *tables)
    return staging.build_staging(raw), staging.raw_frequent_keys(raw)


def staged(name: str) -> Query:
    return lambda spark, sf_dir: _inputs(spark, sf_dir, staging.BUILDERS[name][0])[0][name]


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_customers(staged("stg_customers")(spark, sf_dir))


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_products(staged("stg_products")(spark, sf_dir))


def fact_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg, frequent = _inputs(spark, sf_dir, "order_details", "products")
    return marts.fact_order_lines(stg["stg_order_details"], stg["stg_products"], frequent["product_id"])


def fact_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fact_payments(staged("stg_payments")(spark, sf_dir))


def order_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.order_amounts(marts.price_lines(staged("stg_order_details")(spark, sf_dir)))


def payment_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.payment_aggregates(fact_payments(spark, sf_dir))


def latest_payment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.latest_payment_status(fact_payments(spark, sf_dir))


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.build_fact_orders(*_inputs(spark, sf_dir, *ORDER_INPUTS))


def _written(df: DataFrame, name: str, columns: Sequence[str] = ()) -> DataFrame:
    """``df``, written once, for plans that read it in several places: all its columns, or those that they read.

    Spark sees which columns are not read only as far as a write, so it would carry all others up to there.
    """
    path = f"{work_folder(df.sparkSession, name)}/{name}"
    write_table(df.select(*dict.fromkeys(columns)) if columns else df, path)
    return df.sparkSession.read.parquet(path)


def _written_orders(stg: Tables, frequent: Tables, columns: Sequence[str] = ()) -> DataFrame:
    return _written(marts.build_fact_orders(stg, frequent), "fact_orders", columns)


def query_tier_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg, frequent = _inputs(spark, sf_dir, *ORDER_INPUTS, "points_thresholds")
    orders = _written_orders(stg, frequent).select("order_id", "order_expected_amount")
    return tier_lookup(orders, "order_expected_amount", stg["stg_points_thresholds"])


def ledger_computed_earn(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg, frequent = _inputs(spark, sf_dir, *LEDGER_INPUTS)
    return loyalty.computed_earn(
        _written_orders(stg, frequent, loyalty.EARNING_COLUMNS), stg["stg_customer_cards"], stg["stg_points_thresholds"],
        stg["stg_card_points_ledger"], frequent["customer_id"],
    )


def _ledger(orders: DataFrame, stg: Tables, frequent: Tables) -> DataFrame:
    return loyalty.fact_card_points_ledger(
        orders, stg["stg_customer_cards"], stg["stg_points_thresholds"], stg["stg_card_points_ledger"], frequent
    )


def fact_card_points_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg, frequent = _inputs(spark, sf_dir, *LEDGER_INPUTS)
    return _ledger(_written_orders(stg, frequent, loyalty.EARNING_COLUMNS), stg, frequent)


def tier_lookup_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tier per customer, from their smallest to their largest order, some of them open: they nest and reach far."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    total = F.col("o_totalprice").cast("decimal(18,4)")
    tiers = orders.groupBy("o_custkey").agg(
        F.min(total).alias("min_amount"),
        F.when(F.col("o_custkey") % 7 != 0, F.max(total)).alias("max_amount"),
        F.count(F.lit(1)).cast("decimal(18,4)").alias("points_awarded"),
    )
    amounts = orders.select("o_orderkey", (total + F.lit("0.00005").cast("decimal(18,5)") * (F.col("o_orderkey") % 2)).alias("amount"))
    return tier_lookup(amounts, "amount", tiers).select("o_orderkey", "points_delta")


def points_default_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points by the thresholds of the raw folder, which are the default."""
    folder = work_folder(spark, "tiers")
    cells = raw_cells(spark, sf_dir, "points_thresholds")["points_thresholds"]
    write_table(cells.select(*RAW_COLUMNS["points_thresholds"]), f"{folder}/points_thresholds.csv", "csv")
    orders = _written_orders(*_inputs(spark, sf_dir, *ORDER_INPUTS)).select("order_id", "order_expected_amount")
    return loyalty.points_for_amounts(orders, "order_expected_amount", raw_folder=folder)


def ledger_own_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events of a ledger that names the owner of some cards itself."""
    raw = raw_tables(spark, sf_dir, "card_points_ledger", "customer_cards")
    own = F.when(F.col("event_type") == "redeem", F.regexp_extract("card_id", r"(\d+)", 1))
    raw["card_points_ledger"] = raw["card_points_ledger"].withColumn("customer_id", own)
    stg = staging.build_staging(raw)
    events = stg["stg_card_points_ledger"]
    return loyalty.raw_events(events, stg["stg_customer_cards"], staging.frequent_keys(events, "card_id"))


def orders_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged orders by the arrival order of files: what was sent again lies in a later file."""
    folder = f"{work_folder(spark, 'files')}/orders_master.csv"
    cells = raw_cells(spark, sf_dir, "orders_master")["orders_master"]
    resent = F.col("_ingest_seq") >= 100000000
    for drop in (cells.where(~resent), cells.where(resent)):
        drop.select(*RAW_COLUMNS["orders_master"]).write.options(**CSV_OPTIONS).mode("append").csv(folder)
    return staging.stg_orders_master(read_raw_csv(spark, folder, "orders_master"))


def written_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact as the run writes it, by month, and reads it back."""
    facts = {"fact_orders": fact_orders(spark, sf_dir)}
    return write_layer(spark, facts, work_folder(spark, "written"))["fact_orders"].drop(MONTH)


# Analytics and quality


def card_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loyalty.card_balance(fact_card_points_ledger(spark, sf_dir))


def revenue_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.revenue_by_day(fact_orders(spark, sf_dir))


def revenue_by_customer_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.revenue_by_customer_segment(fact_orders(spark, sf_dir))


def loyalty_card_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.loyalty_card_summary(fact_card_points_ledger(spark, sf_dir))


def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several aggregates read the orders and the ledger, so both are written once first.

    All of them read every month, so the rows are not moved to lie by month.
    """
    stg, frequent = _inputs(spark, sf_dir, *LEDGER_INPUTS)
    orders = _written_orders(stg, frequent, (*loyalty.EARNING_COLUMNS, *analytics.KPI_ORDER_COLUMNS))
    ledger = _written(_ledger(orders, stg, frequent), "fact_card_points_ledger", analytics.KPI_LEDGER_COLUMNS)
    return analytics.kpi_summary(orders, ledger)


def data_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many checks read the same tables, so staging and marts are written once first."""
    folder = work_folder(spark, "quality")
    raw = raw_tables(spark, sf_dir)
    stg = write_staging(spark, raw, folder)
    return quality.quality_report(raw, stg, write_facts(spark, stg, folder))


# Raw tables that each single check needs.
CHECK_INPUTS: dict[str, tuple[str, ...]] = {
    "duplicate_orders": ("orders_master",),
    "duplicate_payment_ids": ("payments",),
    "orders_without_customer": ORDER_INPUTS,
    "order_details_without_order": ("orders_master", "order_details", "payments"),
    "order_lines_with_invalid_product": ("order_details", "products"),
    "payments_without_order": ("orders_master", "order_details", "payments"),
    "payments_with_invalid_card": ("orders_master", "payments", "customer_cards"),
    "payments_with_card_not_owned_by_customer": ("orders_master", "payments", "customer_cards"),
    "payments_using_inactive_or_blocked_card": ("orders_master", "payments", "customer_cards"),
    "orders_without_payment": ORDER_INPUTS,
    "cancelled_orders_with_successful_payment": ORDER_INPUTS,
    "paid_orders_without_successful_payment": ORDER_INPUTS,
    "orders_with_negative_expected_amount": ORDER_INPUTS,
    "orders_overpaid": ORDER_INPUTS,
    "points_used_without_card": ("payments",),
    "points_ledger_invalid_card": ("card_points_ledger", "customer_cards"),
    "negative_points_balance": ("card_points_ledger", "customer_cards"),
}


def quality_check(name: str) -> Query:
    """One check on its own, planned from the raw tables."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = raw_tables(spark, sf_dir, *CHECK_INPUTS[name])
        stg, frequent = staging.build_staging(raw), staging.raw_frequent_keys(raw)
        facts: Tables = {}
        if CHECK_INPUTS[name] == ORDER_INPUTS:
            facts["fact_orders"] = marts.build_fact_orders(stg, frequent)
        if "stg_products" in stg:
            facts["fact_order_lines"] = marts.fact_order_lines(
                stg["stg_order_details"], stg["stg_products"], frequent["product_id"]
            )
        if "stg_order_details" in stg and "stg_orders_master" in stg:
            # Staging is not written here, so lines are not made distinct only to be told that their order is there.
            stg["orphan_lines"] = staging.order_details_without(raw["order_details"], stg["stg_orders_master"])
        if "stg_payments" in stg:
            facts["fact_payments"] = marts.fact_payments(stg["stg_payments"])
        return quality.quality_check(name, raw, stg, facts)

    return query


def query_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(spark, run_layers(spark, raw_tables(spark, sf_dir), work_folder(spark, "run")))


# Extensions


def redemption_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg, _ = _inputs(spark, sf_dir, "payments", "card_points_ledger")
    return redemption.redemption_events(marts.fact_payments(stg["stg_payments"]), stg["stg_card_points_ledger"])


def balance_at_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg, frequent = _inputs(spark, sf_dir, *LEDGER_INPUTS)
    ledger = _ledger(_written_orders(stg, frequent, loyalty.EARNING_COLUMNS), stg, frequent)
    payments = marts.fact_payments(stg["stg_payments"])
    return redemption.balance_at_payment(payments, ledger, work_folder(spark, "balance"))


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.customer_segment_history(_raw(spark, sf_dir, "customers"), work_folder(spark, "history"))


def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.validate_raw(raw_tables(spark, sf_dir))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of rows that staging leaves out, as the tasks that write staging have counted them."""
    cells = raw_cells(spark, sf_dir, *UNFIT_SQL)
    raw = {
        table: conform_raw(spark.sql(sql, **{f"{table}_raw": cells[table]}), table) for table, sql in UNFIT_SQL.items()
    }
    splits = {table: rejects.counted_split(df, table) for table, df in raw.items()}
    write_staging(spark, {table: split.rows for table, split in splits.items()}, work_folder(spark, "rejects"))
    return rejects.rejected_rows(spark, raw, splits)


def incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arrive in two drops, first sent and re-sent; each drop is ingested as it lands."""
    folder = work_folder(spark, "incremental")
    cells = raw_cells(spark, sf_dir, "orders_master")["orders_master"]
    resent = F.col("_ingest_seq") >= 100000000
    for drop in (cells.where(~resent), cells.where(resent)):
        drop.select(*RAW_COLUMNS["orders_master"]).write.options(**CSV_OPTIONS).mode("append").csv(f"{folder}/drops")
        ingest_new_files(spark, f"{folder}/drops", "orders_master", f"{folder}/state")
    return current_table(spark, "orders_master", f"{folder}/state")


# What the first drop of some tables says otherwise: payments of a hot order or of none, other buyers, owners, states.
FIRST_SENT = {
    "payments": {"order_id": "CASE _ingest_seq % 7 WHEN 1 THEN '1' WHEN 2 THEN 'NA' ELSE order_id END"},
    "orders_master": {
        "customer_id": "CASE WHEN _ingest_seq % 11 = 1 THEN '7' ELSE customer_id END",
        "order_date": "CASE WHEN _ingest_seq % 13 = 2 THEN '1995-05-05' ELSE order_date END",
    },
    "customers": {"segment": "CASE WHEN _ingest_seq % 6 = 1 THEN 'early' ELSE segment END"},
    "customer_cards": {
        "customer_id": "CASE WHEN _ingest_seq % 8 = 2 THEN '3' ELSE customer_id END",
        "card_status": "CASE WHEN _ingest_seq % 8 = 1 THEN 'blocked' ELSE card_status END",
    },
}
# What arrives in the second drop of the tables whose rows are not replaced.
SECOND_DROP = {
    "order_details": "coalesce(quantity = '50', false)",
    "card_points_ledger": "event_type = 'EARN' OR points_delta = '20'",
    "points_thresholds": "threshold_id IN ('999', '3')",
}


# Drops arrive as compressed files, none of more rows than a task can read: a compressed file cannot be split.
# Each is read once, so it is compressed in less time rather than to fewer bytes.
DROP_OPTIONS = {**CSV_OPTIONS, "compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "1000000"}


def raw_drops(cells: dict[str, DataFrame]) -> list[dict[str, DataFrame]]:
    """Raw tables in three drops: some rows as first sent otherwise, then as they are, then what is sent again."""
    drops: list[dict[str, DataFrame]] = [{}, {}, {}]
    for table, rows in cells.items():
        if table in SECOND_DROP:
            later = F.expr(SECOND_DROP[table])
            drops[0][table], drops[1][table] = rows.where(~later), rows.where(later)
            continue
        once = rows.where("_ingest_seq < 100000000")
        first = once.withColumns({name: F.expr(sql) for name, sql in FIRST_SENT[table].items()})
        changed = " OR ".join(f"NOT ({name} <=> {sql})" for name, sql in FIRST_SENT[table].items())
        drops[0][table], drops[1][table] = first, once.where(changed)
        drops[2][table] = rows.where("_ingest_seq >= 100000000")
    return drops


def dropped_state(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], ledger: bool) -> str:
    """Ingest the drops one after the other, with columns in another order each time, and refresh after each.

    The tables of a drop are ingested at the same time.
    """
    folder = work_folder(spark, "incremental-facts")

    def arrive(number: int, table: str, rows: DataFrame) -> None:
        columns = sorted(RAW_COLUMNS[table])[:: 1 - 2 * (number % 2)]
        rows.select(*columns).write.options(**DROP_OPTIONS).mode("append").csv(f"{folder}/drops/{table}")
        ingest_new_files(spark, f"{folder}/drops/{table}", table, f"{folder}/state/{table}")
        if number == 1:
            compact(spark, table, f"{folder}/state/{table}", upto=0)

    for number, drop in enumerate(raw_drops(raw_cells(spark, sf_dir, *tables))):
        side_by_side(spark, {table: partial(arrive, number, table, rows) for table, rows in drop.items()})
        refresh(spark, f"{folder}/state", ledger)
    return f"{folder}/state"


def incremental_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact after payments have moved between orders or were lost, and orders changed buyer and month."""
    return current_fact_orders(spark, dropped_state(spark, sf_dir, ORDER_INPUTS, ledger=False))


def incremental_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points ledger after drops that change orders, cards, owners, booked earns and tiers."""
    return current_fact(spark, dropped_state(spark, sf_dir, LEDGER_INPUTS, ledger=True), LEDGER).drop(MONTH)


def incremental_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four reports from signed deltas, as (report, group_key, measure, value)."""
    reports = current_reports(spark, dropped_state(spark, sf_dir, LEDGER_INPUTS, ledger=True))
    keys = {
        "revenue_by_day": ["order_date"],
        "revenue_by_customer_segment": ["customer_segment"],
        "loyalty_card_summary": ["card_id", "customer_id", "card_status"],
        "kpi_summary": ["kpi_name"],
    }
    parts = []
    for name, df in reports.items():
        rows = plain(df)
        measures = [
            F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in rows.columns if m not in keys[name]
        ]
        key = F.concat_ws("|", *(F.col(k).cast("string") for k in keys[name]))
        parts.append(rows.select(F.lit(name).alias("report"), key.alias("group_key"), F.inline(F.array(*measures))))
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Query] = {
    "raw_scan": raw_scan,
    "norm_numeric": norm_numeric,
    "norm_datetime": norm_datetime,
    "norm_datetime_formats": norm_datetime_formats,
    "norm_lower": norm_lower,
    "norm_upper": norm_upper,
    "norm_title": norm_title,
    "norm_strip": norm_strip,
    "norm_price": norm_price,
    "norm_fill": norm_fill,
    "dedup_latest": query_dedup_latest,
    "dedup_exact": query_dedup_exact,
    **{
        name: staged(name)
        for name in (
            "stg_orders_master", "stg_order_details", "stg_payments", "stg_customers", "stg_customer_cards",
            "stg_products", "stg_points_thresholds", "stg_card_points_ledger",
        )
    },
    "dim_customers": dim_customers,
    "dim_products": dim_products,
    "fact_order_lines": fact_order_lines,
    "fact_payments": fact_payments,
    "order_amounts": order_amounts,
    "payment_aggregates": payment_aggregates,
    "latest_payment_status": latest_payment_status,
    "fact_orders": fact_orders,
    "tier_lookup": query_tier_lookup,
    "tier_lookup_many": tier_lookup_many,
    "points_default_tiers": points_default_tiers,
    "orders_from_files": orders_from_files,
    "written_fact_orders": written_fact_orders,
    "ledger_own_owner": ledger_own_owner,
    "ledger_computed_earn": ledger_computed_earn,
    "fact_card_points_ledger": fact_card_points_ledger,
    "card_balance": card_balance,
    "revenue_by_day": revenue_by_day,
    "revenue_by_customer_segment": revenue_by_customer_segment,
    "loyalty_card_summary": loyalty_card_summary,
    "kpi_summary": kpi_summary,
    "data_quality_report": data_quality_report,
    **{f"dq_{name}": quality_check(name) for name in quality.CHECKS},
    "run_summary": query_run_summary,
    "x_redemption_events": redemption_events,
    "x_balance_at_payment": balance_at_payment,
    "x_customer_scd2": customer_history,
    "x_schema_violations": schema_violations,
    "x_rejected_rows": rejected_rows,
    "x_incremental_orders": incremental_orders,
    "x_incremental_fact_orders": incremental_fact_orders,
    "x_incremental_ledger": incremental_ledger,
    "x_incremental_reports": incremental_reports,
}


def queries() -> dict[str, Query]:
    """Every query with its decimals in comparable form."""
    return {
        name: lambda spark, sf_dir, build=build: plain(build(spark, sf_dir)) for name, build in QUERIES.items()
    }
