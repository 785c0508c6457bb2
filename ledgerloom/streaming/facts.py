"""Facts and reports kept up to date: only the orders and cards that a change reaches are built again.

A change reaches more than the keys it names. A payment that is sent again for another order changes both orders; a
card with another owner changes the earns of both owners' orders; a new tier those of the orders whose points it
changes. So every new batch is joined with the versions that it replaces (its before-image), as of the batch the facts
have seen.

At first every order and card is affected, so the facts are built from the whole tables without asking which.

The order fact holds an order's sums over its lines and payments. An affected order whose lines have not changed keeps
the sum it has, and likewise for payments, so only lines and payments of orders that got or lost some are read again.

Facts lie by month (:mod:`ledgerloom.sources.monthly`): a refresh writes the months of the rows it takes away or adds
anew, and publishes one manifest (:mod:`ledgerloom.sources.manifest`) with the month folders in force, the report deltas
in force, and the batches seen. Until then readers see the state before; a refresh that fails is made again in full.

State below one folder: a folder per ingested table (:mod:`ledgerloom.streaming.stored`), ``facts/<fact>/version=N``,
``reports/<report>/version=N`` and ``facts/manifest/N.json``. What no manifest in use names may expire.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import frequent_keys, tier_lookups
from ledgerloom.plans.loyalty import computed_earn, raw_events
from ledgerloom.plans.marts import (
    build_fact_orders,
    fact_orders,
    fact_payments,
    order_amounts,
    payment_aggregates,
    price_lines,
)
from ledgerloom.plans.run import PARTITION_TIMES
from ledgerloom.schema import FACT_COLUMNS
from ledgerloom.sources import work_folder
from ledgerloom.sources.manifest import last_number, publish, published
from ledgerloom.sources.monthly import MONTH, Folders, month_folders, month_of, read_months, replace_months, write_months
from ledgerloom.sources.tables import COMPACT_PARQUET, side_by_side
from ledgerloom.streaming.reports import ORDER_DELTAS, POINT_DELTAS, Report, signed_deltas, write_deltas
from ledgerloom.streaming.stored import (
    current_table,
    is_reduced,
    last_batch,
    staged,
    stored_changes,
    stored_rows,
    versions_of,
)

ORDERS, LEDGER = "fact_orders", "fact_card_points_ledger"

# Tables that the facts are built from.
ORDER_INPUTS = ("orders_master", "order_details", "payments", "customers")
LEDGER_INPUTS = ("customer_cards", "points_thresholds", "card_points_ledger")

COMPUTED = "ledger_source = 'computed_threshold'"


def dated(rows: DataFrame, fact: str) -> DataFrame:
    return rows.select(*FACT_COLUMNS[fact], month_of(PARTITION_TIMES[fact]))


class Refresh:
    """One step from the state that is published to the batches that are stored now."""

    def __init__(self, spark: SparkSession, state: str, inputs: tuple[str, ...]):
        self.spark, self.state = spark, state
        self.number = last_number(spark, f"{state}/facts") + 1
        self.before = published(spark, f"{state}/facts")
        self.seen: dict[str, int] = {t: self.before.get("seen", {}).get(t, -1) for t in inputs}
        # Batches that are stored while this runs are left to the next step.
        self.now = {t: last_batch(spark, f"{state}/{t}") for t in inputs}
        # Months and schema of the facts that this step has written.
        self.months: dict[str, dict] = {}

    def written(self, df: DataFrame, purpose: str) -> DataFrame:
        """``df`` as a table of its own: read more than once, and never derived again."""
        folder = work_folder(self.spark, purpose)
        df.write.options(**COMPACT_PARQUET).parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def changes(self, table: str) -> DataFrame:
        return stored_changes(self.spark, table, f"{self.state}/{table}", self.seen[table], self.now[table])

    def rows(self, table: str) -> DataFrame:
        """All stored rows with all their versions."""
        return stored_rows(self.spark, table, f"{self.state}/{table}", self.now[table])

    def replaced(self, table: str, key: str) -> DataFrame:
        """Before-image: the rows, as staged at the batch seen, whose key has changed since."""
        place = f"{self.state}/{table}"
        earlier = stored_rows(self.spark, table, place, self.seen[table])
        once = is_reduced(self.spark, table, place, self.seen[table])
        return staged(versions_of(earlier, self.changes(table), key), table, once)

    def current(self, table: str, keys: DataFrame, key: str) -> DataFrame:
        """The staging rows of some keys; only their versions are reduced."""
        once = is_reduced(self.spark, table, f"{self.state}/{table}", self.now[table])
        return staged(versions_of(self.rows(table), keys, key), table, once)

    def whole(self, table: str) -> DataFrame:
        """The staging table as of the batches stored now."""
        return current_table(self.spark, table, f"{self.state}/{table}", self.now[table])

    def is_first(self, fact: str) -> bool:
        return fact not in self.before.get("months", {})

    def put(self, fact: str, rows: DataFrame) -> DataFrame:
        """Write a fact that was not there before; returns it as written."""
        folders = write_months(f"{self.state}/facts/{fact}", self.number, rows)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        self.months[fact] = {"folders": folders, "schema": schema.json()}
        return self.written_fact(fact)

    def written_fact(self, fact: str) -> DataFrame:
        """The fact as this step has written it."""
        months = self.months[fact]
        return read_months(self.spark, f"{self.state}/facts/{fact}", months["folders"], months["schema"])

    def in_force(self, fact: str) -> DataFrame:
        """The fact as published."""
        months = self.before["months"][fact]
        return read_months(self.spark, f"{self.state}/facts/{fact}", months["folders"], months["schema"])

    # Orders

    @cached_property
    def affected_orders(self) -> DataFrame:
        """Orders whose own rows, lines, payments (as they were or are) or customer have changed.

        ``new_lines`` and ``new_payments`` say that these have changed.
        """

        def named(rows: DataFrame, of: str = "") -> DataFrame:
            marks = (F.lit(mark == of).alias(mark) for mark in ("new_lines", "new_payments"))
            return rows.where("order_id IS NOT NULL").select("order_id", *marks)

        buyers = versions_of(self.rows("orders_master"), self.changes("customers"), "customer_id")
        found = [
            named(self.changes("orders_master")),
            named(buyers),
            named(self.changes("order_details"), "new_lines"),
            named(self.changes("payments"), "new_payments"),
            named(self.replaced("payments", "payment_id"), "new_payments"),
        ]
        marked = reduce(DataFrame.union, found).groupBy("order_id")
        orders = marked.agg(*(F.bool_or(mark).alias(mark) for mark in ("new_lines", "new_payments")))
        return self.written(orders, "affected-orders")

    @cached_property
    def lacking_orders(self) -> DataFrame:
        """The affected orders that the fact in force does not hold."""
        return self.written(
            self.affected_orders.select("order_id").join(self.old_orders, "order_id", "left_anti"), "lacking-orders"
        )

    def summed_again(self, of: str) -> DataFrame:
        """The affected orders whose sum ``of`` lines or payments the fact in force lacks.

        Written for itself: its size then tells Spark whether it can be broadcast to all stored rows.
        """
        changed = self.affected_orders.where(f"new_{of}").select("order_id")
        return self.written(changed.union(self.lacking_orders).distinct(), f"{of}-again")

    def with_kept(self, sums: DataFrame, again: DataFrame) -> DataFrame:
        """``sums`` of the orders summed ``again``, and those of the other affected ones, which the fact in force has."""
        kept = self.old_orders.join(again, "order_id", "left_anti")
        return sums.unionByName(kept.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in sums.schema)))

    def order_sums(self) -> tuple[DataFrame, DataFrame]:
        """Line and payment sums of the affected orders, as :func:`order_amounts` and :func:`payment_aggregates` give them.

        A payment's versions are all reduced, so one that has moved away is left out.
        """
        of_lines, orders = self.summed_again("lines"), self.summed_again("payments")
        lines = self.current("order_details", of_lines, "order_id")
        paid = versions_of(self.rows("payments"), orders, "order_id")
        payments = self.current("payments", paid, "payment_id").join(orders, "order_id", "left_semi")
        amounts, totals = order_amounts(price_lines(lines)), payment_aggregates(fact_payments(payments))
        return self.with_kept(amounts, of_lines), self.with_kept(totals, orders)

    @cached_property
    def new_orders(self) -> DataFrame:
        if self.is_first(ORDERS):
            whole = {f"stg_{table}": self.whole(table) for table in ORDER_INPUTS}
            frequent = {"customer_id": frequent_keys(self.rows("orders_master"), "customer_id")}
            return self.put(ORDERS, dated(build_fact_orders(whole, frequent), ORDERS))
        # Read three times: for its customers, for the frequent ones among them, and for its rows.
        own = self.written(self.current("orders_master", self.affected_orders, "order_id"), "own-orders")
        customers = self.current("customers", own.select("customer_id").distinct(), "customer_id")
        rows = fact_orders(own, customers, *self.order_sums(), frequent_keys(own, "customer_id"))
        return self.written(dated(rows, ORDERS), "new-orders")

    @cached_property
    def old_orders(self) -> DataFrame:
        if self.is_first(ORDERS):
            return self.spark.createDataFrame([], self.new_orders.schema)
        return self.written(self.without_order(self.in_force(ORDERS), "left_semi"), "old-orders")

    def without_order(self, rows: DataFrame, how: str) -> DataFrame:
        return rows.join(self.affected_orders, "order_id", how).select(*rows.columns)

    def all_orders(self) -> DataFrame:
        """The order fact as it will be: its months are written before the ledger asks."""
        return self.written_fact(ORDERS)

    # Ledger

    @cached_property
    def changed_cards(self) -> DataFrame:
        return self.written(self.changes("customer_cards").select("card_id").distinct(), "changed-cards")

    @cached_property
    def reached_orders(self) -> DataFrame:
        """Orders whose computed earns may differ: changed ones, those of a changed card's owners, those whose earn
        is booked now, and those whose points a change of the tiers changes."""
        cards = self.current("customer_cards", self.changed_cards, "card_id")
        owners = self.replaced("customer_cards", "card_id").select("customer_id").union(cards.select("customer_id"))
        valid = self.all_orders().where("is_valid_revenue")
        named = [
            self.affected_orders.select("order_id"),
            versions_of(valid, owners.distinct(), "customer_id").select("order_id"),
            self.changes("card_points_ledger").where("event_type = 'earn' AND order_id IS NOT NULL").select("order_id"),
        ]
        if self.now["points_thresholds"] > self.seen["points_thresholds"]:
            place = f"{self.state}/points_thresholds"
            tiers = {
                points: current_table(self.spark, "points_thresholds", place, of["points_thresholds"])
                for points, of in (("old_points", self.seen), ("new_points", self.now))
            }
            amounts = valid.select("order_id", "order_expected_amount")
            both = tier_lookups(amounts, "order_expected_amount", tiers)
            named.append(both.where("old_points <> new_points").select("order_id"))
        return self.written(reduce(DataFrame.union, named).distinct(), "reached-orders")

    @cached_property
    def new_ledger(self) -> DataFrame:
        """Earns of the orders reached, all events of changed cards, and new events of others."""
        booked, tiers = self.whole("card_points_ledger"), self.whole("points_thresholds")
        valid = self.all_orders().where("is_valid_revenue")
        if self.is_first(LEDGER):
            cards = self.whole("customer_cards")
            earned = computed_earn(valid, cards, tiers, booked, frequent_keys(valid, "customer_id"))
            raw = raw_events(booked, cards, frequent_keys(booked, "card_id"))
            return self.put(LEDGER, self.ledger_rows(raw, earned))
        # Read several times: what earns need of the orders reached.
        eligible = valid.select("order_id", "customer_id", "order_date", "order_expected_amount", "is_valid_revenue")
        orders = self.written(versions_of(eligible, self.reached_orders, "order_id"), "earning-orders")
        owned = versions_of(self.rows("customer_cards"), orders.select("customer_id").distinct(), "customer_id")
        earned = computed_earn(
            orders, self.current("customer_cards", owned, "card_id"), tiers, booked, frequent_keys(orders, "customer_id")
        )
        of_changed = versions_of(self.rows("card_points_ledger"), self.changed_cards, "card_id")
        others = self.changes("card_points_ledger").join(self.changed_cards, "card_id", "left_anti")
        # Read before it is joined twice: for its cards, and for its rows.
        events = self.written(staged(of_changed.unionByName(others), "card_points_ledger"), "events")
        cards = self.current("customer_cards", events.select("card_id").distinct(), "card_id")
        raw = raw_events(events, cards, frequent_keys(events, "card_id"))
        return self.written(self.ledger_rows(raw, earned), "new-ledger")

    def ledger_rows(self, raw: DataFrame, earned: DataFrame) -> DataFrame:
        both = raw.unionByName(earned, allowMissingColumns=True)
        return dated(both.withColumn("is_valid_card", F.col("customer_id").isNotNull()), LEDGER)

    @cached_property
    def old_ledger(self) -> DataFrame:
        if self.is_first(LEDGER):
            return self.spark.createDataFrame([], self.new_ledger.schema)
        return self.written(self.without_reached(self.in_force(LEDGER), "left_semi"), "old-ledger")

    def without_reached(self, rows: DataFrame, how: str) -> DataFrame:
        """Rows with or without the earns of orders reached and the events of changed cards."""
        earned = rows.where(COMPUTED).join(self.reached_orders, "order_id", how)
        raw = rows.where(f"NOT {COMPUTED}").join(self.changed_cards, "card_id", how)
        return earned.select(*rows.columns).union(raw.select(*rows.columns))

    # Publication

    def replace(self, fact: str, old: DataFrame, new: DataFrame, rest: Callable[[DataFrame, str], DataFrame]) -> None:
        """Write the months of the ``old`` and ``new`` rows again, unless the fact is new and lies there already."""
        if self.is_first(fact):
            return
        folder = f"{self.state}/facts/{fact}"
        before = self.before["months"][fact]
        months = month_folders(old, new)
        touched: Folders = {m: v for m, v in before["folders"].items() if m in months}
        kept = rest(read_months(self.spark, folder, touched, before["schema"]), "left_anti")
        folders = replace_months(folder, before["folders"], self.number, months, kept.unionByName(new))
        self.months[fact] = {"folders": folders, "schema": before["schema"]}

    def deltas(self, reports: dict, old: DataFrame, new: DataFrame) -> dict[str, list[int]]:
        """Write the reports' deltas; returns the versions that then count."""
        before = self.before.get("deltas", {})

        def write(name: str, report: Report) -> list[int]:
            delta = signed_deltas(report, old, new)
            return write_deltas(f"{self.state}/reports/{name}", before.get(name, []), self.number, delta, report.keys)

        return side_by_side(self.spark, {name: partial(write, name, report) for name, report in reports.items()})


def refresh(spark: SparkSession, state: str, ledger: bool = True) -> None:
    """Bring the facts and reports below ``state`` up to the batches that are stored; without ``ledger`` the orders alone.

    ``state`` holds one folder per table, as :func:`ingest_new_files` writes them.
    """
    # A ledger, once there, follows its orders.
    ledger = ledger or LEDGER in published(spark, f"{state}/facts").get("months", {})
    step = Refresh(spark, state, (*ORDER_INPUTS, *(LEDGER_INPUTS if ledger else ())))
    if step.now == step.seen:
        return
    step.replace(ORDERS, step.old_orders, step.new_orders, step.without_order)

    def order_deltas() -> dict[str, list[int]]:
        return step.deltas(ORDER_DELTAS, step.old_orders, step.new_orders)

    def ledger_deltas() -> dict[str, list[int]]:
        step.replace(LEDGER, step.old_ledger, step.new_ledger, step.without_reached)
        return step.deltas(POINT_DELTAS, step.old_ledger, step.new_ledger)

    # The ledger asks for the orders' months, not for their deltas.
    written = side_by_side(spark, {"orders": order_deltas} | ({"points": ledger_deltas} if ledger else {}))
    deltas = {name: versions for of in written.values() for name, versions in of.items()}
    publish(spark, f"{state}/facts", step.number, {"seen": step.now, "months": step.months, "deltas": deltas})


def current_fact(spark: SparkSession, state: str, fact: str) -> DataFrame:
    """The fact as of the last refresh, with its month; a filter on the month reads that month only."""
    months = published(spark, f"{state}/facts")["months"][fact]
    return read_months(spark, f"{state}/facts/{fact}", months["folders"], months["schema"])


def rebuild_fact_orders(spark: SparkSession, state: str) -> None:
    """Refresh the order fact and its reports alone."""
    refresh(spark, state, ledger=False)


def current_fact_orders(spark: SparkSession, state: str) -> DataFrame:
    """``fact_orders`` as of the last refresh."""
    return current_fact(spark, state, ORDERS).drop(MONTH)


def restrict_to_orders(stg: dict[str, DataFrame], affected: DataFrame) -> dict[str, DataFrame]:
    """Staging tables cut to the ``affected`` order ids, to build just those rows of ``fact_orders``."""
    by_order = ("stg_orders_master", "stg_order_details", "stg_payments")
    return {
        name: df.join(affected, "order_id", "left_semi") if name in by_order else df for name, df in stg.items()
    }
