from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import SMALL, raw_frame
from pyspark.sql import functions as F

from ledgerloom_checks.raw_inputs import raw_tables
from ledgerloom.plans import analytics, loyalty, marts, quality, staging
from ledgerloom.plans.staging import build_staging

# A tiny shop, in arrival order per table.
SHOP = {
    "customers": [
        ("1", " Ann ", "b2c", "o'land", "2025-01-01", "ann@example.com"),
        ("2", "Bob", "VIP", "italy", "bad", "NA"),
        ("3", "Cid", None, "italy", "2025-01-01", None),
        ("x", "Nobody", "B2B", "italy", "2025-01-01", None),
        ("1", "Ann", " b2b ", "o'land", "2025-01-02", "ann2@example.com"),
    ],
    "customer_cards": [
        (" c1", "1", "2025-01-01", "Active "),
        ("C1B", "1", "2025-01-01", "active"),
        ("C2", "2", "2025-01-01", "blocked"),
        ("C3", "3", "2025-01-01", "active"),
        ("", "3", "2025-01-01", "active"),
        ("C9", None, "2025-01-01", "active"),
    ],
    "products": [
        (" p1", "Pen", "office supply", "1.50", "True"),
        ("P2", "Ink", "office supply", "n/a", "False"),
        (None, "Ghost", "none", "1", "True"),
    ],
    "orders_master": [
        ("10", "1", "2026-01-01", " Paid ", "Online", "chf"),
        ("11", "1", "bad", "paid", "Online", "chf"),
        ("12", "2", "2026-01-02", "paid", "Online", "chf"),
        ("13", "3", "2026-01-02", "cancelled", "Online", "chf"),
        ("14", "99", "2026-01-03", "paid", "Online", "chf"),
        ("15", "1", "2026-01-03", "paid", "Online", "chf"),
        ("15", None, "2026-01-03", "paid", "Online", "chf"),
        ("16", "3", "2026-01-04", "paid", "Online", "chf"),
        ("17", "2", "2026-01-04", "paid", "Online", "chf"),
    ],
    "order_details": [
        ("10", "1", "p1", "2", "30.00 CHF", "10"),
        ("10", "1", "P1 ", "2", "30.00", "10.0"),
        ("10", "2", "p1", "2", "30.00 CHF", "10"),
        ("11", "1", "p2", None, "60", None),
        ("12", "1", "p7", "1", "100", "0"),
        ("13", "1", "", "1", "5", "0"),
        ("14", "1", "p1", "1", "50", "0"),
        ("16", "1", "p1", "1", "bad", "0"),
        ("77", "1", "p1", "1", "1", "0"),
        ("10", None, "p1", "1", "1", "0"),
    ],
    "payments": [
        ("100", "10", "2026-01-01", "Card", "failed", "108", None, None),
        ("101", "10", "2026-01-02", "card", "Success ", "108", None, None),
        ("102", "11", "2026-01-01", "points", "success", "70", "C1", "5"),
        ("103", "12", None, "installment", "pending", "100", None, None),
        ("104", "12", "2026-01-05", "card", "success", "40", "c2", None),
        ("105", "13", "2026-01-05", "refund", "success", "7", "C1", None),
        ("106", "14", "2026-01-05", "card", "success", "50", "C3", None),
        ("107", "16", "2026-01-05", "card", "success", "10", "C404", None),
        ("108", "99", "2026-01-05", "points", "failed", "0", "", "3"),
        ("109", "15", "2026-01-05", "card", "success", "9", "C1", None),
        ("101", "10", "2026-01-02", "card", "success", "108.00", None, None),
        (None, "10", "2026-01-02", "card", "success", "1", None, None),
    ],
    "points_thresholds": [("1", "0", "49.99", "1"), ("2", "50", "99.99", "3"), ("3", "100", None, "8"), ("x", "0", None, "9")],
    "card_points_ledger": [
        ("L1", "C1", "10.0", "2026-01-01", "Earn", "8"),
        ("L2", "c2", None, "2026-01-01", "redeem", "-5"),
        ("L3", "C777", None, "2026-01-01", "adjustment", "4"),
        ("L4", "", None, "2026-01-01", "earn", "4"),
        ("L5", "C1", None, "2026-01-01", "redeem", "-2.5"),
        ("L6", "C1", None, "2026-01-01", "redeem", "oops"),
    ],
}


@pytest.fixture(scope="module")
def raw(spark):
    return {table: raw_frame(spark, table, rows) for table, rows in SHOP.items()}


@pytest.fixture(scope="module")
def stg(raw):
    return build_staging(raw)


@pytest.fixture(scope="module")
def built(stg):
    return marts.build_marts(stg)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_customers(stg):
    rows = by(stg["stg_customers"], "customer_id")
    assert sorted(rows) == [1, 2, 3]
    assert tuple(rows[1])[1:] == ("Ann", "B2B", "O'Land", datetime(2025, 1, 2), "ann2@example.com")
    assert rows[2].signup_date is None and rows[2].email is None and rows[3].segment is None


def test_cards_and_products_drop_blank_keys(stg):
    assert sorted(by(stg["stg_customer_cards"], "card_id")) == ["C1", "C1B", "C2", "C3"]
    products = by(stg["stg_products"], "product_id")
    assert sorted(products) == ["P1", "P2"]
    assert products["P1"].category == "Office Supply" and products["P1"].is_active is True
    assert products["P2"].standard_price is None


def test_orders_vanish_when_their_last_copy_lacks_a_customer(stg):
    assert sorted(by(stg["stg_orders_master"], "order_id")) == [10, 11, 12, 13, 14, 16, 17]


def test_details_drop_exact_copies_only_and_keep_blank_products(stg):
    lines = Counter((r.order_id, r.line_id, r.product_id) for r in stg["stg_order_details"].collect())
    assert lines == Counter(
        [(10, 1, "P1"), (10, 2, "P1"), (11, 1, "P2"), (12, 1, "P7"), (13, 1, ""), (14, 1, "P1"), (16, 1, "P1"), (77, 1, "P1")]
    )


def test_thresholds_and_ledger(stg):
    assert sorted(by(stg["stg_points_thresholds"], "threshold_id")) == [1, 2, 3]
    ledger = by(stg["stg_card_points_ledger"], "ledger_id")
    assert sorted(ledger) == ["L1", "L2", "L3", "L5", "L6"]
    assert ledger["L1"].order_id == 10 and ledger["L6"].points_delta == 0


def test_order_lines(built):
    lines = {(r.order_id, r.line_id): r for r in built["fact_order_lines"].collect()}
    assert lines[10, 1].line_gross == 60 and lines[10, 1].line_net == 54
    assert lines[10, 1].has_valid_product and lines[10, 1].product_category == "Office Supply"
    assert not lines[12, 1].has_valid_product and not lines[13, 1].has_valid_product
    assert lines[11, 1].line_net == 60  # quantity defaults to 1, discount to 0


def test_payment_flags(built):
    rows = by(built["fact_payments"], "payment_id")
    assert rows[105].is_refund and rows[105].cash_collected_amount == 7 and rows[105].refund_amount == 7
    assert rows[102].is_points_payment and rows[103].is_pending and rows[103].is_installment_payment
    assert rows[100].is_failed and rows[100].cash_collected_amount == 0


def test_failed_refunds_and_negative_successes_count_as_refund_and_nothing(spark):
    rows = [("1", "1", None, "refund", "failed", "-9", None, None), ("2", "1", None, "card", "success", "-4", None, None)]
    facts = by(marts.fact_payments(staging.stg_payments(raw_frame(spark, "payments", rows))), "payment_id")
    assert facts[1].refund_amount == 9 and facts[1].cash_collected_amount == 0
    assert facts[2].refund_amount == 0 and facts[2].cash_collected_amount == 0


def test_orders(built):
    rows = by(built["fact_orders"], "order_id")
    assert len(rows) == 7
    ten = rows[10]
    assert ten.order_expected_amount == 108 and ten.net_collected_amount == 108
    assert ten.is_fully_paid and not ten.is_overpaid and ten.is_valid_revenue
    assert ten.payment_event_count == 2 and ten.latest_payment_status == "success" and ten.customer_segment == "B2B"
    assert rows[11].is_overpaid and rows[11].points_used == 5
    assert rows[12].latest_payment_status == "pending" and rows[12].has_pending_payment  # unknown time is last
    assert rows[12].is_partially_paid and rows[12].installment_event_count == 1
    assert rows[13].has_refund and rows[13].net_collected_amount == 0 and not rows[13].is_valid_revenue
    assert not rows[14].has_customer and rows[14].customer_segment is None
    assert rows[16].order_expected_amount == 0 and not rows[16].is_overpaid  # no readable price
    assert rows[17].order_expected_amount == 0 and not rows[17].has_any_payment and rows[17].latest_payment_status is None


def test_sub_cent_amounts_are_not_rounded(spark):
    rows = [("1", "1", "p", "1", "9.99", "15")]
    lines = marts.price_lines(staging.stg_order_details(raw_frame(spark, "order_details", rows)))
    assert lines.first().line_net == Decimal("8.4915")


def test_ledger_earns_per_active_card_unless_already_earned(built):
    rows = built["fact_card_points_ledger"].collect()
    computed = {(r.card_id, r.order_id): r for r in rows if r.ledger_source == "computed_threshold"}
    # Order 10 earned on C1 already; 11 has no date; 12 is on a blocked card; 16 is worth 0.
    assert {k: r.points_delta for k, r in computed.items()} == {("C1B", 10): 8, ("C1", 11): 3, ("C1B", 11): 3, ("C3", 16): 1}
    assert computed["C1", 11].event_datetime is None and computed["C1", 11].ledger_id is None
    raw_rows = {r.ledger_id: r for r in rows if r.ledger_source == "raw"}
    assert len(raw_rows) == 5
    unknown = raw_rows["L3"]
    assert unknown.customer_id is None and unknown.card_status is None and not unknown.is_valid_card
    assert raw_rows["L2"].customer_id == 2 and raw_rows["L2"].card_status == "blocked"


def test_an_owner_in_the_raw_ledger_wins(spark, stg):
    ledger = stg["stg_card_points_ledger"].withColumn("customer_id", F.when(F.col("ledger_id") == "L3", 42).cast("bigint"))
    events = by(loyalty.raw_events(ledger, stg["stg_customer_cards"], staging.frequent_keys(ledger, "card_id")), "ledger_id")
    assert events["L3"].customer_id == 42 and events["L1"].customer_id == 1


def test_reports_drop_null_groups(built):
    days = [tuple(r)[:2] for r in analytics.revenue_by_day(built["fact_orders"]).collect()]
    assert days == [(date(2026, 1, 1), 1), (date(2026, 1, 2), 1), (date(2026, 1, 3), 1), (date(2026, 1, 4), 1)]
    segments = [(r.customer_segment, r.order_count) for r in analytics.revenue_by_customer_segment(built["fact_orders"]).collect()]
    assert segments == [("B2B", 2), ("VIP", 1)]


def test_card_summary(built):
    rows = by(analytics.loyalty_card_summary(built["fact_card_points_ledger"]), "card_id")
    assert (rows["C1"].points_earned, rows["C1"].points_redeemed) == (11, 2)
    assert rows["C1"].points_balance == Decimal("8.5") and rows["C1"].transaction_count == 4
    assert rows["C777"].customer_id is None and rows["C777"].points_balance == 4


def kpis(orders, ledger):
    return {r.kpi_name: r.kpi_value for r in analytics.kpi_summary(orders, ledger).collect()}


def test_kpis(built):
    values = kpis(built["fact_orders"], built["fact_card_points_ledger"])
    assert list(values) == list(analytics.KPI_NAMES)
    assert values["total_orders"] == 7 and values["valid_revenue_orders"] == 5
    assert values["conversion_rate"] == 0.714286
    assert values["net_collected_revenue"] == 278 and values["avg_order_value"] == 55.6
    assert values["active_cards"] == 3 and values["points_earned"] == 27 and values["points_redeemed"] == 7
    assert values["points_liability"] == 24  # 8.5 + 11 + 1 + 4, the blocked card owes 5
    assert values["orders_paid_with_points"] == 1
    assert values["loyalty_revenue_share"] == round((108 + 70 + 10) / 278, 6)


def test_quality_report(raw, stg, built):
    report = quality.quality_report(raw, stg, built).collect()
    assert [r.check_name for r in report] == list(quality.CHECKS)
    counts = {r.check_name: r.failed_count for r in report}
    assert counts == {
        "duplicate_orders": 2, "duplicate_payment_ids": 2, "orders_without_customer": 1,
        "order_details_without_order": 1, "order_lines_with_invalid_product": 2, "payments_without_order": 2,
        "payments_with_invalid_card": 1, "payments_with_card_not_owned_by_customer": 3,
        "payments_using_inactive_or_blocked_card": 1, "orders_without_payment": 1,
        "cancelled_orders_with_successful_payment": 1, "paid_orders_without_successful_payment": 1,
        "orders_with_negative_expected_amount": 0, "orders_overpaid": 1, "points_used_without_card": 1,
        "points_ledger_invalid_card": 1, "negative_points_balance": 1,
    }


def test_raw_ids_repeat_as_numbers_or_as_text(spark):
    rows = [(i, None, None, None, None, None) for i in ("1", "1.0", "abc", "abc", None, None, "2")]
    raw_orders = {"orders_master": raw_frame(spark, "orders_master", rows)}
    assert quality.repeated_orders(raw_orders, {}, {}).first().duplicate_orders == 4


def test_empty_inputs_keep_their_schemas(spark, raw, built):
    empty = {table: df.where("false") for table, df in raw.items()}
    stg = build_staging(empty)
    facts = marts.build_marts(stg)
    for name, df in facts.items():
        assert df.schema.simpleString() == built[name].schema.simpleString()
        assert df.count() == 0
    assert set(kpis(facts["fact_orders"], facts["fact_card_points_ledger"]).values()) == {0.0}
    report = quality.quality_report(empty, stg, facts).collect()
    assert len(report) == 17 and not any(r.failed_count for r in report)


def test_outputs_do_not_depend_on_input_partitioning(spark):
    def outputs(raw):
        facts = marts.build_marts(build_staging(raw))
        tables = [facts["fact_orders"], facts["fact_card_points_ledger"]]
        tables += [analytics.revenue_by_day(facts["fact_orders"]), analytics.loyalty_card_summary(facts["fact_card_points_ledger"])]
        return [Counter(map(tuple, df.collect())) for df in tables]

    raw = raw_tables(spark, SMALL)
    shuffled = {name: df.repartition(7, F.rand(3)) for name, df in raw.items()}
    assert outputs(raw) == outputs(shuffled)
