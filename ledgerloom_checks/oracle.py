"""DuckDB SQL for every registered query, written independently of the Spark plans.

``CTES`` holds one statement per table; a query's SQL is the statement plus the tables it needs.
"""

from __future__ import annotations

import re

from ledgerloom_checks.raw_inputs import RAW_SQL, SOURCE_TABLES

# Raw cells that mean "missing".
TOKENS = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)


def cell(c: str) -> str:
    return f"(CASE WHEN {c} IN ({TOKENS}) THEN NULL ELSE {c} END)"


def strip(c: str) -> str:
    return rf"regexp_replace({cell(c)}, '^\s+|\s+$', '', 'g')"


def lower(c: str) -> str:
    return f"lower({strip(c)})"


def upper(c: str) -> str:
    return f"upper({strip(c)})"


def title(c: str) -> str:
    runs = f"regexp_extract_all({lower(c)}, '[a-z]+|[^a-z]+')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1:1]) || r[2:]), '')"


def ident(c: str) -> str:
    return f"TRY_CAST({cell(c)} AS BIGINT)"


def number(c: str, kind: str = "DECIMAL(18,4)") -> str:
    return f"TRY_CAST({cell(c)} AS {kind})"


def moment(c: str) -> str:
    return f"TRY_CAST({cell(c)} AS TIMESTAMP)"


def money(c: str) -> str:
    """Money as a double by way of four exact decimals."""
    return f"CAST(CAST({c} AS DECIMAL(18,4)) AS DOUBLE)"


def last_per(key: str, source: str) -> str:
    return f"SELECT * EXCLUDE (_n) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY _ingest_seq DESC) AS _n FROM ({source})) WHERE _n = 1"


RAW_CTES = {f"{name}_raw": sql.format(**{t: t for t in SOURCE_TABLES}) for name, sql in RAW_SQL.items()}

TYPED_ORDERS = f"""SELECT _ingest_seq, {ident('order_id')} AS order_id, {ident('customer_id')} AS customer_id,
  {moment('order_date')} AS order_date, {lower('order_status')} AS order_status,
  {lower('sales_channel')} AS sales_channel, {upper('currency')} AS currency FROM orders_master_raw"""

TYPED_PAYMENTS = f"""SELECT _ingest_seq, {ident('payment_id')} AS payment_id, {ident('order_id')} AS order_id,
  {moment('payment_datetime')} AS payment_datetime, {lower('payment_type')} AS payment_type,
  {lower('payment_status')} AS payment_status, coalesce({number('payment_amount')}, 0) AS payment_amount,
  coalesce({upper('card_id')}, '') AS card_id, coalesce({number('points_used')}, 0) AS points_used FROM payments_raw"""

TYPED_CUSTOMERS = f"""SELECT _ingest_seq, {ident('customer_id')} AS customer_id, {strip('customer_name')} AS customer_name,
  {upper('segment')} AS segment, {title('country')} AS country, {moment('signup_date')} AS signup_date,
  {cell('email')} AS email FROM customers_raw"""

TYPED_CARDS = f"""SELECT _ingest_seq, coalesce({upper('card_id')}, '') AS card_id, {ident('customer_id')} AS customer_id,
  {moment('card_created_at')} AS card_created_at, {lower('card_status')} AS card_status FROM customer_cards_raw"""

TYPED_PRODUCTS = f"""SELECT _ingest_seq, coalesce({upper('product_id')}, '') AS product_id, {strip('product_name')} AS product_name,
  {title('category')} AS category, {number('standard_price', 'DECIMAL(14,4)')} AS standard_price,
  CASE {lower('is_active')} WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS is_active FROM products_raw"""

PRICE = f"TRY_CAST(regexp_replace({cell('unit_price')}, ' CHF', '', 'gi') AS DECIMAL(14,4))"

CTES: dict[str, str] = RAW_CTES | {
    "stg_orders_master": f"SELECT * EXCLUDE (_ingest_seq) FROM ({last_per('order_id', TYPED_ORDERS)}) WHERE order_id IS NOT NULL AND customer_id IS NOT NULL",
    "stg_order_details": f"""SELECT DISTINCT * FROM (SELECT {ident('order_id')} AS order_id, {ident('line_id')} AS line_id,
  coalesce({upper('product_id')}, '') AS product_id, coalesce({number('quantity', 'DECIMAL(12,3)')}, 1) AS quantity,
  {PRICE} AS unit_price, coalesce({number('discount_pct', 'DECIMAL(9,4)')}, 0) AS discount_pct FROM order_details_raw)
  WHERE order_id IS NOT NULL AND line_id IS NOT NULL""",
    "stg_payments": f"SELECT * EXCLUDE (_ingest_seq) FROM ({last_per('payment_id', TYPED_PAYMENTS)}) WHERE payment_id IS NOT NULL AND order_id IS NOT NULL",
    "stg_customers": f"SELECT * EXCLUDE (_ingest_seq) FROM ({last_per('customer_id', TYPED_CUSTOMERS)}) WHERE customer_id IS NOT NULL",
    "stg_customer_cards": f"SELECT * EXCLUDE (_ingest_seq) FROM ({last_per('card_id', TYPED_CARDS)}) WHERE card_id <> '' AND customer_id IS NOT NULL",
    "stg_products": f"SELECT * EXCLUDE (_ingest_seq) FROM ({last_per('product_id', TYPED_PRODUCTS)}) WHERE product_id <> ''",
    "stg_points_thresholds": f"""SELECT * FROM (SELECT {ident('threshold_id')} AS threshold_id, {number('min_amount')} AS min_amount,
  {number('max_amount')} AS max_amount, {number('points_awarded')} AS points_awarded FROM points_thresholds_raw)
  WHERE threshold_id IS NOT NULL AND min_amount IS NOT NULL AND points_awarded IS NOT NULL""",
    "stg_card_points_ledger": f"""SELECT * FROM (SELECT {cell('ledger_id')} AS ledger_id, coalesce({upper('card_id')}, '') AS card_id,
  {ident('order_id')} AS order_id, {moment('event_datetime')} AS event_datetime, {lower('event_type')} AS event_type,
  coalesce({number('points_delta')}, 0) AS points_delta FROM card_points_ledger_raw) WHERE card_id <> ''""",
    "fact_order_lines": """SELECT d.order_id, d.line_id, d.product_id, d.quantity, d.unit_price, d.discount_pct,
  d.quantity * d.unit_price AS line_gross,
  CAST(d.quantity * d.unit_price AS DECIMAL(29,7)) * CAST(1 - CAST(d.discount_pct AS DECIMAL(12,6)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(9,6)) AS line_net,
  p.product_id IS NOT NULL AS has_valid_product, p.category AS product_category
  FROM stg_order_details d LEFT JOIN stg_products p ON d.product_id = p.product_id""",
    "fact_payments": """SELECT payment_id, order_id, payment_datetime, payment_type, payment_status, payment_amount, card_id, points_used,
  coalesce(payment_status = 'success', FALSE) AS is_successful_payment,
  coalesce(payment_status = 'refunded', FALSE) OR coalesce(payment_type = 'refund', FALSE) AS is_refund,
  coalesce(payment_status = 'pending', FALSE) AS is_pending, coalesce(payment_status = 'failed', FALSE) AS is_failed,
  coalesce(payment_type IN ('points', 'loyalty_card'), FALSE) AS is_points_payment,
  coalesce(payment_type = 'installment', FALSE) AS is_installment_payment,
  CASE WHEN payment_status = 'success' AND payment_amount > 0 THEN payment_amount ELSE 0 END AS cash_collected_amount,
  CASE WHEN payment_status = 'refunded' OR payment_type = 'refund' THEN abs(payment_amount) ELSE 0 END AS refund_amount
  FROM stg_payments""",
    "order_amounts": "SELECT order_id, coalesce(SUM(line_net), 0) AS order_expected_amount FROM fact_order_lines GROUP BY order_id",
    "latest_payment_status": """SELECT o.order_id, s.payment_status AS latest_payment_status FROM (SELECT DISTINCT order_id FROM fact_payments) o
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY payment_datetime DESC NULLS FIRST, payment_id DESC) AS n
    FROM fact_payments WHERE payment_status IS NOT NULL) s ON s.order_id = o.order_id AND s.n = 1""",
    "payment_aggregates": """SELECT f.order_id, SUM(cash_collected_amount) AS total_cash_collected_amount, SUM(refund_amount) AS total_refund_amount,
  SUM(points_used) AS points_used, COUNT(payment_id) AS payment_event_count,
  CAST(SUM(CASE WHEN is_installment_payment THEN 1 ELSE 0 END) AS BIGINT) AS installment_event_count,
  bool_or(is_successful_payment) AS has_successful_payment, bool_or(is_pending) AS has_pending_payment,
  any_value(l.latest_payment_status) AS latest_payment_status
  FROM fact_payments f JOIN latest_payment_status l ON f.order_id = l.order_id GROUP BY f.order_id""",
    "joined_orders": """SELECT o.*, c.segment AS customer_segment, c.customer_id IS NOT NULL AS has_customer,
  coalesce(a.order_expected_amount, 0) AS order_expected_amount,
  coalesce(p.total_cash_collected_amount, 0) AS total_cash_collected_amount, coalesce(p.total_refund_amount, 0) AS total_refund_amount,
  coalesce(p.total_cash_collected_amount, 0) - coalesce(p.total_refund_amount, 0) AS net_collected_amount,
  coalesce(p.points_used, 0) AS points_used, coalesce(p.payment_event_count, 0) AS payment_event_count,
  coalesce(p.installment_event_count, 0) AS installment_event_count, p.latest_payment_status,
  coalesce(p.has_successful_payment, FALSE) AS has_successful_payment, coalesce(p.has_pending_payment, FALSE) AS has_pending_payment
  FROM stg_orders_master o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
  LEFT JOIN order_amounts a ON o.order_id = a.order_id LEFT JOIN payment_aggregates p ON o.order_id = p.order_id""",
    "fact_orders": """SELECT order_id, customer_id, order_date, order_status, sales_channel, currency, customer_segment,
  order_expected_amount, total_cash_collected_amount, total_refund_amount, net_collected_amount,
  points_used, payment_event_count, installment_event_count, latest_payment_status,
  has_customer, payment_event_count > 0 AS has_any_payment, has_successful_payment, has_pending_payment,
  total_refund_amount > 0 AS has_refund,
  net_collected_amount >= order_expected_amount AND order_expected_amount > 0 AS is_fully_paid,
  net_collected_amount > 0 AND net_collected_amount < order_expected_amount AS is_partially_paid,
  net_collected_amount > order_expected_amount AND order_expected_amount > 0 AS is_overpaid,
  coalesce(order_status = 'paid', FALSE) AND has_successful_payment AND net_collected_amount > 0 AS is_valid_revenue
  FROM joined_orders""",
    "tier_lookup": """SELECT o.order_id, o.order_expected_amount, coalesce(arg_max(t.points_awarded, t.min_amount), 0) AS points_delta
  FROM fact_orders o LEFT JOIN stg_points_thresholds t ON t.min_amount <= o.order_expected_amount
    AND (t.max_amount IS NULL OR o.order_expected_amount <= t.max_amount)
  GROUP BY o.order_id, o.order_expected_amount""",
    "ledger_computed_earn": """SELECT c.card_id, o.order_id, o.order_date AS event_datetime, 'earn' AS event_type, t.points_delta,
  'computed_threshold' AS ledger_source, c.customer_id, c.card_status
  FROM fact_orders o JOIN stg_customer_cards c ON o.customer_id = c.customer_id AND c.card_status = 'active'
  JOIN tier_lookup t ON t.order_id = o.order_id
  WHERE o.is_valid_revenue AND t.points_delta > 0 AND NOT EXISTS (
    SELECT 1 FROM stg_card_points_ledger l WHERE l.event_type = 'earn' AND l.order_id = o.order_id AND l.card_id = c.card_id)""",
    "fact_card_points_ledger": """SELECT e.ledger_id, e.card_id, e.order_id, e.event_datetime, e.event_type, e.points_delta, e.ledger_source,
  c.customer_id, c.card_status, c.customer_id IS NOT NULL AS is_valid_card
  FROM (SELECT ledger_id, card_id, order_id, event_datetime, event_type, points_delta, 'raw' AS ledger_source FROM stg_card_points_ledger
    UNION ALL SELECT NULL, card_id, order_id, event_datetime, event_type, points_delta, ledger_source FROM ledger_computed_earn) e
  LEFT JOIN stg_customer_cards c ON e.card_id = c.card_id""",
    "valid_orders": "SELECT * FROM fact_orders WHERE is_valid_revenue",
    "card_balance": "SELECT card_id, SUM(points_delta) AS points_balance FROM fact_card_points_ledger GROUP BY card_id",
    "card_payments": """SELECT p.payment_id, p.card_id, c.card_id IS NOT NULL AS known, c.customer_id AS owner, c.card_status, o.customer_id AS buyer
  FROM stg_payments p LEFT JOIN stg_customer_cards c ON p.card_id = c.card_id
  LEFT JOIN stg_orders_master o ON p.order_id = o.order_id WHERE p.card_id <> ''""",
}

# name -> (severity, count expression as SQL, description), in report order.
# Names, severities and descriptions are output of the report.
CHECKS: dict[str, tuple[str, str, str]] = {
    "duplicate_orders": ("warning", f"SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM orders_master_raw WHERE {ident('order_id')} IS NOT NULL GROUP BY {ident('order_id')} HAVING COUNT(*) > 1)",
        "Rows in orders_master with a duplicated order_id (before dedup)."),
    "duplicate_payment_ids": ("warning", f"SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM payments_raw WHERE {ident('payment_id')} IS NOT NULL GROUP BY {ident('payment_id')} HAVING COUNT(*) > 1)",
        "Rows in payments with a duplicated payment_id (before dedup)."),
    "orders_without_customer": ("warning", "SELECT COUNT(*) FROM stg_orders_master o WHERE NOT EXISTS (SELECT 1 FROM stg_customers c WHERE c.customer_id = o.customer_id)",
        "Orders whose customer_id does not exist in the customers table."),
    "order_details_without_order": ("error", "SELECT COUNT(*) FROM stg_order_details d WHERE NOT EXISTS (SELECT 1 FROM stg_orders_master o WHERE o.order_id = d.order_id)",
        "Order detail lines whose order_id does not exist in orders_master."),
    "order_lines_with_invalid_product": ("warning", "SELECT COUNT(*) FROM stg_order_details d WHERE NOT EXISTS (SELECT 1 FROM stg_products p WHERE p.product_id = d.product_id)",
        "Order lines referencing a product_id not found in the products table."),
    "payments_without_order": ("error", "SELECT COUNT(*) FROM stg_payments p WHERE NOT EXISTS (SELECT 1 FROM stg_orders_master o WHERE o.order_id = p.order_id)",
        "Payments whose order_id does not exist in orders_master."),
    "payments_with_invalid_card": ("warning", "SELECT COUNT(*) FROM card_payments WHERE NOT known",
        "Payments referencing a card_id not present in customer_cards."),
    "payments_with_card_not_owned_by_customer": ("error", "SELECT COUNT(*) FROM card_payments WHERE owner IS NOT NULL AND owner IS DISTINCT FROM buyer",
        "Payments where the card registered owner differs from the order customer."),
    "payments_using_inactive_or_blocked_card": ("warning", "SELECT COUNT(*) FROM card_payments WHERE card_status IN ('inactive', 'blocked')",
        "Payments made with a card whose status is inactive or blocked."),
    "orders_without_payment": ("info", "SELECT COUNT(*) FROM stg_orders_master o WHERE NOT EXISTS (SELECT 1 FROM stg_payments p WHERE p.order_id = o.order_id)",
        "Orders that have no associated payment record."),
    "cancelled_orders_with_successful_payment": ("warning", "SELECT COUNT(*) FROM fact_orders WHERE order_status = 'cancelled' AND has_successful_payment",
        "Orders marked cancelled that still have at least one successful payment."),
    "paid_orders_without_successful_payment": ("error", "SELECT COUNT(*) FROM fact_orders WHERE order_status = 'paid' AND NOT has_successful_payment",
        "Orders marked paid but lacking any successful payment event."),
    "orders_with_negative_expected_amount": ("error", "SELECT COUNT(*) FROM fact_orders WHERE order_expected_amount < 0",
        "Orders whose sum of line_net amounts is negative."),
    "orders_overpaid": ("info", "SELECT COUNT(*) FROM fact_orders WHERE is_overpaid",
        "Orders where net_collected_amount exceeds the order_expected_amount."),
    "points_used_without_card": ("warning", "SELECT COUNT(*) FROM fact_payments WHERE is_points_payment AND points_used > 0 AND card_id = ''",
        "Point-redemption payments where no card_id is recorded."),
    "points_ledger_invalid_card": ("error", "SELECT COUNT(*) FROM stg_card_points_ledger l WHERE NOT EXISTS (SELECT 1 FROM stg_customer_cards c WHERE c.card_id = l.card_id)",
        "Points ledger entries referencing a card_id not present in customer_cards."),
    "negative_points_balance": ("error", "SELECT COUNT(*) FROM (SELECT card_id FROM stg_card_points_ledger GROUP BY card_id HAVING SUM(points_delta) < 0)",
        "Cards whose cumulative points balance is negative."),
}


def check_row(name: str) -> str:
    severity, count, description = CHECKS[name]
    return (
        f"SELECT '{name}' AS check_name, '{severity}' AS severity, "
        f"CAST(coalesce(({count}), 0) AS BIGINT) AS failed_count, '{description}' AS description"
    )


CTES["data_quality_report"] = "\nUNION ALL ".join(check_row(name) for name in CHECKS)

ACTIVE = "card_status = 'active'"
NET = "(SELECT SUM(net_collected_amount) FROM valid_orders)"
KPIS: dict[str, str] = {
    "total_orders": "SELECT COUNT(*) FROM fact_orders",
    "valid_revenue_orders": "SELECT COUNT(*) FROM valid_orders",
    "conversion_rate": "SELECT ROUND(CAST((SELECT COUNT(*) FROM valid_orders) AS DOUBLE) / COUNT(*), 6) FROM fact_orders",
    "total_expected_revenue": "SELECT ROUND(SUM(order_expected_amount), 2) FROM valid_orders",
    "total_cash_collected": "SELECT ROUND(SUM(total_cash_collected_amount), 2) FROM valid_orders",
    "total_refunds": "SELECT ROUND(SUM(total_refund_amount), 2) FROM valid_orders",
    "net_collected_revenue": "SELECT ROUND(SUM(net_collected_amount), 2) FROM valid_orders",
    "avg_order_value": "SELECT ROUND(CAST(SUM(net_collected_amount) AS DOUBLE) / COUNT(*), 2) FROM valid_orders",
    "partial_payment_orders": "SELECT COUNT(*) FROM fact_orders WHERE is_partially_paid",
    "overpaid_orders": "SELECT COUNT(*) FROM fact_orders WHERE is_overpaid",
    "cancelled_orders_with_payment": "SELECT COUNT(*) FROM fact_orders WHERE order_status = 'cancelled' AND has_any_payment",
    "active_cards": f"SELECT COUNT(DISTINCT card_id) FROM fact_card_points_ledger WHERE {ACTIVE}",
    "points_earned": "SELECT trunc(SUM(points_delta)) FROM fact_card_points_ledger WHERE points_delta > 0",
    "points_redeemed": "SELECT trunc(SUM(abs(points_delta))) FROM fact_card_points_ledger WHERE points_delta < 0",
    "points_liability": "SELECT trunc(SUM(points_balance)) FROM card_balance WHERE points_balance > 0",
    "orders_paid_with_points": "SELECT COUNT(*) FROM valid_orders WHERE points_used > 0",
    "loyalty_revenue_share": f"SELECT ROUND(CAST(SUM(net_collected_amount) AS DOUBLE) / CAST({NET} AS DOUBLE), 6) FROM valid_orders WHERE customer_id IN (SELECT customer_id FROM fact_card_points_ledger WHERE {ACTIVE})",
}
CTES["kpi_summary"] = "\nUNION ALL ".join(
    f"SELECT '{name}' AS kpi_name, CAST(({sql}) AS DOUBLE) AS kpi_value" for name, sql in KPIS.items()
)


def with_tables(statement: str, ctes: dict[str, str] = CTES) -> str:
    """``statement`` preceded by the tables it uses, directly or through others, in order."""
    needed: set[str] = set()
    todo = [statement]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & ctes.keys() - needed:
            needed.add(name)
            todo.append(ctes[name])
    tables = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items() if name in needed)
    return f"WITH {tables}\n{statement}" if tables else statement


def columns_of(money_columns: str, other: str, table: str) -> str:
    """Select ``other`` columns as they are and ``money_columns`` as doubles."""
    parts = [c.strip() for c in other.split(",") if c.strip()]
    parts += [f"{money(c.strip())} AS {c.strip()}" for c in money_columns.split(",") if c.strip()]
    return f"SELECT {', '.join(parts)} FROM {table}"


ORDER_MONEY = "order_expected_amount, total_cash_collected_amount, total_refund_amount, net_collected_amount, points_used"
LEDGER_KEYS = "card_id, order_id, event_datetime, event_type, ledger_source, customer_id, card_status"
PRODUCT_KEYS = "product_id, product_name, category, is_active"
CUSTOMER_KEYS = "customer_id, customer_name, segment, country, signup_date, email"

STATEMENTS: dict[str, str] = {
    "raw_scan": f"SELECT {', '.join(f'{cell(c)} AS {c}' for c in ('order_id', 'customer_id', 'order_date', 'order_status', 'sales_channel', 'currency'))} FROM orders_master_raw",
    "norm_numeric": f"""SELECT {ident('order_id')} AS order_id, {money(number('quantity', 'DECIMAL(12,3)'))} AS quantity,
  {money(number('discount_pct', 'DECIMAL(9,4)'))} AS discount_pct FROM order_details_raw""",
    "norm_datetime": f"SELECT {cell('order_id')} AS order_id, {moment('order_date')} AS order_date FROM orders_master_raw",
    "norm_lower": f"SELECT _ingest_seq, {lower('order_status')} AS order_status, {lower('sales_channel')} AS sales_channel FROM orders_master_raw",
    "norm_upper": f"SELECT _ingest_seq, {upper('card_id')} AS card_id FROM payments_raw",
    "norm_title": f"SELECT _ingest_seq, {title('country')} AS country FROM customers_raw UNION ALL SELECT _ingest_seq, {title('category')} FROM products_raw",
    "norm_strip": f"SELECT _ingest_seq, {strip('customer_name')} AS customer_name FROM customers_raw",
    "norm_price": f"SELECT {cell('unit_price')} AS raw_price, {money(PRICE)} AS unit_price FROM order_details_raw",
    "norm_fill": f"""SELECT order_id, line_id, coalesce({upper('product_id')}, '') AS product_id,
  {money("coalesce(" + number('quantity', 'DECIMAL(12,3)') + ", 1)")} AS quantity,
  {money("coalesce(" + number('discount_pct', 'DECIMAL(9,4)') + ", 0)")} AS discount_pct FROM order_details_raw""",
    "dedup_latest": f"SELECT * EXCLUDE (_ingest_seq) FROM ({last_per('order_id', TYPED_ORDERS)}) WHERE order_id IS NOT NULL",
    "dedup_exact": f"""SELECT DISTINCT {', '.join(f'{cell(c)} AS {c}' for c in ('order_id', 'line_id', 'product_id', 'quantity', 'unit_price', 'discount_pct'))}
  FROM order_details_raw""",
    "stg_orders_master": "SELECT * FROM stg_orders_master",
    "stg_order_details": columns_of("quantity, unit_price, discount_pct", "order_id, line_id, product_id", "stg_order_details"),
    "stg_payments": columns_of("payment_amount, points_used", "payment_id, order_id, payment_datetime, payment_type, payment_status, card_id", "stg_payments"),
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_customer_cards": "SELECT * FROM stg_customer_cards",
    "stg_products": columns_of("standard_price", PRODUCT_KEYS, "stg_products"),
    "stg_points_thresholds": columns_of("min_amount, max_amount, points_awarded", "threshold_id", "stg_points_thresholds"),
    "stg_card_points_ledger": columns_of("points_delta", "ledger_id, card_id, order_id, event_datetime, event_type", "stg_card_points_ledger"),
    "dim_customers": f"SELECT {CUSTOMER_KEYS} FROM stg_customers",
    "dim_products": columns_of("standard_price", PRODUCT_KEYS, "stg_products"),
    "fact_order_lines": columns_of("quantity, unit_price, discount_pct, line_gross, line_net", "order_id, line_id, product_id, has_valid_product, product_category", "fact_order_lines"),
    "fact_payments": columns_of("payment_amount, points_used, cash_collected_amount, refund_amount",
        "payment_id, order_id, payment_datetime, payment_type, payment_status, card_id, is_successful_payment, is_refund, is_pending, is_failed, is_points_payment, is_installment_payment", "fact_payments"),
    "order_amounts": columns_of("order_expected_amount", "order_id", "order_amounts"),
    "payment_aggregates": columns_of("total_cash_collected_amount, total_refund_amount, points_used",
        "order_id, payment_event_count, installment_event_count, has_successful_payment, has_pending_payment, latest_payment_status", "payment_aggregates"),
    "latest_payment_status": "SELECT order_id, latest_payment_status FROM latest_payment_status",
    "fact_orders": columns_of(ORDER_MONEY, """order_id, customer_id, order_date, order_status, sales_channel, currency, customer_segment,
  payment_event_count, installment_event_count, latest_payment_status, has_customer, has_any_payment, has_successful_payment,
  has_pending_payment, has_refund, is_fully_paid, is_partially_paid, is_overpaid, is_valid_revenue""", "fact_orders"),
    "tier_lookup": columns_of("order_expected_amount, points_delta", "order_id", "tier_lookup"),
    "ledger_computed_earn": columns_of("points_delta", LEDGER_KEYS, "ledger_computed_earn"),
    "fact_card_points_ledger": columns_of("points_delta", f"ledger_id, is_valid_card, {LEDGER_KEYS}", "fact_card_points_ledger"),
    "card_balance": columns_of("points_balance", "card_id", "card_balance"),
    "revenue_by_day": f"""SELECT CAST(order_date AS DATE) AS order_date, COUNT(order_id) AS order_count,
  {money('SUM(order_expected_amount)')} AS total_expected_revenue, {money('SUM(total_cash_collected_amount)')} AS total_cash_collected,
  {money('SUM(total_refund_amount)')} AS total_refunds, {money('SUM(net_collected_amount)')} AS net_collected_revenue
  FROM valid_orders WHERE order_date IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "revenue_by_customer_segment": f"""SELECT customer_segment, COUNT(order_id) AS order_count,
  {money('SUM(order_expected_amount)')} AS total_expected_revenue, {money('SUM(net_collected_amount)')} AS net_collected_revenue,
  {money('SUM(net_collected_amount)')} / CAST(COUNT(order_id) AS DOUBLE) AS avg_order_value
  FROM valid_orders WHERE customer_segment IS NOT NULL GROUP BY 1 ORDER BY net_collected_revenue DESC""",
    "loyalty_card_summary": f"""SELECT card_id, any_value(customer_id) AS customer_id, any_value(card_status) AS card_status,
  CAST(trunc(coalesce(SUM(points_delta) FILTER (WHERE points_delta > 0), 0)) AS BIGINT) AS points_earned,
  CAST(trunc(coalesce(-SUM(points_delta) FILTER (WHERE points_delta < 0), 0)) AS BIGINT) AS points_redeemed,
  {money('SUM(points_delta)')} AS points_balance, COUNT(points_delta) AS transaction_count
  FROM fact_card_points_ledger GROUP BY card_id""",
    "kpi_summary": "SELECT kpi_name, kpi_value FROM kpi_summary",
    "data_quality_report": "SELECT * FROM data_quality_report",
    **{f"dq_{name}": check_row(name) for name in CHECKS},
    "run_summary": "\nUNION ALL ".join(
        [
            f"SELECT '{layer}' AS section, '{name}' AS name, COUNT(*) AS value FROM {source}"
            for layer, name, source in (
                ("staging", "stg_orders_master", "stg_orders_master"),
                ("staging", "stg_order_details", "stg_order_details"),
                ("staging", "stg_payments", "stg_payments"),
                ("staging", "stg_customers", "stg_customers"),
                ("staging", "stg_customer_cards", "stg_customer_cards"),
                ("staging", "stg_products", "stg_products"),
                ("staging", "stg_points_thresholds", "stg_points_thresholds"),
                ("staging", "stg_card_points_ledger", "stg_card_points_ledger"),
                ("marts", "dim_customers", "stg_customers"),
                ("marts", "dim_products", "stg_products"),
                ("marts", "fact_order_lines", "fact_order_lines"),
                ("marts", "fact_payments", "fact_payments"),
                ("marts", "fact_orders", "fact_orders"),
                ("marts", "fact_card_points_ledger", "fact_card_points_ledger"),
            )
        ]
        + [
            "SELECT 'severity', severity, COUNT(*) FROM data_quality_report GROUP BY severity",
            "SELECT 'failed_check', check_name, failed_count FROM data_quality_report WHERE failed_count > 0",
        ]
    ),
}

SPENT = "is_points_payment AND points_used > 0 AND card_id <> ''"
STATEMENTS["x_redemption_events"] = f"""SELECT payment_id, card_id, order_id, payment_datetime AS event_datetime, 'redeem' AS event_type,
  {money('-points_used')} AS points_delta, 'computed_redemption' AS ledger_source
  FROM fact_payments p WHERE {SPENT} AND is_successful_payment AND NOT EXISTS (
    SELECT 1 FROM stg_card_points_ledger l WHERE l.event_type = 'redeem' AND l.order_id = p.order_id AND l.card_id = p.card_id)"""
CTES["points_spent"] = f"""SELECT *, is_successful_payment AND NOT EXISTS (
    SELECT 1 FROM stg_card_points_ledger l WHERE l.event_type = 'redeem' AND l.order_id = p.order_id AND l.card_id = p.card_id) AS redeems
  FROM fact_payments p WHERE {SPENT}"""
CTES["points_gone"] = """SELECT payment_id, coalesce(SUM(CASE WHEN redeems THEN points_used ELSE 0 END) OVER (
    PARTITION BY card_id ORDER BY payment_datetime NULLS LAST, payment_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone
  FROM points_spent"""
STATEMENTS["x_balance_at_payment"] = f"""SELECT p.payment_id, any_value(p.card_id) AS card_id, any_value(p.order_id) AS order_id,
  any_value(p.payment_datetime) AS payment_datetime, {money('any_value(p.points_used)')} AS points_used,
  {money('coalesce(SUM(l.points_delta), 0) - any_value(g.gone)')} AS points_balance
  FROM points_spent p JOIN points_gone g ON g.payment_id = p.payment_id LEFT JOIN fact_card_points_ledger l
  ON l.card_id = p.card_id AND (p.payment_datetime IS NULL OR l.event_datetime <= p.payment_datetime) GROUP BY p.payment_id"""
STATEMENTS["x_customer_scd2"] = f"""SELECT customer_id, segment, _ingest_seq AS valid_from,
  lead(_ingest_seq) OVER (PARTITION BY customer_id ORDER BY _ingest_seq) AS valid_to,
  lead(_ingest_seq) OVER (PARTITION BY customer_id ORDER BY _ingest_seq) IS NULL AS is_current
  FROM (SELECT *, lag(segment) OVER w AS before, row_number() OVER w AS n FROM ({TYPED_CUSTOMERS}) WHERE customer_id IS NOT NULL
    WINDOW w AS (PARTITION BY customer_id ORDER BY _ingest_seq)) WHERE n = 1 OR segment IS DISTINCT FROM before"""
STATEMENTS["x_incremental_orders"] = "SELECT * FROM stg_orders_master"
STATEMENTS["x_incremental_fact_orders"] = STATEMENTS["fact_orders"]
STATEMENTS["x_incremental_ledger"] = STATEMENTS["fact_card_points_ledger"]


def long_form(report: str, keys: str, measures: str, table: str) -> str:
    """``(report, group_key, measure, value)`` rows of a report."""
    rows = [f"SELECT '{report}' AS report, {keys} AS group_key, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM ({table})" for m in measures.split()]
    return "\nUNION ALL ".join(rows)


STATEMENTS["x_incremental_reports"] = "\nUNION ALL ".join(
    (
        long_form("revenue_by_day", "CAST(order_date AS VARCHAR)",
            "order_count total_expected_revenue total_cash_collected total_refunds net_collected_revenue",
            STATEMENTS["revenue_by_day"].removesuffix(" ORDER BY 1")),
        long_form("revenue_by_customer_segment", "customer_segment",
            "order_count total_expected_revenue net_collected_revenue avg_order_value",
            STATEMENTS["revenue_by_customer_segment"].removesuffix(" ORDER BY net_collected_revenue DESC")),
        long_form("loyalty_card_summary", "concat_ws('|', card_id, customer_id, card_status)",
            "points_earned points_redeemed points_balance transaction_count", STATEMENTS["loyalty_card_summary"]),
        long_form("kpi_summary", "kpi_name", "kpi_value", STATEMENTS["kpi_summary"]),
    )
)

STATEMENTS["norm_datetime_formats"] = STATEMENTS["norm_datetime"]
STATEMENTS["points_default_tiers"] = STATEMENTS["tier_lookup"]
STATEMENTS["orders_from_files"] = STATEMENTS["stg_orders_master"]
STATEMENTS["written_fact_orders"] = STATEMENTS["fact_orders"]
STATEMENTS["tier_lookup_many"] = """WITH tiers AS (
  SELECT MIN(CAST(o_totalprice AS DECIMAL(18,4))) AS low, CASE WHEN o_custkey % 7 <> 0 THEN MAX(CAST(o_totalprice AS DECIMAL(18,4))) END AS high,
    COUNT(*) AS points FROM orders GROUP BY o_custkey
), amounts AS (
  SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,4)) + CAST(0.00005 AS DECIMAL(18,5)) * (o_orderkey % 2) AS amount FROM orders
)
SELECT o_orderkey, CAST(coalesce(points, 0) AS DOUBLE) AS points_delta
FROM amounts LEFT JOIN tiers ON low <= amount AND (high IS NULL OR amount <= high)
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY low DESC, high DESC NULLS LAST, points DESC) = 1"""
STATEMENTS["ledger_own_owner"] = f"""SELECT l.ledger_id, l.card_id, l.order_id, l.event_datetime, l.event_type, {money('l.points_delta')} AS points_delta,
  'raw' AS ledger_source, c.card_status,
  coalesce(CASE WHEN l.event_type = 'redeem' THEN TRY_CAST(regexp_extract(l.card_id, '\\d+') AS BIGINT) END, c.customer_id) AS customer_id
  FROM stg_card_points_ledger l LEFT JOIN stg_customer_cards c ON l.card_id = c.card_id"""

KINDS = {
    "id": ident,
    "datetime": moment,
    "boolean": lambda c: f"CASE WHEN {lower(c)} IN ('true', 'false') THEN 1 END",
}
NUMBERS = {
    "amount": "DECIMAL(18,4)", "quantity": "DECIMAL(12,3)", "price": "DECIMAL(14,4)", "list_price": "DECIMAL(14,4)",
    "percent": "DECIMAL(9,4)",
}
NUMBER_FORM = r"'\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*'"


def number_violations(table: str, column: str, kind: str) -> list[tuple[str, str, str, str]]:
    text = f"regexp_replace({cell(column)}, ' CHF', '', 'gi')" if kind == "price" else cell(column)
    lost, numeric = f"{text} IS NOT NULL AND TRY_CAST({text} AS {NUMBERS[kind]}) IS NULL", f"regexp_full_match({text}, {NUMBER_FORM})"
    return [
        (table, column, "unreadable", f"{lost} AND NOT {numeric}"),
        (table, column, "out_of_range", f"{lost} AND {numeric}"),
        (table, column, "rounded", f"TRY_CAST({text} AS DECIMAL(38,18)) <> TRY_CAST({text} AS {NUMBERS[kind]})"),
    ]


def unfit_id(column: str) -> str:
    wide = f"TRY_CAST({cell(column)} AS DECIMAL(38,6))"
    return (
        f"coalesce({ident(column)} IS NULL AND regexp_full_match({cell(column)}, {NUMBER_FORM}) "
        f"AND coalesce({wide} = floor({wide}), TRUE), FALSE)"
    )


# (table, required columns, column kinds, allowed values)
RULES = (
    ("customers", "customer_id", "customer_id:id signup_date:datetime", {}),
    ("customer_cards", "card_id customer_id", "customer_id:id card_created_at:datetime",
        {"card_status": "'active', 'inactive', 'blocked'"}),
    ("products", "product_id", "standard_price:list_price is_active:boolean", {}),
    ("orders_master", "order_id customer_id", "order_id:id customer_id:id order_date:datetime", {}),
    ("order_details", "order_id line_id", "order_id:id line_id:id quantity:quantity unit_price:price discount_pct:percent", {}),
    ("payments", "payment_id order_id",
        "payment_id:id order_id:id payment_datetime:datetime payment_amount:amount points_used:amount",
        {"payment_type": "'card', 'cash', 'installment', 'loyalty_card', 'points', 'refund'",
         "payment_status": "'success', 'failed', 'pending', 'refunded'"}),
    ("points_thresholds", "threshold_id min_amount points_awarded",
        "threshold_id:id min_amount:amount max_amount:amount points_awarded:amount", {}),
    ("card_points_ledger", "card_id", "order_id:id event_datetime:datetime points_delta:amount", {}),
)


def rule_counts() -> list[str]:
    violated = []
    for table, required, kinds, allowed in RULES:
        violated += [(table, c, "missing", f"{cell(c)} IS NULL") for c in required.split()]
        for column, kind in (pair.split(":") for pair in kinds.split()):
            if kind in NUMBERS:
                violated += number_violations(table, column, kind)
            elif kind == "id":
                lost, unfit = f"{cell(column)} IS NOT NULL AND {ident(column)} IS NULL", unfit_id(column)
                violated += [(table, column, "unreadable", f"{lost} AND NOT ({unfit})"), (table, column, "out_of_range", unfit)]
            else:
                violated.append((table, column, "unreadable", f"{cell(column)} IS NOT NULL AND {KINDS[kind](column)} IS NULL"))
        violated += [(table, c, "unexpected", f"{cell(c)} IS NOT NULL AND {lower(c)} NOT IN ({v})") for c, v in allowed.items()]
    return [
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, COUNT(*) AS failed_count FROM {table}_raw WHERE {condition}"
        for table, column, rule, condition in violated
    ]


# Payments and order lines with some numbers that do not fit: ids of twenty digits, amounts beyond their type.
UNFIT_SQL = {
    "payments": """SELECT _ingest_seq, CASE WHEN _ingest_seq % 97 = 3 THEN '99999999999999999999' ELSE payment_id END AS payment_id,
  CASE WHEN _ingest_seq % 89 = 4 THEN '-1e25' WHEN _ingest_seq % 89 = 5 THEN '12.5' ELSE order_id END AS order_id,
  payment_datetime, payment_type, payment_status,
  CASE WHEN _ingest_seq % 101 = 5 THEN '123456789012345.25' WHEN _ingest_seq % 101 = 6 THEN '1,5' ELSE payment_amount END AS payment_amount,
  card_id, CASE WHEN _ingest_seq % 97 = 3 THEN '1e15' ELSE points_used END AS points_used FROM {payments_raw}""",
    "order_details": """SELECT order_id, line_id, product_id, CASE WHEN line_id = '5' THEN '1234567890' ELSE quantity END AS quantity,
  CASE WHEN line_id = '6' THEN '12345678901.5 chf' ELSE unit_price END AS unit_price, discount_pct FROM {order_details_raw}""",
}
REJECTS = {
    "payments": {"payment_id": "id", "order_id": "id", "payment_amount": "amount", "points_used": "amount"},
    "order_details": {"order_id": "id", "line_id": "id", "quantity": "quantity", "unit_price": "price", "discount_pct": "percent"},
}


def rejected_cells() -> list[str]:
    found = []
    for table, kinds in REJECTS.items():
        source = UNFIT_SQL[table].format(payments_raw="payments_raw", order_details_raw="order_details_raw")
        arrival = "CAST(_ingest_seq AS VARCHAR)" if table == "payments" else "CAST(NULL AS VARCHAR)"
        for column, kind in kinds.items():
            unfit = unfit_id(column) if kind == "id" else number_violations(table, column, kind)[1][3]
            found.append(
                f"SELECT '{table}' AS table_name, {arrival} AS arrival, '{column}' AS column_name, 'out_of_range' AS rule, "
                f"{column} AS cell FROM ({source}) WHERE {unfit}"
            )
    return found


STATEMENTS["x_rejected_rows"] = "\nUNION ALL ".join(rejected_cells())
STATEMENTS["x_schema_violations"] = "\nUNION ALL ".join(rule_counts())


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(statement) for name, statement in STATEMENTS.items()}
