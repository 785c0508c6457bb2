"""Raw table layouts, decimal types and fixed values shared by every layer."""

from __future__ import annotations

# The column lists of the eight raw inputs.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id", "customer_name", "segment", "country", "signup_date", "email"),
    "customer_cards": ("card_id", "customer_id", "card_created_at", "card_status"),
    "products": ("product_id", "product_name", "category", "standard_price", "is_active"),
    "orders_master": ("order_id", "customer_id", "order_date", "order_status", "sales_channel", "currency"),
    "order_details": ("order_id", "line_id", "product_id", "quantity", "unit_price", "discount_pct"),
    "payments": (
        "payment_id", "order_id", "payment_datetime", "payment_type", "payment_status",
        "payment_amount", "card_id", "points_used",
    ),
    "points_thresholds": ("threshold_id", "min_amount", "max_amount", "points_awarded"),
    "card_points_ledger": ("ledger_id", "card_id", "order_id", "event_datetime", "event_type", "points_delta"),
}

# Columns a raw table may carry besides the required ones.
OPTIONAL_COLUMNS: dict[str, tuple[str, ...]] = {"card_points_ledger": ("customer_id",)}

# Raw cells that mean "missing", the default set of pandas.read_csv.
NULL_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The characters Python's str.strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the suffix that raw prices may carry.
CURRENCY_SUFFIX = " CHF"

# Row order of arrival; "keep last" means the highest ordinal of a key.
INGEST_ORDINAL = "_ingest_seq"

# Exact money: (12,3) x (14,4) x (10,6) is (38,13), so a line total is never rounded.
QUANTITY = "decimal(12,3)"
PRICE = "decimal(14,4)"
PERCENT = "decimal(9,4)"
DISCOUNT_RATE = "decimal(9,6)"
AMOUNT = "decimal(18,4)"
POINTS = "decimal(18,4)"

# The column lists of the facts.
FACT_COLUMNS: dict[str, tuple[str, ...]] = {
    "fact_order_lines": (
        "order_id", "line_id", "product_id", "quantity", "unit_price", "discount_pct",
        "line_gross", "line_net", "has_valid_product", "product_category",
    ),
    "fact_payments": (
        "payment_id", "order_id", "payment_datetime", "payment_type", "payment_status", "payment_amount", "card_id",
        "points_used", "is_successful_payment", "is_refund", "is_pending", "is_failed", "is_points_payment",
        "is_installment_payment", "cash_collected_amount", "refund_amount",
    ),
    "fact_orders": (
        "order_id", "customer_id", "order_date", "order_status", "sales_channel", "currency", "customer_segment",
        "order_expected_amount", "total_cash_collected_amount", "total_refund_amount", "net_collected_amount",
        "points_used", "payment_event_count", "installment_event_count", "latest_payment_status", "has_customer",
        "has_any_payment", "has_successful_payment", "has_pending_payment", "has_refund", "is_fully_paid",
        "is_partially_paid", "is_overpaid", "is_valid_revenue",
    ),
    "fact_card_points_ledger": (
        "ledger_id", "card_id", "order_id", "event_datetime", "event_type", "points_delta",
        "ledger_source", "customer_id", "card_status", "is_valid_card",
    ),
}
