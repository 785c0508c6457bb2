"""Lines meet by order and line number: an order's amounts are summed where its copies are found."""

from __future__ import annotations

import re
from collections import Counter

from conftest import SMALL, plan_text, raw_frame

from ledgerloom_checks import registry
from ledgerloom.plans import marts, staging


def test_amounts_are_summed_before_they_move(spark):
    text = plan_text(registry.order_amounts(spark, SMALL))
    exchanges = [re.sub(r"#\w+", "", keys) for keys in re.findall(r"Exchange hashpartitioning\(([^)]*), 8\)", text)]
    # Read from the last step to the first.
    assert exchanges == ["order_id", "order_id, _lines"]


def test_copies_meet_whatever_their_line_number(spark):
    numbers = [-5000, -1024, -1, 0, 1, 1023, 1024, 1025, 999999999999, 9223372036854775807, -9223372036854775808]
    rows = [("7", str(n), "p1", "2", "1.50", "0") for n in numbers] * 3
    rows += [("7", "1.0", "P1 ", "2.0", "1.5 CHF", None), ("7", "1", "p1", "3", "1.50", "0"), (None, "1", "p1", "2", "1.50", "0")]
    lines = staging.stg_order_details(raw_frame(spark, "order_details", rows))
    assert lines.columns == ["order_id", "line_id", "product_id", "quantity", "unit_price", "discount_pct"]
    assert Counter(r.line_id for r in lines.collect()) == Counter([*numbers, 1])
    (amount,) = marts.order_amounts(marts.price_lines(lines)).collect()
    assert amount.order_expected_amount == len(numbers) * 3 + 4.5
