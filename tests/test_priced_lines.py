"""Order lines are priced above the join with their product, so that the amounts do not move."""

from __future__ import annotations

from conftest import plan_text, raw_frame

from ledgerloom.plans import marts, staging


def test_lines_are_priced_above_the_product_join(spark):
    raw = {
        "order_details": raw_frame(spark, "order_details", [("1", "1", "p1", "2", "10.5", "50"), ("1", "2", "px", "1", None, None)]),
        "products": raw_frame(spark, "products", [("P1", "n", "tools", "1", "true")]),
    }
    stg, frequent = staging.build_staging(raw), staging.raw_frequent_keys(raw)
    lines = marts.fact_order_lines(stg["stg_order_details"], stg["stg_products"], frequent["product_id"])
    above, below = plan_text(lines).split("Join", 1)
    assert "line_gross" in above and "line_net" in above
    assert "line_gross" not in below and "line_net" not in below
    found = {r.line_id: (r.line_gross, r.line_net, r.product_category) for r in lines.collect()}
    assert found == {1: (21, 10.5, "Tools"), 2: (None, None, None)}
