"""Working copies of the facts hold what the rest of the plan reads."""

from __future__ import annotations

import pytest
from conftest import SMALL, plan_text

from ledgerloom_checks import registry
from ledgerloom.plans import analytics, loyalty


@pytest.mark.parametrize(
    "query, expected",
    [
        ("card_balance", [set(loyalty.EARNING_COLUMNS)]),
        ("kpi_summary", [{*loyalty.EARNING_COLUMNS, *analytics.KPI_ORDER_COLUMNS}, set(analytics.KPI_LEDGER_COLUMNS)]),
    ],
)
def test_facts_are_written_with_the_columns_that_are_read(spark, monkeypatch, query, expected):
    write, seen = registry.write_table, []

    def spied(df, path, *arguments):
        seen.append((set(df.columns), plan_text(df)))
        return write(df, path, *arguments)

    monkeypatch.setattr(registry, "write_table", spied)
    registry.QUERIES[query](spark, SMALL)
    assert [columns for columns, _ in seen] == expected
    # The status of the last payment is the one aggregate that needs sorted input.
    assert "max_by" not in seen[0][1] and "rebalance" not in seen[0][1].lower()
