"""Relational operators built from DataFrame joins, windows and aggregates."""

from ledgerloom.operators.dedup import dedup_exact, dedup_latest
from ledgerloom.operators.keys import (
    duplicate_rows,
    fk_violations,
    require_keys,
    require_parsed_keys,
    require_parsed_text,
    require_text,
)
from ledgerloom.operators.latest import latest_value
from ledgerloom.operators.ordered import running_total, value_spans
from ledgerloom.operators.skew import frequent_keys, spread_join
from ledgerloom.operators.tiers import tier_lookup, tier_lookups

__all__ = [
    "dedup_exact",
    "dedup_latest",
    "duplicate_rows",
    "fk_violations",
    "frequent_keys",
    "latest_value",
    "require_keys",
    "require_parsed_keys",
    "require_parsed_text",
    "require_text",
    "running_total",
    "spread_join",
    "tier_lookup",
    "tier_lookups",
    "value_spans",
]
