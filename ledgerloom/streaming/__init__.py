"""Incremental processing with Structured Streaming."""

from ledgerloom.streaming.facts import (
    current_fact,
    current_fact_orders,
    rebuild_fact_orders,
    refresh,
    restrict_to_orders,
)
from ledgerloom.streaming.incremental import changed_keys, compact, ingest_new_files
from ledgerloom.streaming.reports import current_reports
from ledgerloom.streaming.stored import current_table

__all__ = [
    "changed_keys",
    "compact",
    "current_fact",
    "current_fact_orders",
    "current_reports",
    "current_table",
    "ingest_new_files",
    "rebuild_fact_orders",
    "refresh",
    "restrict_to_orders",
]
