"""Customer segment history (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerloom.operators import require_keys, value_spans
from ledgerloom.plans.staging import typed_customers
from ledgerloom.schema import INGEST_ORDINAL


def customer_segment_history(
    raw_customers: DataFrame,
    folder: str,
    ordinal: str = INGEST_ORDINAL,
    datetime_formats: Sequence[str] = (),
) -> DataFrame:
    """Spans of equal segment per customer over all raw versions, in order of arrival.

    The bounds are arrival ordinals; of files they hold the arrival time as ``file_modification_time``, which
    :func:`arrival_times` takes out. ``folder`` holds the ordered versions between two passes.
    """
    versions = require_keys(typed_customers(raw_customers, datetime_formats), "customer_id")
    return value_spans(versions, "customer_id", ordinal, "segment", folder)


def arrival_times(history: DataFrame) -> DataFrame:
    """A history of files with times instead of ordinals as bounds; spans that arrived and ended at once stay."""
    bounds = ("valid_from", "valid_to")
    return history.withColumns({b: history[b]["file_modification_time"] for b in bounds})
