"""Latest-value aggregate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def latest_value(value: Column, when: Column, tie_break: Column) -> Column:
    """Aggregate: the non-null ``value`` at the latest ``when``; an unknown time counts as latest."""
    recency = F.struct(when.isNull(), when, tie_break)
    return F.max_by(value, F.when(value.isNotNull(), recency))
