"""Deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.schema import INGEST_ORDINAL


def dedup_latest(df: DataFrame, key: str, ordinal: str = INGEST_ORDINAL) -> DataFrame:
    """Last arrived row per key; the ordinal column is dropped.

    Catalyst turns the ``row_number() = 1`` filter into a group limit that runs before the
    shuffle as well, so each map task ships at most one row per key however hot the key is.
    """
    newest_first = Window.partitionBy(key).orderBy(F.col(ordinal).desc())
    return (
        df.withColumn("_arrival_rank", F.row_number().over(newest_first))
        .where("_arrival_rank = 1")
        .drop("_arrival_rank", ordinal)
    )


def dedup_exact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per distinct combination of ``columns``; copies are combined before the shuffle."""
    return df.select(*columns).distinct()
