"""Date and time coercion of a named column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def datetime_value(name: str, formats: Sequence[str] = ()) -> Column:
    """Zone-free timestamp of a text cell, NULL when it does not parse.

    Without ``formats`` the ISO forms are read. With ``formats`` the first one that fits wins.
    The value never passes through a time zone, so an hour that a zone skips is read as it stands.
    """
    if not formats:
        return F.expr(f"try_cast(`{name}` AS timestamp_ntz)")
    parsed = [
        F.when(F.try_to_timestamp(F.col(name), F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(F.col(name), F.lit(fmt)))
        for fmt in formats
    ]
    return F.coalesce(*parsed)
