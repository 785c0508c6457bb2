"""Column expressions: every one stays inside the JVM, none is a Python UDF."""

from ledgerloom.functions.datetimes import datetime_value
from ledgerloom.functions.numbers import (
    amount_value,
    guarded_ratio,
    price_value,
    rounded_double,
    whole_number,
)
from ledgerloom.functions.text import (
    boolean_value,
    lower_text,
    null_tokens,
    strip_text,
    title_text,
    upper_text,
)

__all__ = [
    "amount_value",
    "boolean_value",
    "datetime_value",
    "guarded_ratio",
    "lower_text",
    "null_tokens",
    "price_value",
    "rounded_double",
    "strip_text",
    "title_text",
    "upper_text",
    "whole_number",
]
