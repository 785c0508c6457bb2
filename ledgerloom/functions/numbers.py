"""Number coercion of a named column, and rounding. Text that is not a number becomes NULL.

A number that does not fit its type is not unreadable: it raises, rather than be taken for missing and replaced.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.schema import AMOUNT, CURRENCY_SUFFIX

# What reads as a decimal number.
NUMBER_PATTERN = r"^\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*$"


def is_number(text: str) -> str:
    """SQL that tells whether the text expression reads as a number of any size."""
    return f"coalesce({text} RLIKE '{NUMBER_PATTERN}', false)"


def _exact(text: str, name: str, decimal_type: str, strict: bool) -> Column:
    value = f"try_cast({text} AS {decimal_type})"
    if not strict:
        return F.expr(value)
    # Only a cell that did not parse is looked at again.
    message = f"concat('{name}: a number outside {decimal_type}: ', {text})"
    return F.expr(
        f"coalesce({value}, CASE WHEN {is_number(text)} THEN CAST(raise_error({message}) AS {decimal_type}) END)"
    )


def amount_value(name: str, decimal_type: str = AMOUNT, strict: bool = True) -> Column:
    """Exact decimal of a text cell. Decimal parsing already rejects ``1d``, ``0x10``, ``inf``, ``1,000``."""
    return _exact(f"`{name}`", name, decimal_type, strict)


def _read_id(name: str) -> str:
    """Plain digits take the first branch. Cells with a point skip it, because a failing integer cast raises and
    catches an exception per row, which is far dearer than the decimal parse."""
    wide = f"try_cast(`{name}` AS decimal(38,6))"
    return (
        f"coalesce(CASE WHEN NOT contains(`{name}`, '.') THEN try_cast(`{name}` AS bigint) END, "
        f"CASE WHEN {wide} = floor({wide}) THEN try_cast(floor({wide}) AS bigint) END)"
    )


def unfit_id(name: str) -> str:
    """SQL that tells whether a text cell is a whole number that no id can hold."""
    wide = f"try_cast(`{name}` AS decimal(38,6))"
    return f"({_read_id(name)} IS NULL AND {is_number(f'`{name}`')} AND coalesce({wide} = floor({wide}), true))"


def unfit_number(text: str, decimal_type: str) -> str:
    """SQL that tells whether the text expression is a number that ``decimal_type`` cannot hold."""
    return f"(try_cast({text} AS {decimal_type}) IS NULL AND {is_number(text)})"


def whole_number(name: str, strict: bool = True) -> Column:
    """Id of a text cell: ``'12'`` and ``'12.0'`` give 12; a fractional or malformed id gives NULL."""
    read = _read_id(name)
    if not strict:
        return F.expr(read)
    message = f"concat('{name}: an id outside bigint: ', `{name}`)"
    # Only a cell that gave no id is looked at again.
    return F.expr(f"coalesce({read}, CASE WHEN {unfit_id(name)} THEN CAST(raise_error({message}) AS bigint) END)")


def price_text(name: str) -> str:
    """SQL of a price cell after removing each currency suffix, whatever its casing.

    Upper-casing first makes this a literal replacement; casing never matters to a number.
    """
    return f"replace(upper(`{name}`), '{CURRENCY_SUFFIX}', '')"


def price_value(name: str, decimal_type: str, strict: bool = True) -> Column:
    """Price of a text cell that may carry currency suffixes."""
    return _exact(price_text(name), name, decimal_type, strict)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Zero when the denominator is not positive; ANSI division by zero would raise."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0))


def rounded_double(col: Column, scale: int) -> Column:
    """Round in decimal, then present as double: the order decides the last digit."""
    return F.round(col, scale).cast("double")
