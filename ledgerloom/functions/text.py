"""Text normalisation of a named column. SQL text keeps one driver call per expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.schema import NULL_TOKENS, WHITESPACE


def _stripped(name: str) -> str:
    return f"trim(BOTH '{WHITESPACE}' FROM `{name}`)"


def null_tokens(name: str) -> Column:
    """Column ``name`` as text, NULL where it spells a missing value (``''``, ``NA``, ``null``, ...)."""
    tokens = ", ".join(f"'{token}'" for token in NULL_TOKENS)
    cell = f"CAST(`{name}` AS STRING)"
    return F.expr(f"CASE WHEN {cell} NOT IN ({tokens}) THEN {cell} END").alias(name)


def strip_text(name: str) -> Column:
    """Drop leading and trailing whitespace of every kind; plain ``trim`` drops only spaces."""
    return F.expr(_stripped(name))


def lower_text(name: str) -> Column:
    return F.expr(f"lower({_stripped(name)})")


def upper_text(name: str) -> Column:
    return F.expr(f"upper({_stripped(name)})")


def title_text(name: str) -> Column:
    """Capitalise after every non-letter (``O'Neil``), where ``initcap`` looks at spaces only."""
    runs = rf"regexp_extract_all(lower({_stripped(name)}), r'(\p{{L}}+|\P{{L}}+)', 1)"
    return F.expr(f"array_join(transform({runs}, run -> concat(upper(left(run, 1)), substr(run, 2))), '')")


def boolean_value(name: str) -> Column:
    """``true``/``false`` in any casing; anything else is NULL."""
    return F.expr(f"CASE lower({_stripped(name)}) WHEN 'true' THEN true WHEN 'false' THEN false END")
