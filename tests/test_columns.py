from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import column
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom import functions as fn
from ledgerloom.functions import amount_value, datetime_value, price_value
from ledgerloom.schema import NULL_TOKENS, WHITESPACE


def test_strip_removes_every_kind_of_whitespace(spark):
    cells = [" \tPaid\n", " x　", "a b", "", None]
    assert column(spark, fn.strip_text, cells) == ["Paid", "x", "a b", "", None]
    assert column(spark, fn.lower_text, [" \tPaid\n"]) == ["paid"]
    assert column(spark, fn.upper_text, [" chf\r\n"]) == ["CHF"]


def test_whitespace_is_what_python_strips():
    assert "".join(sorted(WHITESPACE)) == "".join(chr(i) for i in range(0x10000) if chr(i).isspace())


def test_title_capitalises_after_every_non_letter(spark):
    cells = ["o'neil rhône-alpes", "SWITZERLAND", " new zealand ", "a1b", "", None]
    expected = [None if c is None else c.strip().title() for c in cells]
    assert column(spark, fn.title_text, cells) == expected


TEXT = st.text(alphabet=st.sampled_from("abzXYé'- \t\n1_.ñ"), max_size=12)


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_text_expressions_match_python(spark, cells):
    assert column(spark, fn.strip_text, cells) == [c.strip() for c in cells]
    assert column(spark, fn.lower_text, cells) == [c.strip().lower() for c in cells]
    assert column(spark, fn.title_text, cells) == [c.strip().title() for c in cells]


def test_numbers_coerce_or_become_null(spark):
    bad = ["1d", "0x10", "1,000", "bad", "", "inf", "nan", "1_0", None]
    assert column(spark, fn.amount_value, bad) == [None] * len(bad)
    good = {" 7 ": "7", "1e3": "1000", ".5": "0.5", "5.": "5", "-2.25": "-2.25", "+3": "3"}
    assert column(spark, fn.amount_value, list(good)) == [Decimal(v) for v in good.values()]


def test_ids_are_whole_numbers(spark):
    cells = ["500669.0", "12", " 12 ", "5e2", "12.5", "x7", None, "9007199254740993", "9007199254740993.0", "1e30"]
    expected = [500669, 12, 12, 500, None, None, None, 9007199254740993, 9007199254740993, None]
    assert column(spark, lambda name: fn.whole_number(name, strict=False), cells) == expected
    assert column(spark, fn.whole_number, cells[:-1]) == expected[:-1]


@pytest.mark.parametrize("cell", ["1e30", "99999999999999999999", "-9223372036854775809", "9223372036854775808.0", "1" * 50])
def test_an_id_that_does_not_fit_raises(spark, cell):
    with pytest.raises(Exception, match="an id outside bigint"):
        column(spark, fn.whole_number, [cell])


def test_price_drops_every_suffix_in_any_casing(spark):
    cells = ["2 chf", "4 CHF CHF", "10.5", " CHF", "3 EUR", "1e1 Chf", None]
    expected = [Decimal(2), Decimal(4), Decimal("10.5"), None, None, Decimal(10), None]
    assert column(spark, lambda c: fn.price_value(c, "decimal(14,4)"), cells) == expected


def test_datetimes_parse_iso_or_the_given_formats(spark):
    cells = ["2026-01-04", "2026-01-04 10:00:00", "not-a-date", None]
    expected = [datetime(2026, 1, 4), datetime(2026, 1, 4, 10), None, None]
    assert column(spark, fn.datetime_value, cells) == expected
    formats = ["dd.MM.yyyy", "yyyy/MM/dd"]
    cells = ["04.01.2026", "2026/01/05", "2026-01-06"]
    expected = [datetime(2026, 1, 4), datetime(2026, 1, 5), None]
    assert column(spark, lambda c: fn.datetime_value(c, formats), cells) == expected


def test_datetimes_ignore_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert column(spark, fn.datetime_value, ["2026-03-08 02:30:00"]) == [datetime(2026, 3, 8, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_null_tokens_are_exact(spark):
    cells = [*NULL_TOKENS, " NA", "nil", "0"]
    assert column(spark, fn.null_tokens, cells) == [None] * len(NULL_TOKENS) + [" NA", "nil", "0"]


def test_booleans(spark):
    assert column(spark, fn.boolean_value, ["True", " false ", "1", None]) == [True, False, None, None]


@pytest.mark.parametrize(("numerator", "denominator", "expected"), [(1, 4, 0.25), (1, 0, 0.0), (0, 0, 0.0)])
def test_ratio_is_zero_without_a_base(spark, numerator, denominator, expected):
    row = spark.range(1).select(fn.guarded_ratio(F.lit(numerator), F.lit(denominator)).cast("double").alias("r")).first()
    assert row.r == expected


def test_rounding_happens_in_decimal(spark):
    row = spark.range(1).select(fn.rounded_double(F.lit("601.965").cast("decimal(18,4)"), 2).alias("r")).first()
    assert row.r == 601.97


def test_formats_read_an_hour_that_the_zone_skips(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
    try:
        read = lambda c: datetime_value(c, ["dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy"]).cast("string")
        got = column(spark, read, ["29.03.2026 02:30:00", "01.02.2026", "2026-02-01", None])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2026-03-29 02:30:00", "2026-02-01 00:00:00", None, None]


@pytest.mark.parametrize(
    ("reader", "cell"),
    [
        (lambda c: amount_value(c, "decimal(12,3)"), "2000000000"),
        (amount_value, "100000000000000"),
        (amount_value, " 1e30 "),
        (lambda c: amount_value(c, "decimal(9,4)"), "-100000"),
        (lambda c: price_value(c, "decimal(14,4)"), "123456789012.5 chf"),
    ],
)
def test_a_number_outside_its_type_raises(spark, reader, cell):
    assert column(spark, reader, ["n/a", "1,000", None, "12"])[:3] == [None] * 3
    with pytest.raises(Exception, match="a number outside decimal"):
        column(spark, reader, [cell])
