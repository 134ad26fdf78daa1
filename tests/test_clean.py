"""Parsers and predicates on the dirty values listed in FIXTURES.md."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from hearth.functions import clean as C

NBSP = " "


def col_values(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_key_blank_to_null(spark):
    assert col_values(spark, [" P1 ", "", "   ", None], C.blank_to_null) == ["P1", None, None, None]
    assert col_values(spark, ["\ta "], C.trim_spaces) == ["\ta"]       # spaces only


def test_money(spark):
    got = col_values(spark, ["£1,234.50", "10.005\r", "-5", "1e5", "n/a", ""], C.money)
    assert got == [Decimal("1234.50"), Decimal("10.01"), Decimal("-5.00"), None, None, None]


def test_reserve_money_chars(spark):
    got = col_values(spark, ["$ 1,000.00", "£2,500.5"], lambda c: C.money(c, C.MONEY_CHARS_RESERVE))
    assert got == [Decimal("1000.00"), Decimal("2500.50")]


def test_safe_int_rejects_fractions_and_exponents(spark):
    assert col_values(spark, [" 12 ", "12.5", "1e3", "x"], C.safe_int) == [12, None, None, None]


def test_dates_ordered_formats(spark):
    values = ["31/01/2024", "1/2/2024", "2024-01-31", "2024/01/31", "31-01-2024", "31/02/2024", ""]
    got = col_values(spark, values, lambda c: C.first_date(c, (C.UK, C.ISO, C.YMD_SLASH, C.DMY_DASH)))
    d = dt.date
    assert got == [d(2024, 1, 31), d(2024, 2, 1), d(2024, 1, 31), d(2024, 1, 31), d(2024, 1, 31), None, None]


def test_date_text_normalisers(spark):
    iso = col_values(spark, ['"2024-01-31T10:00:00"'],
                     lambda c: C.first_date(C.date_text_iso(c), (C.UK, C.ISO, C.ISO_TIME)))
    uk = col_values(spark, [NBSP + "31/01/2024"], lambda c: C.first_date(C.date_text_prefix(c), (C.UK,)))
    assert iso == [dt.date(2024, 1, 31)] and uk == [dt.date(2024, 1, 31)]


def test_flags(spark):
    vals = ["Y", "yes", "1", "TRUE", "n", "0", "2", ""]
    assert col_values(spark, vals, C.flag01) == [1, 1, 1, 1, 0, 0, None, None]
    assert col_values(spark, vals, C.flag_yn) == ["Y", "Y", "Y", "Y", "N", "N", None, None]
    assert col_values(spark, ["0", "1", " 1", "Y"], C.strict_flag) == [0, 1, None, None]
    assert col_values(spark, ["0", "1", " 1", "Y", ""], C.strict_flag_invalid) == [False, False, True, True, False]


def test_year_month(spark):
    assert col_values(spark, ["2024-01", "2024-1", "2024-19"], C.year_month) == ["2024-01", None, "2024-19"]


def test_reasons(spark):
    df = spark.createDataFrame([("", "x"), ("k", ""), ("k", "x")], "a string, b string")
    rules = [(C.is_missing("a"), "A missing"), (C.is_missing("b"), "B missing")]
    first = [r[0] for r in df.select(C.first_reason(rules)).collect()]
    every = [r[0] for r in df.select(C.all_reasons(rules)).collect()]
    assert first == ["A missing", "B missing", None]
    assert every == ["A missing; ", "B missing; ", None]


def test_month_diff_and_composite(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31), dt.date(2024, 1, 1), None)], "a date, b date, c string")
    r = df.select(C.month_diff("a", "b"), C.composite_key("a", "c")).first()
    assert r[0] == 1 and r[1] == "2023-12-31|"
