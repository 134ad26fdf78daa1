"""Generated calendar.

``calendar`` replaces the reference's recursive CTE with ``sequence`` +
``explode``.  The row count is the number of days in the range (7,670 for
2015..2035), independent of data volume, so it is a bounded dimension that
is safe to broadcast.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar(spark: SparkSession, start: str | date = "2015-01-01", end: str | date = "2035-12-31") -> DataFrame:
    """One row per day, inclusive, column ``FullDate``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).alias("FullDate"))


def calendar_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Calendar spanning data-derived bounds: ``bounds`` is a one-row frame
    (e.g. min/max of a date column); the years are widened to whole years."""
    start = F.make_date(F.year(F.col(lo)), F.lit(1), F.lit(1))
    end = F.make_date(F.year(F.col(hi)), F.lit(12), F.lit(31))
    return bounds.select(F.explode(F.sequence(start, end)).alias("FullDate"))


def week_of_year_us(d: Column) -> Column:
    """DATEPART(WEEK): week 1 holds 1 January, weeks start on Sunday (not ISO)."""
    jan1 = F.trunc(d, "year")
    return (F.floor((F.dayofyear(d) + F.dayofweek(jan1) - 2) / 7) + 1).cast("int")


def date_attributes(d: Column) -> dict[str, Column]:
    """The 13 attributes of gold.dim_date, keyed by yyyyMMdd."""
    return {
        "DateKey": F.date_format(d, "yyyyMMdd").cast("int"),
        "FullDate": d,
        "DayNumberOfMonth": F.dayofmonth(d),
        "DayName": F.date_format(d, "EEEE"),
        "DayOfWeekNumber": F.dayofweek(d),          # 1 = Sunday, like DATEPART(WEEKDAY)
        "DayOfYear": F.dayofyear(d),
        "WeekNumberOfYear": week_of_year_us(d),
        "MonthNumber": F.month(d),
        "MonthName": F.date_format(d, "MMMM"),
        "QuarterNumber": F.quarter(d),
        "YearNumber": F.year(d),
        "MonthYear": F.concat(F.date_format(d, "MMMM"), F.lit(" "), F.year(d).cast("string")),
        "IsWeekend": F.dayofweek(d).isin(1, 7).cast("int"),
    }


def rich_attributes(d: Column, as_of: Column, fiscal_start_month: int = 4,
                    holidays: Column | None = None) -> dict[str, Column]:
    """D-11: the staging calendar's extra attributes (ISO week, period
    bounds, fiscal calendar, relative flags against ``as_of``).  The fiscal
    start month and the holiday list are inputs; the reference defines neither."""
    fm = ((F.month(d) - fiscal_start_month + 12) % 12) + 1
    fy = F.year(d) + (F.month(d) >= fiscal_start_month).cast("int") if fiscal_start_month > 1 else F.year(d)
    fq = F.floor((fm - 1) / 3).cast("int") + 1
    hol = holidays if holidays is not None else F.lit(False)
    age = F.datediff(as_of, d)
    return {
        "WeekOfYear_ISO": F.weekofyear(d),
        "ISOYear": F.extract(F.lit("YEAROFWEEK"), d),
        "ISOWeekday": ((F.dayofweek(d) + 5) % 7) + 1,
        "MonthNameShort": F.date_format(d, "MMM"),
        "MonthYear": F.concat(F.date_format(d, "MMM"), F.lit(" "), F.year(d).cast("string")),
        "YearMonth": F.date_format(d, "yyyy-MM"),
        "YearMonthKey": F.year(d) * 100 + F.month(d),
        "QuarterName": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "YearQuarter": F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")),
        "StartOfMonth": F.trunc(d, "month"),
        "EndOfMonth": F.last_day(d),
        "StartOfQuarter": F.trunc(d, "quarter"),
        "EndOfQuarter": F.date_add(F.add_months(F.trunc(d, "quarter"), 3), -1),
        "StartOfYear": F.trunc(d, "year"),
        "EndOfYear": F.make_date(F.year(d), F.lit(12), F.lit(31)),
        "FiscalYear": fy,
        "FiscalMonthNumber": fm,
        "FiscalQuarterNumber": fq,
        "FiscalQuarterName": F.concat(F.lit("FQ"), fq.cast("string")),
        "FiscalYearQuarter": F.concat(F.lit("FY"), fy.cast("string"), F.lit("-Q"), fq.cast("string")),
        "FiscalYearMonthKey": fy * 100 + fm,
        "FiscalYearMonth": F.concat(F.lit("FY"), fy.cast("string"), F.lit("-"), F.lpad(fm.cast("string"), 2, "0")),
        "IsToday": (d == as_of).cast("int"),
        "IsCurrentMonth": ((F.year(d) == F.year(as_of)) & (F.month(d) == F.month(as_of))).cast("int"),
        "IsCurrentYear": (F.year(d) == F.year(as_of)).cast("int"),
        "IsYTD": ((F.year(d) == F.year(as_of)) & (d <= as_of)).cast("int"),
        "IsLast7Days": age.between(0, 6).cast("int"),
        "IsLast30Days": age.between(0, 29).cast("int"),
        "IsLast90Days": age.between(0, 89).cast("int"),
        "IsBusinessDay": (~F.dayofweek(d).isin(1, 7) & ~hol).cast("int"),
        "IsUKBankHoliday": hol.cast("int"),
    }


# Fixed values of the derived staging calendar: New Year's Day and Christmas
# Day are the holidays it marks; 'as of' for relative flags is the last day
# of the TPC-H-like order dates' final year.
STAGING_AS_OF = "2001-12-31"
STAGING_DATE_COLUMNS = [
    "Date", "DateKey", "Year", "Quarter", "Month", "MonthName", "Day", "DayOfWeek", "DayName", "IsWeekend",
    "WeekOfYear_ISO", "ISOYear", "ISOWeekday", "MonthNameShort", "MonthYear", "YearMonth", "YearMonthKey",
    "QuarterName", "YearQuarter", "StartOfMonth", "EndOfMonth", "StartOfQuarter", "EndOfQuarter", "StartOfYear",
    "EndOfYear", "FiscalYear", "FiscalMonthNumber", "FiscalQuarterNumber", "FiscalQuarterName",
    "FiscalYearQuarter", "FiscalYearMonthKey", "FiscalYearMonth", "IsToday", "IsCurrentMonth", "IsCurrentYear",
    "IsYTD", "IsLast7Days", "IsLast30Days", "IsLast90Days", "IsBusinessDay", "IsUKBankHoliday", "HolidayName",
    "IsWeekendFlag",
]


def staging_dates(orders: DataFrame) -> DataFrame:
    """Staging date file (43 text columns) for every distinct order date."""
    d = F.col("d")
    as_of = F.lit(STAGING_AS_OF).cast("date")
    hol = ((F.month(d) == 1) & (F.dayofmonth(d) == 1)) | ((F.month(d) == 12) & (F.dayofmonth(d) == 25))
    attrs = {**date_attributes(d), **rich_attributes(d, as_of, 4, hol)}
    attrs.update({
        "Date": F.date_format(d, "yyyy-MM-dd"), "Year": F.year(d), "Quarter": F.quarter(d), "Month": F.month(d),
        "Day": F.dayofmonth(d), "DayOfWeek": F.dayofweek(d),
        "HolidayName": F.when(hol & (F.month(d) == 1), F.lit("New Year's Day"))
                        .when(hol, F.lit("Christmas Day")).otherwise(F.lit("")),
        "IsWeekendFlag": F.dayofweek(d).isin(1, 7).cast("int"),
        # some keys are blank, some are the next day's
        "DateKey": F.when(F.dayofyear(d) % 97 == 5, F.lit("")).when(F.dayofyear(d) % 101 == 7, F.date_format(F.date_add(d, 1), "yyyyMMdd"))
                    .otherwise(F.date_format(d, "yyyyMMdd")),
    })
    dates = orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return dates.select(*[attrs[c].cast("string").alias(c) for c in STAGING_DATE_COLUMNS])
