"""DuckDB versions of the calendar attributes (see hearth.sources.calendar)."""

from __future__ import annotations

from hearth.sources.calendar import STAGING_AS_OF, STAGING_DATE_COLUMNS


def us_week(d: str) -> str:
    return f"CAST(floor((dayofyear({d}) + dayofweek(CAST(date_trunc('year', {d}) AS DATE)) + 1 - 2) / 7) + 1 AS INTEGER)"


def date_attrs_sql(d: str) -> dict[str, str]:
    return {
        "DateKey": f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)",
        "FullDate": d,
        "DayNumberOfMonth": f"day({d})",
        "DayName": f"dayname({d})",
        "DayOfWeekNumber": f"(dayofweek({d}) + 1)",
        "DayOfYear": f"dayofyear({d})",
        "WeekNumberOfYear": us_week(d),
        "MonthNumber": f"month({d})",
        "MonthName": f"monthname({d})",
        "QuarterNumber": f"quarter({d})",
        "YearNumber": f"year({d})",
        "MonthYear": f"monthname({d}) || ' ' || CAST(year({d}) AS VARCHAR)",
        "IsWeekend": f"CAST(dayofweek({d}) IN (0, 6) AS INTEGER)",
    }


def calendar_attrs_sql(d: str = "d", as_of: str = STAGING_AS_OF) -> dict[str, str]:
    """Rich calendar attributes (D-11) for a date expression ``d``."""
    a = f"DATE '{as_of}'"
    fm = f"(((month({d}) - 4 + 12) % 12) + 1)"
    fy = f"(year({d}) + CAST(month({d}) >= 4 AS INTEGER))"
    fq = f"(CAST(floor(({fm} - 1) / 3) AS INTEGER) + 1)"
    hol = f"((month({d}) = 1 AND day({d}) = 1) OR (month({d}) = 12 AND day({d}) = 25))"
    age = f"date_diff('day', {d}, {a})"
    attrs = date_attrs_sql(d)
    attrs.update({
        "Date": f"strftime({d}, '%Y-%m-%d')", "Year": f"year({d})", "Quarter": f"quarter({d})",
        "Month": f"month({d})", "Day": f"day({d})", "DayOfWeek": f"(dayofweek({d}) + 1)",
        "WeekOfYear_ISO": f"weekofyear({d})", "ISOYear": f"isoyear({d})", "ISOWeekday": f"isodow({d})",
        "MonthNameShort": f"strftime({d}, '%b')",
        "MonthYear": f"strftime({d}, '%b') || ' ' || CAST(year({d}) AS VARCHAR)",
        "YearMonth": f"strftime({d}, '%Y-%m')", "YearMonthKey": f"(year({d}) * 100 + month({d}))",
        "QuarterName": f"'Q' || CAST(quarter({d}) AS VARCHAR)",
        "YearQuarter": f"CAST(year({d}) AS VARCHAR) || '-Q' || CAST(quarter({d}) AS VARCHAR)",
        "StartOfMonth": f"CAST(date_trunc('month', {d}) AS DATE)", "EndOfMonth": f"last_day({d})",
        "StartOfQuarter": f"CAST(date_trunc('quarter', {d}) AS DATE)",
        "EndOfQuarter": f"CAST(date_trunc('quarter', {d}) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)",
        "StartOfYear": f"CAST(date_trunc('year', {d}) AS DATE)", "EndOfYear": f"make_date(year({d}), 12, 31)",
        "FiscalYear": fy, "FiscalMonthNumber": fm, "FiscalQuarterNumber": fq,
        "FiscalQuarterName": f"'FQ' || CAST({fq} AS VARCHAR)",
        "FiscalYearQuarter": f"'FY' || CAST({fy} AS VARCHAR) || '-Q' || CAST({fq} AS VARCHAR)",
        "FiscalYearMonthKey": f"({fy} * 100 + {fm})",
        "FiscalYearMonth": f"'FY' || CAST({fy} AS VARCHAR) || '-' || lpad(CAST({fm} AS VARCHAR), 2, '0')",
        "IsToday": f"CAST({d} = {a} AS INTEGER)",
        "IsCurrentMonth": f"CAST(year({d}) = year({a}) AND month({d}) = month({a}) AS INTEGER)",
        "IsCurrentYear": f"CAST(year({d}) = year({a}) AS INTEGER)",
        "IsYTD": f"CAST(year({d}) = year({a}) AND {d} <= {a} AS INTEGER)",
        "IsLast7Days": f"CAST({age} BETWEEN 0 AND 6 AS INTEGER)",
        "IsLast30Days": f"CAST({age} BETWEEN 0 AND 29 AS INTEGER)",
        "IsLast90Days": f"CAST({age} BETWEEN 0 AND 89 AS INTEGER)",
        "IsBusinessDay": f"CAST(dayofweek({d}) NOT IN (0, 6) AND NOT {hol} AS INTEGER)",
        "IsUKBankHoliday": f"CAST({hol} AS INTEGER)",
        "HolidayName": f"CASE WHEN {hol} AND month({d}) = 1 THEN 'New Year''s Day' WHEN {hol} THEN 'Christmas Day' ELSE '' END",
        "IsWeekendFlag": f"CAST(dayofweek({d}) IN (0, 6) AS INTEGER)",
    })
    return attrs


def staging_dates_sql() -> str:
    attrs = calendar_attrs_sql("d")
    attrs["DateKey"] = ("CASE WHEN dayofyear(d) % 97 = 5 THEN '' WHEN dayofyear(d) % 101 = 7 THEN strftime(d + 1, '%Y%m%d') "
                        "ELSE strftime(d, '%Y%m%d') END")
    cols = ", ".join(f"CAST({attrs[c]} AS VARCHAR) AS {c}" for c in STAGING_DATE_COLUMNS)
    return f"(SELECT {cols} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) dd)"
