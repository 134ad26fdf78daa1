"""DuckDB SQL for the gold layer (twins of hearth.plans.gold)."""

from __future__ import annotations

from hearth.functions import clean as C
from hearth.oracle import sqlfn as S
from hearth.oracle.calendar_sql import date_attrs_sql
from hearth.oracle.silver_sql import build, cte

NORM_COVER = "coalesce(upper(NULLIF(trim({x}, ' '), '')), 'UNKNOWN')"

cte("dim_address", """SELECT CAST(row_number() OVER (ORDER BY AddressID) AS INTEGER) AS AddressKey,
  * EXCLUDE (PostcodeArea, CustomerID) FROM silver_address
UNION ALL BY NAME SELECT -1 AS AddressKey, 'UNKNOWN' AS AddressID""", "silver_address")
cte("dim_broker", """SELECT CAST(row_number() OVER (ORDER BY BrokerID) AS INTEGER) AS BrokerKey, * FROM silver_broker
UNION ALL BY NAME SELECT -1 AS BrokerKey, 'UNKNOWN' AS BrokerID""", "silver_broker")
cte("dim_coverage", f"""SELECT CAST(row_number() OVER (ORDER BY CoverageType) AS INTEGER) AS CoverageKey, CoverageType
FROM (SELECT DISTINCT {NORM_COVER.format(x='CoverageType')} AS CoverageType FROM silver_coverage) t
WHERE CoverageType <> 'UNKNOWN'
UNION ALL SELECT -1, 'UNKNOWN'""", "silver_coverage")
cte("dim_customers", """SELECT CAST(row_number() OVER (ORDER BY CustomerID) AS INTEGER) AS CustomerKey, *
FROM silver_customer""", "silver_customer")
_attrs = date_attrs_sql("FullDate")
cte("dim_date", f"""SELECT {', '.join(f'{v} AS {k}' for k, v in _attrs.items() if k != 'FullDate')}, FullDate
FROM (SELECT CAST(unnest(generate_series(make_date(year(lo), 1, 1), make_date(year(hi), 12, 31), INTERVAL 1 DAY)) AS DATE)
      AS FullDate FROM (SELECT min(CAST(Date AS DATE)) AS lo, max(CAST(Date AS DATE)) + 365 AS hi FROM silver_date) b) c""", "silver_date")
cte("fixed_calendar", f"""SELECT {', '.join(f'{v} AS {k}' for k, v in _attrs.items() if k != 'FullDate')}, FullDate
FROM (SELECT CAST(unnest(generate_series(DATE '2015-01-01', DATE '2035-12-31', INTERVAL 1 DAY)) AS DATE) AS FullDate) c""")
cte("dim_expense_category", f"""SELECT CAST(row_number() OVER (ORDER BY ExpenseCategory) AS INTEGER) AS ExpenseCategoryKey, *
FROM (SELECT * FROM (SELECT trim(ExpenseCategory, ' ') AS ExpenseCategory,
        {S.strict_flag('ImpactsExpenseRatioFlag')} AS ImpactsExpenseRatioFlag, ExpenseType, CostCentre
      FROM silver_operating_expenses) s
      QUALIFY row_number() OVER (PARTITION BY ExpenseCategory
        ORDER BY ImpactsExpenseRatioFlag DESC NULLS LAST, ExpenseType DESC NULLS LAST, CostCentre DESC NULLS LAST) = 1) t""",
    "silver_operating_expenses")
cte("dim_policy", "SELECT * FROM silver_policy", "silver_policy")
cte("dim_policy_risk", "SELECT * FROM silver_policy_risk", "silver_policy_risk")
for _col, _key in (("ClaimType", "ClaimTypeKey"), ("ClaimStatus", "ClaimStatusKey")):
    cte(f"dim_{'claim_type' if _col == 'ClaimType' else 'claim_status'}",
        f"""SELECT CAST(row_number() OVER (ORDER BY {_col}) AS INTEGER) AS {_key}, {_col}
FROM (SELECT DISTINCT {S.b2n(_col)} AS {_col} FROM silver_claims) t WHERE {_col} IS NOT NULL
UNION ALL SELECT -1, 'UNKNOWN'""", "silver_claims")

_CLAIM_FMTS = (C.UK, C.ISO, C.ISO_TIME)
_dates = ", ".join(f"{S.first_date(S.date_text_iso(c), _CLAIM_FMTS)} AS {c}" for c in ("LossDate", "ReportedDate", "ClosedDate"))
cte("fact_claim", f"""SELECT ClaimID, PolicyID, {_dates}, ClaimType, Severity, ClaimStatus, ClaimComplexity,
  {S.safe_int('ReportingDelayDays')} AS ReportingDelayDays, {S.safe_int('ClaimDurationDays')} AS ClaimDurationDays,
  {S.strict_flag('ReopenedFlag')} AS ReopenedFlag, {S.strict_flag('FraudFlag')} AS FraudFlag,
  {S.strict_flag('CatEventFlag')} AS CatEventFlag FROM silver_claims""", "silver_claims")
cte("fact_claim_payments", "SELECT * FROM silver_claim_payments", "silver_claim_payments")
cte("fact_claim_reserves", "SELECT * FROM silver_claim_reserves", "silver_claim_reserves")
cte("fact_premium_transactions", "SELECT * FROM silver_premium_transactions", "silver_premium_transactions")
cte("expense_typed", f"""SELECT {S.first_date('ExpenseMonthStart', (C.ISO, C.UK))} AS ExpenseMonth,
        trim(ExpenseCategory, ' ') AS ExpenseCategory, {S.safe_dec('ExpenseAmount')} AS ExpenseAmount,
        {S.safe_dec('InflationAdjustedAmount')} AS InflationAdjustedAmount,
        {S.safe_dec('PreviousMonthAmount')} AS PreviousMonthAmount, {S.safe_dec('MoMVariance')} AS MoMVariance, Currency
      FROM silver_operating_expenses""", "silver_operating_expenses")
cte("fact_operating_expenses", """SELECT CAST(row_number() OVER (ORDER BY ExpenseMonth, e.ExpenseCategory, ExpenseAmount,
    InflationAdjustedAmount, PreviousMonthAmount NULLS FIRST, MoMVariance NULLS FIRST, Currency) AS BIGINT)
    AS OperatingExpenseKey, e.*, c.ExpenseCategoryKey, c.ImpactsExpenseRatioFlag, d.DateKey
FROM expense_typed e
JOIN dim_expense_category c ON trim(e.ExpenseCategory, ' ') = trim(c.ExpenseCategory, ' ')
LEFT JOIN dim_date d ON e.ExpenseMonth = d.FullDate""", "expense_typed", "dim_expense_category", "dim_date")
cte("fact_policy_coverage", f"""SELECT CAST(row_number() OVER (ORDER BY s.PolicyID, s.CoverageType) AS INTEGER)
    AS PolicyCoverageKey, s.*, coalesce(d.CoverageKey, -1) AS CoverageKey
FROM silver_coverage s LEFT JOIN dim_coverage d ON {NORM_COVER.format(x='s.CoverageType')} = d.CoverageType""",
    "silver_coverage", "dim_coverage")

GOLD_PRESENT = {
    "dim_address": (["RebuildCostEstimate"], ["AddressKey", "BuildYear", "Bedrooms", "HouseSizeSqFt"]),
    "dim_broker": (["CommissionRate", "EstimatedAnnualGWP_GBP"], ["BrokerKey", "AppointmentYear", "RelationshipTenureYears"]),
    "dim_coverage": ([], ["CoverageKey"]),
    "dim_customers": ([], ["CustomerKey"]),
    "dim_date": ([], ["DateKey", "DayNumberOfMonth", "DayOfWeekNumber", "DayOfYear", "WeekNumberOfYear", "MonthNumber",
                      "QuarterNumber", "YearNumber", "IsWeekend"]),
    "dim_expense_category": ([], ["ExpenseCategoryKey", "ImpactsExpenseRatioFlag"]),
    "dim_claim_type": ([], ["ClaimTypeKey"]),
    "dim_claim_status": ([], ["ClaimStatusKey"]),
    "fact_claim": ([], ["ReportingDelayDays", "ClaimDurationDays", "ReopenedFlag", "FraudFlag", "CatEventFlag"]),
    "fact_operating_expenses": (["ExpenseAmount", "InflationAdjustedAmount", "PreviousMonthAmount", "MoMVariance"],
                                ["OperatingExpenseKey", "ExpenseCategoryKey", "ImpactsExpenseRatioFlag", "DateKey"]),
    "fact_policy_coverage": (["CoverageLimit", "Excess"], ["PolicyCoverageKey", "IsIncludedFlag", "HighExposureFlag",
                                                          "CoverageKey"]),
}


def gold_query(name: str) -> str:
    from hearth.oracle.silver_sql import PRESENT
    if name in GOLD_PRESENT or name == "fixed_calendar":
        doubles, bigints = GOLD_PRESENT["dim_date" if name == "fixed_calendar" else name]
    else:
        src = {"dim_policy": "policy", "dim_policy_risk": "policy_risk", "fact_claim_payments": "claim_payments",
               "fact_claim_reserves": "claim_reserves", "fact_premium_transactions": "premium_transactions"}[name]
        doubles, bigints = PRESENT.get(src, ((), ()))
    return build(S.present(name, doubles, bigints), name)


def rich_calendar_sql() -> str:
    """D-11 twin: generated calendar with the staging file's richer attributes."""
    from hearth.oracle.calendar_sql import calendar_attrs_sql
    from hearth.sources.calendar import STAGING_DATE_COLUMNS
    attrs = calendar_attrs_sql("FullDate", "2001-12-31")
    rich = ["WeekOfYear_ISO", "ISOYear", "ISOWeekday", "MonthNameShort", "MonthYear", "YearMonth", "YearMonthKey",
            "QuarterName", "YearQuarter", "StartOfMonth", "EndOfMonth", "StartOfQuarter", "EndOfQuarter",
            "StartOfYear", "EndOfYear", "FiscalYear", "FiscalMonthNumber", "FiscalQuarterNumber", "FiscalQuarterName",
            "FiscalYearQuarter", "FiscalYearMonthKey", "FiscalYearMonth", "IsToday", "IsCurrentMonth",
            "IsCurrentYear", "IsYTD", "IsLast7Days", "IsLast30Days", "IsLast90Days", "IsBusinessDay",
            "IsUKBankHoliday", "HolidayName"]
    base = ["MonthName", "DayName", "IsWeekend"]
    names = ["DateKey", "FullDate"] + [c for c in STAGING_DATE_COLUMNS if c in set(rich) | set(base)]
    text = {"MonthName", "DayName", "MonthNameShort", "MonthYear", "YearMonth", "QuarterName", "YearQuarter",
            "FiscalQuarterName", "FiscalYearQuarter", "FiscalYearMonth", "HolidayName"}
    dates = {"FullDate", "StartOfMonth", "EndOfMonth", "StartOfQuarter", "EndOfQuarter", "StartOfYear", "EndOfYear"}

    def typed(n):
        e = attrs[n]
        return e if n in text or n in dates else f"CAST({e} AS BIGINT)"
    cols = ", ".join(f"{typed(n)} AS {n}" for n in names)
    return build(f"SELECT {cols} FROM (SELECT FullDate FROM dim_date) c", "dim_date")
