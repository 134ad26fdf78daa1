"""DuckDB SQL for the data-quality audits (twins of hearth.plans.audits)."""

from __future__ import annotations

from hearth.functions import clean as C
from hearth.oracle import gold_sql  # noqa: F401
from hearth.oracle import sqlfn as S
from hearth.oracle.silver_sql import build
from hearth.plans.audits import (DATE_COLUMNS, DEFAULTED_COLUMNS, ENTITIES, FLAG_COLUMNS, GOLD_OF, KEY_OF, NUMBER_CHARS,
                                 TYPED_COLUMNS, UNIQUE_KEYS, YES_NO_COLUMNS)

AUDIT_SQL: dict[str, str] = {}


def _missing_any(keys):
    return " OR ".join(S.missing(k) for k in keys)


def _sil(e):
    return f"silver_{e}"


def _row_key(e, clean=False):
    return "concat_ws('|', " + ", ".join(S.b2n(k) if clean else f"coalesce(CAST({k} AS VARCHAR), '')" for k in KEY_OF[e]) + ")"


def _cells(bad: dict) -> str:
    """Union of the raw cells that break a rule; ``bad``: {entity: {column: condition}}."""
    return " UNION ALL ".join(f"SELECT '{e}' AS entity, {_row_key(e)} AS row_key, '{c}' AS column_name, {c} AS value FROM raw_{e} "
                              f"WHERE {cond}" for e, cols in bad.items() for c, cond in cols.items())


def _column_counts(bad: dict, what: str) -> str:
    return " UNION ALL ".join(f"SELECT '{e}' AS entity, '{c}' AS column_name, count(CASE WHEN {cond} THEN 1 END) AS {what}, "
                              f"count(*) AS rows FROM raw_{e}" for e, cols in bad.items() for c, cond in cols.items())


def _raws(tables) -> list[str]:
    return [f"raw_{e}" for e in tables]


def _bronze_count(e):
    return f"bronze_{e}" if e in ("policy_risk", "premium_transactions") else f"raw_{e}"


AUDIT_SQL["v_01"] = build(" UNION ALL ".join(
    f"SELECT '{e}' AS entity, (SELECT count(*) FROM raw_{e}) AS raw_rows, (SELECT count(*) FROM {_bronze_count(e)}) AS bronze_rows, "
    f"(SELECT count(*) FROM silver_{e}) AS silver_rows, (SELECT count(*) FROM reject_{e}) AS reject_rows, "
    f"(SELECT count(*) FROM {GOLD_OF[e]}) AS gold_rows" for e in ENTITIES),
    *[n for e in ENTITIES for n in (f"raw_{e}", _bronze_count(e), f"silver_{e}", f"reject_{e}", GOLD_OF[e])])
AUDIT_SQL["v_02"] = build("""SELECT entity, source_rows, silver_rows, reject_rows,
  CAST(silver_rows + reject_rows = source_rows AS INTEGER) AS balanced FROM (
  SELECT 'claim_reserves' AS entity, (SELECT count(*) FROM raw_claim_reserves) AS source_rows,
    (SELECT count(*) FROM silver_claim_reserves) AS silver_rows, (SELECT count(*) FROM reject_claim_reserves) AS reject_rows
  UNION ALL
  SELECT 'claim_payments', (SELECT count(CASE WHEN k IS NULL THEN 1 END) + count(DISTINCT k) FROM
      (SELECT NULLIF(trim(PaymentID, ' '), '') AS k FROM raw_claim_payments) r),
    (SELECT count(*) FROM silver_claim_payments), (SELECT count(*) FROM reject_claim_payments)) t""".replace(
    "CAST(silver_rows + reject_rows = source_rows AS INTEGER) AS balanced",
    "CAST(CAST(silver_rows + reject_rows = source_rows AS INTEGER) AS BIGINT) AS balanced"),
    "raw_claim_reserves", "silver_claim_reserves", "reject_claim_reserves", "raw_claim_payments",
    "silver_claim_payments", "reject_claim_payments")
AUDIT_SQL["v_03"] = build(" UNION ALL ".join(
    f"SELECT '{e}' AS entity, {_row_key(e, True)} AS row_key, count(*) AS dup_count FROM raw_{e} "
    f"WHERE NOT ({_missing_any(KEY_OF[e])}) GROUP BY 1, 2 HAVING count(*) > 1" for e in UNIQUE_KEYS), *_raws(UNIQUE_KEYS))
AUDIT_SQL["v_04"] = build(" UNION ALL ".join(
    f"SELECT '{e}' AS entity, count(CASE WHEN {_missing_any(KEY_OF[e])} THEN 1 END) AS missing_keys FROM raw_{e}"
    for e in ENTITIES), *[f"raw_{e}" for e in ENTITIES])
AUDIT_SQL["v_05"] = build(_cells({e: {c: f"{S.nonblank(c)} AND regexp_matches(trim({c}, ' '), '[^{chars}]')" for c, chars in cols.items()}
                                  for e, cols in NUMBER_CHARS.items()}), *_raws(NUMBER_CHARS))
AUDIT_SQL["v_06"] = build(_column_counts({e: {c: (f"{S.nonblank(c)} AND {c} NOT IN ('0', '1', 'Y', 'N')" if e == "date"
                                                  else S.strict_flag_invalid(c)) for c in cols}
                                          for e, cols in FLAG_COLUMNS.items()}, "invalid_rows"), *_raws(FLAG_COLUMNS))
AUDIT_SQL["v_07"] = build(_cells({e: {c: f"{S.nonblank(c)} AND upper(trim({c}, ' ')) NOT IN ('Y', 'N')" for c in cols}
                                  for e, cols in YES_NO_COLUMNS.items()}), *_raws(YES_NO_COLUMNS))
AUDIT_SQL["v_08"] = build(_cells({e: {c: f"{S.nonblank(c)} AND {S.first_date(c, (C.UK, C.ISO))} IS NULL" for c in cols}
                                  for e, cols in DATE_COLUMNS.items()}), *_raws(DATE_COLUMNS))
AUDIT_SQL["v_09"] = build(f"SELECT Date, DateKey FROM raw_date WHERE DateKey <> strftime({S.date('Date', C.ISO)}, '%Y%m%d')",
                          "raw_date")
AUDIT_SQL["v_10"] = build("SELECT ExpenseMonthStart, ExpenseCategory, Currency FROM raw_operating_expenses "
                          "WHERE trim(Currency, ' ') <> '' AND upper(trim(Currency, ' ')) <> 'GBP'", "raw_operating_expenses")
AUDIT_SQL["v_11"] = build(f"""SELECT ExpenseMonthStart, ExpenseCategory, InflationAdjustedAmount, PreviousMonthAmount, MoMVariance
FROM raw_operating_expenses WHERE abs({S.safe_dec('InflationAdjustedAmount')} - {S.safe_dec('PreviousMonthAmount')}
  - {S.safe_dec('MoMVariance')}) > 0.50""", "raw_operating_expenses")
AUDIT_SQL["v_12"] = build("""SELECT PolicyID, RiskType, CAST(RiskScore AS DOUBLE) AS RiskScore,
  CAST(AdjustedRiskScore AS DOUBLE) AS AdjustedRiskScore FROM bronze_policy_risk
WHERE abs(RiskScore + AlarmRiskAdjustment + ClaimsRiskAdjustment - AdjustedRiskScore) > 0.50""", "bronze_policy_risk")
AUDIT_SQL["v_13"] = build("""SELECT PremiumTransactionID, PolicyID, CAST(NetPremium AS DOUBLE) AS NetPremium,
  CAST(CalculatedNetPremium AS DOUBLE) AS CalculatedNetPremium, CAST(NetPremiumVariance AS DOUBLE) AS NetPremiumVariance
FROM bronze_premium_transactions WHERE abs(NetPremium - CalculatedNetPremium - NetPremiumVariance) > 0.50""",
    "bronze_premium_transactions")
AUDIT_SQL["v_14"] = build(f"""SELECT PolicyID, CoverageType, IsIncluded, IsIncludedFlag, CoverageLimit, HighExposureFlag
FROM raw_coverage WHERE ((IsIncluded = 'Y') <> (IsIncludedFlag = '1'))
  OR (({S.safe_dec('CoverageLimit')} >= 300000) <> (HighExposureFlag = '1'))""", "raw_coverage")
AUDIT_SQL["v_15"] = build("""SELECT CustomerID, ContactableFlag, IsValidEmail, IsValidPhone, MarketingOptInFlag FROM raw_customer
WHERE ContactableFlag = '1' AND MarketingOptInFlag <> '1' AND IsValidEmail <> '1' AND IsValidPhone <> '1'""", "raw_customer")
AUDIT_SQL["v_15_has_email"] = build("""SELECT CustomerID, HasEmail, Email FROM raw_customer
WHERE HasEmail = '0' AND trim(coalesce(Email, ''), ' ') <> ''""", "raw_customer")
AUDIT_SQL["v_year_month"] = build("""SELECT PremiumTransactionID, YearMonth FROM raw_premium_transactions
WHERE trim(coalesce(YearMonth, ''), ' ') <> '' AND NOT regexp_full_match(YearMonth, '[12][0-9]{3}-[01][0-9]')""",
    "raw_premium_transactions")
AUDIT_SQL["v_16"] = build("SELECT ClaimID, LossDate, ReportedDate FROM fact_claim WHERE ReportedDate < LossDate",
                          "fact_claim")
AUDIT_SQL["v_17"] = build("SELECT ClaimID, ClaimStatus FROM silver_claims WHERE ClaimStatus = 'Closed' AND ClosedDate IS NULL",
                          "silver_claims")
def _typed(e, c, kind):
    if kind == "date":
        return S.first_date(c, (C.ISO, C.UK))
    return S.safe_int(c) if kind == "int" else S.safe_dec(c, *((10, 2) if e == "policy_risk" else (18, 2)))


AUDIT_SQL["v_18"] = build(_cells({e: {c: f"{S.nonblank(c)} AND {_typed(e, c, kind)} IS NULL" for c, kind in cols.items()}
                                  for e, cols in TYPED_COLUMNS.items()}), *_raws(TYPED_COLUMNS))
AUDIT_SQL["v_19"] = build(_column_counts({e: {c: S.missing(c) for c in cols} for e, cols in DEFAULTED_COLUMNS.items()},
                                         "defaulted_rows"), *_raws(DEFAULTED_COLUMNS))
AUDIT_SQL["v_20"] = build("""SELECT *, CAST(null_LossDate AS DOUBLE) / NULLIF(CAST(claims AS DOUBLE), 0) AS null_rate_LossDate,
  CAST(null_ReportedDate AS DOUBLE) / NULLIF(CAST(claims AS DOUBLE), 0) AS null_rate_ReportedDate,
  CAST(null_ClosedDate AS DOUBLE) / NULLIF(CAST(claims AS DOUBLE), 0) AS null_rate_ClosedDate FROM
  (SELECT count(*) AS claims, count(CASE WHEN LossDate IS NULL THEN 1 END) AS null_LossDate,
     count(CASE WHEN ReportedDate IS NULL THEN 1 END) AS null_ReportedDate,
     count(CASE WHEN ClosedDate IS NULL THEN 1 END) AS null_ClosedDate FROM fact_claim) t""", "fact_claim")
AUDIT_SQL["v_21"] = build(" UNION ALL ".join(
    f"SELECT '{e}' AS entity, RejectReason, count(*) AS row_count FROM reject_{e} GROUP BY 1, 2" for e in ENTITIES),
    *[f"reject_{e}" for e in ENTITIES])


def _orph(name, fact, fk, dim, dk):
    return (f"SELECT '{name}' AS relation, count(*) AS orphans FROM {fact} f WHERE f.{fk} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dk} = f.{fk})")


AUDIT_SQL["v_22"] = build(" UNION ALL ".join([
    _orph("payments.ClaimID->claims", "silver_claim_payments", "ClaimID", "silver_claims", "ClaimID"),
    _orph("premiums.PolicyID->policy", "silver_premium_transactions", "PolicyID", "silver_policy", "PolicyID"),
    _orph("claims.PolicyID->policy", "silver_claims", "PolicyID", "silver_policy", "PolicyID"),
    _orph("policy.BrokerID->broker", "silver_policy", "BrokerID", "silver_broker", "BrokerID"),
    _orph("policy.AddressID->address", "silver_policy", "AddressID", "silver_address", "AddressID"),
    _orph("reserves.ClaimID->claims", "silver_claim_reserves", "ClaimID", "silver_claims", "ClaimID"),
    _orph("expenses.ExpenseCategory->category", "expense_typed", "ExpenseCategory", "dim_expense_category", "ExpenseCategory"),
    _orph("expenses.ExpenseMonth->date", "expense_typed", "ExpenseMonth", "dim_date", "FullDate"),
    _orph("coverage.CoverageKey->coverage", "fact_policy_coverage", "CoverageKey", "dim_coverage", "CoverageKey"),
]), "silver_claim_payments", "silver_claims", "silver_premium_transactions", "silver_policy", "silver_broker",
    "silver_address", "silver_claim_reserves", "expense_typed", "dim_expense_category", "dim_date", "fact_policy_coverage",
    "dim_coverage")
AUDIT_SQL["v_23"] = build("""SELECT
  (SELECT count(CASE WHEN PaymentAmount <= 0 THEN 1 END) FROM silver_claim_payments) AS non_positive_payments,
  (SELECT count(CASE WHEN GrossPremium <= 0 THEN 1 END) FROM silver_premium_transactions) AS non_positive_premiums,
  (SELECT count(CASE WHEN ReserveAmount <= 0 THEN 1 END) FROM silver_claim_reserves) AS non_positive_reserves,
  (SELECT count(CASE WHEN c.LossDate < p.InceptionDate THEN 1 END) FROM fact_claim c
     JOIN silver_policy p ON c.PolicyID = p.PolicyID) AS claims_before_inception,
  (SELECT count(CASE WHEN ExpiryDate < InceptionDate THEN 1 END) FROM silver_policy) AS policies_end_before_start""",
    "silver_claim_payments", "silver_premium_transactions", "silver_claim_reserves", "fact_claim", "silver_policy")
_PREFLIGHT = [*[("source", n, n) for n in ("orders", "lineitem", "customer", "supplier", "part", "nation", "region")],
              *[("bronze", e, _bronze_count(e)) for e in ENTITIES], *[("silver", e, f"silver_{e}") for e in ENTITIES]]
AUDIT_SQL["v_24"] = build(" UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{n}' AS source, count(*) AS rows, CAST(CAST(count(*) > 0 AS INTEGER) AS BIGINT) AS ok FROM {t}"
    for layer, n, t in _PREFLIGHT), *[t for layer, _, t in _PREFLIGHT if layer != "source"])
AUDIT_SQL["v_25"] = build("""SELECT PolicyID, RiskType, CAST(RiskScore AS DOUBLE) AS RiskScore,
  CAST(RiskDataCompletenessScore AS BIGINT) AS RiskDataCompletenessScore FROM bronze_policy_risk
WHERE NOT (RiskScore BETWEEN 0 AND 100) OR NOT (RiskDataCompletenessScore BETWEEN 0 AND 100)""", "bronze_policy_risk")
AUDIT_SQL["v_26"] = build(f"""SELECT measure, CAST(silver_total AS DOUBLE) AS silver_total, CAST(gold_total AS DOUBLE) AS gold_total,
  CAST(silver_total - gold_total AS DOUBLE) AS difference FROM (
  SELECT 'net_premium' AS measure, (SELECT coalesce(sum(NetPremium), 0) FROM silver_premium_transactions) AS silver_total,
    (SELECT coalesce(sum(NetPremium), 0) FROM fact_premium_transactions) AS gold_total
  UNION ALL SELECT 'claims_paid', (SELECT coalesce(sum(PaymentAmount), 0) FROM silver_claim_payments),
    (SELECT coalesce(sum(PaymentAmount), 0) FROM fact_claim_payments)
  UNION ALL SELECT 'operating_expenses', (SELECT coalesce(sum({S.safe_dec('ExpenseAmount')}), 0) FROM silver_operating_expenses),
    (SELECT coalesce(sum(ExpenseAmount), 0) FROM fact_operating_expenses)) t""",
    "silver_premium_transactions", "fact_premium_transactions", "silver_claim_payments", "fact_claim_payments",
    "silver_operating_expenses", "fact_operating_expenses")
