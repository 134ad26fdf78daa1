"""DuckDB SQL for the raw, bronze and silver layers (twins of hearth.plans.*).

``CTES`` maps a name to ``(sql, deps)``; ``build(body, *names)`` emits a
``WITH`` clause holding the named CTEs and everything they depend on, in
dependency order.
"""

from __future__ import annotations

from hearth.oracle import sqlfn as S
from hearth.functions import clean as C
from hearth.sources import testviews as tv

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


def build(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return S.with_ctes({n: CTES[n][0] for n in order}, body)


def raw_cols(entity: str) -> list[str]:
    if entity == "claim_reserves":
        entity = "claim_reserves_1"
    if entity == "date":
        from hearth.sources.calendar import STAGING_DATE_COLUMNS
        return list(STAGING_DATE_COLUMNS)
    return [c for c, _ in tv.VIEWS[entity].cols]


for _e in list(tv.RAW_ENTITIES) + ["date"]:
    cte(f"raw_{_e}", f"SELECT * FROM {tv.raw_sql(_e)} r")


def _latest(src: str, keys: list[str], order: list[str]) -> str:
    where = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (f"SELECT * FROM {src} WHERE {where} QUALIFY row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {S.desc_all(order)}) = 1")


def _keyed(src: str, keys: list[str]) -> str:
    rep = ", ".join(f"{S.b2n(k)} AS {k}" for k in keys)
    return f"SELECT * REPLACE ({rep}) FROM {src}"


def _missing(keys: list[str]) -> str:
    return "(" + " OR ".join(f"{k} IS NULL" for k in keys) + ")"


# --- S-03 claim_payments -----------------------------------------------------
_cp = raw_cols("claim_payments")
cte("cp_keyed", _keyed("raw_claim_payments", ["PaymentID"]), "raw_claim_payments")
cte("cp_latest", _latest("cp_keyed", ["PaymentID"], [c for c in _cp if c != "PaymentID"]), "cp_keyed")


def _bad_num(c: str) -> str:
    return f"({S.nonblank(c)} AND {S.safe_dec(c)} IS NULL)"


_CP_RULES = [
    (S.missing("ClaimID"), "Missing ClaimID"),
    (f"({S.nonblank('PaymentDate')} AND {S.date('PaymentDate')} IS NULL)", "Invalid PaymentDate (expected UK dd/mm/yyyy)"),
    (_bad_num("PaymentAmount"), "Invalid PaymentAmount (not numeric)"),
    (_bad_num("OutstandingReserve"), "Invalid OutstandingReserve (not numeric)"),
    (_bad_num("IncurredAmount"), "Invalid IncurredAmount (not numeric)"),
    (S.strict_flag_invalid("LargeLossFlag"), "Invalid LargeLossFlag (expected 0/1)"),
]
cte("cp_cls", f"SELECT *, {S.first_reason(_CP_RULES)} AS RejectReason FROM cp_latest", "cp_latest")
cte("silver_claim_payments", f"""SELECT PaymentID, {S.b2n('ClaimID')} AS ClaimID,
  {S.date('PaymentDate')} AS PaymentDate, {S.safe_dec('PaymentAmount')} AS PaymentAmount,
  {S.b2n('PaymentMethod')} AS PaymentMethod, {S.b2n('PaymentStatus')} AS PaymentStatus,
  {S.b2n('ClaimType')} AS ClaimType, {S.b2n('ClaimSeverityBand')} AS ClaimSeverityBand,
  {S.safe_dec('OutstandingReserve')} AS OutstandingReserve, {S.safe_dec('IncurredAmount')} AS IncurredAmount,
  {S.strict_flag('LargeLossFlag')} AS LargeLossFlag
FROM cp_cls WHERE RejectReason IS NULL""", "cp_cls")
_CP_RAW = ["PaymentDate", "PaymentAmount", "OutstandingReserve", "IncurredAmount", "LargeLossFlag"]
_cp_rawsel = ", ".join(f"{c} AS {c}Raw" for c in _CP_RAW)
cte("reject_claim_payments", f"""SELECT PaymentID, ClaimID, 'Missing PaymentID' AS RejectReason, {_cp_rawsel}
FROM cp_keyed WHERE PaymentID IS NULL
UNION ALL SELECT PaymentID, ClaimID, RejectReason, {_cp_rawsel} FROM cp_cls WHERE RejectReason IS NOT NULL""",
    "cp_keyed", "cp_cls")

# --- S-04 claim_reserves -----------------------------------------------------
_snap = S.date_text_prefix("SnapshotDate")
_RES_FMTS = (C.UK, C.ISO, C.YMD_SLASH, C.DMY_DASH, "yyyyMMdd")
cte("cr_parsed", f"""SELECT {S.b2n('ReserveID')} AS ReserveID, {S.b2n('ClaimID')} AS ClaimID,
  SnapshotDate AS SnapshotDateRaw, {S.first_date(_snap, _RES_FMTS)} AS SnapshotDate,
  ReserveAmount AS ReserveAmountRaw, PreviousReserve AS PreviousReserveRaw, ReserveChange AS ReserveChangeRaw,
  {S.money('ReserveAmount', C.MONEY_CHARS_RESERVE)} AS ReserveAmount,
  {S.money('PreviousReserve', C.MONEY_CHARS_RESERVE)} AS PreviousReserve,
  {S.money('ReserveChange', C.MONEY_CHARS_RESERVE)} AS ReserveChange,
  {S.b2n('ReserveStatus')} AS ReserveStatus, {S.b2n('ReserveType')} AS ReserveType,
  {S.b2n('ReserveMovementType')} AS ReserveMovementType,
  {S.safe_int(S.b2n('LargeReserveFlag'))} AS LargeReserveFlag,
  {S.safe_int(S.b2n('LatestSnapshotFlag'))} AS LatestSnapshotFlag
FROM raw_claim_reserves""", "raw_claim_reserves")
_CR_RULES = [("ReserveID IS NULL", "ReserveID missing"), ("ClaimID IS NULL", "ClaimID missing"),
             ("SnapshotDate IS NULL", "SnapshotDate invalid/missing"),
             ("ReserveAmount IS NULL", "ReserveAmount invalid/missing"),
             ("PreviousReserve IS NULL", "PreviousReserve invalid/missing"),
             ("ReserveChange IS NULL", "ReserveChange invalid/missing")]
cte("cr_cls", f"SELECT *, {S.all_reasons(_CR_RULES)} AS RejectReason FROM cr_parsed", "cr_parsed")
cte("silver_claim_reserves", f"""SELECT ReserveID, ClaimID, SnapshotDate, ReserveAmount, PreviousReserve, ReserveChange,
  ReserveStatus, ReserveType, ReserveMovementType, LargeReserveFlag, LatestSnapshotFlag,
  {S.month_diff('SnapshotDate', "DATE '2001-12-31'")} AS ReserveAgeMonths
FROM cr_cls WHERE RejectReason IS NULL""", "cr_cls")
cte("reject_claim_reserves", """SELECT ReserveID, ClaimID, SnapshotDateRaw, ReserveAmountRaw, PreviousReserveRaw,
  ReserveChangeRaw, RejectReason FROM cr_cls WHERE RejectReason IS NOT NULL""", "cr_cls")


# --- S-05 claims, S-07 customer, S-08 date: latest, stays text ---------------
def _latest_text(entity: str, keys: list[str], reason: str) -> None:
    cols = raw_cols(entity)
    cte(f"{entity}_keyed", _keyed(f"raw_{entity}", keys), f"raw_{entity}")
    cte(f"{entity}_latest", _latest(f"{entity}_keyed", keys, [c for c in cols if c not in keys]), f"{entity}_keyed")
    sel = ", ".join(c if c in keys else f"{S.b2n(c)} AS {c}" for c in cols)
    cte(f"silver_{entity}", f"SELECT {sel} FROM {entity}_latest", f"{entity}_latest")
    cte(f"reject_{entity}", f"SELECT {', '.join(keys)}, {S.q(reason)} AS RejectReason FROM {entity}_keyed "
                            f"WHERE {_missing(keys)}", f"{entity}_keyed")


_latest_text("claims", ["ClaimID"], "Missing ClaimID")
_latest_text("customer", ["CustomerID"], "Missing CustomerID")
_latest_text("date", ["DateKey"], "Missing DateKey")

# --- S-01 address ------------------------------------------------------------
_ad = raw_cols("address")
cte("ad_keyed", _keyed("raw_address", ["AddressID"]), "raw_address")
cte("ad_latest", _latest("ad_keyed", ["AddressID"], [c for c in _ad if c != "AddressID"]), "ad_keyed")


def _soft_int(c: str) -> str:
    return f"({S.safe_int(c)} IS NULL AND {S.nonblank(c)})"


_AD_HARD = [(S.missing("CustomerID"), "Missing CustomerID")]
_AD_SOFT = [(_soft_int("BuildYear"), "Invalid BuildYear"), (_soft_int("Bedrooms"), "Invalid Bedrooms"),
            (_soft_int("HouseSizeSqFt"), "Invalid HouseSizeSqFt"),
            (f"{S.money('RebuildCostEstimate')} IS NULL", "RebuildCostEstimate not convertible")]
cte("ad_cls", f"SELECT *, {S.first_reason(_AD_HARD + _AD_SOFT)} AS RejectReason, "
              f"{S.missing('CustomerID')} AS _hard FROM ad_latest", "ad_latest")
_AD_TEXT = ", ".join(f"{S.b2n(c)} AS {c}" for c in
                     ("CustomerID",) + tuple(__import__("hearth.plans.silver", fromlist=["x"]).ADDRESS_TEXT))
cte("silver_address", f"""SELECT AddressID, {_AD_TEXT}, {S.safe_int('BuildYear')} AS BuildYear,
  {S.safe_int('Bedrooms')} AS Bedrooms, {S.safe_int('HouseSizeSqFt')} AS HouseSizeSqFt,
  {S.money('RebuildCostEstimate')} AS RebuildCostEstimate FROM ad_cls WHERE NOT _hard""", "ad_cls")
_ad_raw = "BuildYear AS BuildYearRaw, Bedrooms AS BedroomsRaw, HouseSizeSqFt AS HouseSizeSqFtRaw, " \
          "RebuildCostEstimate AS RebuildCostEstimateRaw"
cte("reject_address", f"""SELECT AddressID, 'Missing AddressID' AS RejectReason, {_ad_raw} FROM ad_keyed
WHERE AddressID IS NULL UNION ALL
SELECT AddressID, RejectReason, {_ad_raw} FROM ad_cls WHERE RejectReason IS NOT NULL""", "ad_keyed", "ad_cls")

# --- S-02 broker -------------------------------------------------------------
_br = raw_cols("broker")
cte("br_keyed", _keyed("raw_broker", ["BrokerID"]), "raw_broker")
cte("br_latest", _latest("br_keyed", ["BrokerID"], [c for c in _br if c != "BrokerID"]), "br_keyed")
cte("silver_broker", f"""SELECT BrokerID, {', '.join(f"{S.b2n(c)} AS {c}" for c in
    ("BrokerName", "Channel", "Region", "Status", "CommissionModel", "BrokerSizeBand"))},
  {S.safe_int('AppointmentYear')} AS AppointmentYear, {S.safe_int('RelationshipTenureYears')} AS RelationshipTenureYears,
  {S.safe_dec('CommissionRate', 18, 4)} AS CommissionRate, {S.safe_dec('EstimatedAnnualGWP_GBP')} AS EstimatedAnnualGWP_GBP
FROM br_latest""", "br_latest")
cte("reject_broker", "SELECT BrokerID, 'Missing BrokerID' AS RejectReason FROM br_keyed WHERE BrokerID IS NULL",
    "br_keyed")


# --- S-06 coverage (declared grain and reference grain) ----------------------
def _coverage(suffix: str, keys: list[str]) -> None:
    cols = raw_cols("coverage")
    cte(f"cov{suffix}_keyed", _keyed("raw_coverage", keys), "raw_coverage")
    cte(f"cov{suffix}_latest", _latest(f"cov{suffix}_keyed", keys, [c for c in cols if c not in keys]),
        f"cov{suffix}_keyed")
    text = ("ExcessBand", "CoverageTier") + (() if "CoverageType" in keys else ("CoverageType",))
    cte(f"silver_coverage{suffix}", f"""SELECT {', '.join(keys)}, {', '.join(f"{S.b2n(c)} AS {c}" for c in text)},
  {S.safe_dec('CoverageLimit')} AS CoverageLimit, {S.safe_dec('Excess')} AS Excess, {S.flag_yn('IsIncluded')} AS IsIncluded,
  {S.strict_flag('IsIncludedFlag')} AS IsIncludedFlag, {S.strict_flag('HighExposureFlag')} AS HighExposureFlag
FROM cov{suffix}_latest""", f"cov{suffix}_latest")
    cte(f"reject_coverage{suffix}", f"SELECT {', '.join(keys)}, {S.q('Missing ' + ' or '.join(keys))} AS RejectReason "
                                    f"FROM cov{suffix}_keyed WHERE {_missing(keys)}", f"cov{suffix}_keyed")


_coverage("", ["PolicyID", "CoverageType"])
_coverage("_ref", ["PolicyID"])

# --- S-09 operating_expenses -------------------------------------------------
_ox = raw_cols("operating_expenses")
_OX_KEYS = ["ExpenseMonthStart", "ExpenseCategory"]
cte("ox_keyed", _keyed("raw_operating_expenses", _OX_KEYS), "raw_operating_expenses")
cte("ox_latest", _latest("ox_keyed", _OX_KEYS, [c for c in _ox if c not in _OX_KEYS]), "ox_keyed")
cte("silver_operating_expenses", f"""SELECT ExpenseMonthStart, ExpenseCategory,
  {', '.join(f"{S.b2n(c)} AS {c}" for c in _ox if c not in _OX_KEYS)},
  concat_ws('|', coalesce(ExpenseMonthStart, ''), coalesce(ExpenseCategory, '')) AS ExpenseKey
FROM ox_latest""", "ox_latest")
cte("reject_operating_expenses", f"SELECT ExpenseMonthStart, ExpenseCategory, 'Missing expense key' AS RejectReason "
                                 f"FROM ox_keyed WHERE {_missing(_OX_KEYS)}", "ox_keyed")

# --- S-10 policy -------------------------------------------------------------
_POL_FMTS = (C.UK, C.ISO, C.YMD_SLASH)
cte("pol_keyed", _keyed("raw_policy", ["PolicyID"]), "raw_policy")
cte("pol_latest", "SELECT * FROM pol_keyed WHERE PolicyID IS NOT NULL QUALIFY row_number() OVER "
                  "(PARTITION BY PolicyID ORDER BY SourceLine DESC NULLS LAST) = 1", "pol_keyed")
cte("pol_typed", f"""SELECT PolicyID, {', '.join(f"{S.b2n(c)} AS {c}" for c in
    ("CustomerID", "AddressID", "BrokerID", "ProductType", "PolicyStatus", "PaymentPlan"))},
  {S.first_date('InceptionDate', _POL_FMTS)} AS InceptionDate, {S.first_date('ExpiryDate', _POL_FMTS)} AS ExpiryDate,
  {S.first_date('CreatedDate', _POL_FMTS)} AS CreatedDate, InceptionDate AS InceptionDateRaw,
  ExpiryDate AS ExpiryDateRaw, SourceLine AS BronzeRowID, 'PolicyCSV' AS SourceSystem
FROM pol_latest""", "pol_latest")
cte("silver_policy", """SELECT * EXCLUDE (InceptionDateRaw, ExpiryDateRaw) FROM pol_typed
WHERE NOT coalesce(ExpiryDate < InceptionDate, false)""", "pol_typed")
cte("reject_policy", """SELECT PolicyID, 'Missing PolicyID' AS RejectReason, InceptionDate AS InceptionDateRaw,
  ExpiryDate AS ExpiryDateRaw, SourceLine AS BronzeRowID FROM pol_keyed WHERE PolicyID IS NULL
UNION ALL SELECT PolicyID, 'ExpiryDate before InceptionDate', InceptionDateRaw, ExpiryDateRaw, BronzeRowID
FROM pol_typed WHERE ExpiryDate < InceptionDate""", "pol_keyed", "pol_typed")

# --- B-11 / S-11 policy_risk -------------------------------------------------
BRONZE_PR_COLS = ["PolicyID", "RiskType", "RiskScore", "HasAlarm", "PriorClaimsCount", "RiskBand", "HasAlarmFlag",
                  "ClaimsHistoryBand", "AlarmRiskAdjustment", "ClaimsRiskAdjustment", "AdjustedRiskScore",
                  "AdjustedRiskBand", "HighRiskFlag", "RiskDataCompletenessScore", "RiskScoreRaw", "HasAlarmRaw"]
cte("bronze_policy_risk", f"""SELECT {S.b2n('PolicyID')} AS PolicyID, {S.default_text('RiskType')} AS RiskType,
  {S.safe_dec('RiskScore', 10, 2)} AS RiskScore, {S.flag_yn('HasAlarm')} AS HasAlarm,
  {S.safe_int('PriorClaimsCount')} AS PriorClaimsCount, {S.default_text('RiskBand')} AS RiskBand,
  {S.flag01('HasAlarmFlag')} AS HasAlarmFlag, {S.default_text('ClaimsHistoryBand')} AS ClaimsHistoryBand,
  {S.safe_dec('AlarmRiskAdjustment', 10, 2)} AS AlarmRiskAdjustment,
  {S.safe_dec('ClaimsRiskAdjustment', 10, 2)} AS ClaimsRiskAdjustment,
  {S.safe_dec('AdjustedRiskScore', 10, 2)} AS AdjustedRiskScore, {S.default_text('AdjustedRiskBand')} AS AdjustedRiskBand,
  {S.flag01('HighRiskFlag')} AS HighRiskFlag, {S.safe_int('RiskDataCompletenessScore')} AS RiskDataCompletenessScore,
  RiskScore AS RiskScoreRaw, HasAlarm AS HasAlarmRaw, 'CalibratedCSV' AS SourceSystem
FROM raw_policy_risk""", "raw_policy_risk")


def _policy_risk(suffix: str, keys: list[str]) -> None:
    cte(f"pr{suffix}_latest", _latest("bronze_policy_risk", keys, [c for c in BRONZE_PR_COLS if c not in keys]),
        "bronze_policy_risk")
    cte(f"silver_policy_risk{suffix}", f"SELECT * EXCLUDE (RiskScoreRaw, HasAlarmRaw) FROM pr{suffix}_latest",
        f"pr{suffix}_latest")
    cte(f"reject_policy_risk{suffix}", f"SELECT {', '.join(keys)}, {S.q('Missing ' + ' or '.join(keys))} AS RejectReason "
                                       f"FROM bronze_policy_risk WHERE {_missing(keys)}", "bronze_policy_risk")


_policy_risk("", ["PolicyID", "RiskType"])
_policy_risk("_ref", ["PolicyID"])

# --- B-12 / S-12 premium_transactions ----------------------------------------
_PT_MONEY = ["GrossPremium", "IPTPremiumTax", "AdminFee", "Discount", "NetPremium"]
BRONZE_PT_COLS = ["PremiumTransactionID", "PolicyID", "TransactionDate", *_PT_MONEY, "TransactionStatus",
                  "CalculatedNetPremium", "NetPremiumVariance", "PremiumDataQualityFlag", "PremiumBand",
                  "InstallmentNumber", "IsInstallmentPlanFlag", "TransactionType", "YearMonth", "Year", "Month",
                  "IsYTDFlag", "IsLast12MonthsFlag", "TotalWrittenPremium", "TotalNetWrittenPremium", "IPTRatio",
                  "DiscountRatio", "TransactionDateRaw", "GrossPremiumRaw", "NetPremiumRaw"]
cte("bronze_premium_transactions", f"""SELECT {S.b2n('PremiumTransactionID')} AS PremiumTransactionID,
  {S.b2n('PolicyID')} AS PolicyID, {S.first_date('TransactionDate', (C.ISO, C.UK))} AS TransactionDate,
  {', '.join(f"{S.safe_dec(c)} AS {c}" for c in _PT_MONEY)},
  {S.default_text('TransactionStatus')} AS TransactionStatus,
  {S.safe_dec('CalculatedNetPremium')} AS CalculatedNetPremium, {S.safe_dec('NetPremiumVariance')} AS NetPremiumVariance,
  {S.flag01('PremiumDataQualityFlag')} AS PremiumDataQualityFlag, {S.default_text('PremiumBand')} AS PremiumBand,
  {S.safe_int('InstallmentNumber')} AS InstallmentNumber, {S.flag01('IsInstallmentPlanFlag')} AS IsInstallmentPlanFlag,
  {S.default_text('TransactionType')} AS TransactionType, {S.year_month('YearMonth')} AS YearMonth,
  {S.safe_int('Year')} AS Year, {S.safe_int('Month')} AS Month, {S.flag01('IsYTDFlag')} AS IsYTDFlag,
  {S.flag01('IsLast12MonthsFlag')} AS IsLast12MonthsFlag,
  {S.safe_dec('TotalWrittenPremium')} AS TotalWrittenPremium, {S.safe_dec('TotalNetWrittenPremium')} AS TotalNetWrittenPremium,
  {S.safe_dec('IPTRatio', 9, 4)} AS IPTRatio, {S.safe_dec('DiscountRatio', 9, 4)} AS DiscountRatio,
  TransactionDate AS TransactionDateRaw, GrossPremium AS GrossPremiumRaw, NetPremium AS NetPremiumRaw,
  'CalibratedCSV' AS SourceSystem
FROM raw_premium_transactions""", "raw_premium_transactions")
cte("pt_latest", _latest("bronze_premium_transactions", ["PremiumTransactionID"],
                         [c for c in BRONZE_PT_COLS if c != "PremiumTransactionID"]), "bronze_premium_transactions")
cte("silver_premium_transactions", "SELECT * EXCLUDE (TransactionDateRaw, GrossPremiumRaw, NetPremiumRaw) FROM pt_latest",
    "pt_latest")
cte("reject_premium_transactions", """SELECT PremiumTransactionID, 'Missing PremiumTransactionID' AS RejectReason,
  TransactionDateRaw, GrossPremiumRaw, NetPremiumRaw FROM bronze_premium_transactions
WHERE PremiumTransactionID IS NULL""", "bronze_premium_transactions")


# Output types of each silver table under the query convention (decimal ->
# double, int -> bigint); the Spark side converts generically.
PRESENT = {
    "address": (["RebuildCostEstimate"], ["BuildYear", "Bedrooms", "HouseSizeSqFt"]),
    "broker": (["CommissionRate", "EstimatedAnnualGWP_GBP"], ["AppointmentYear", "RelationshipTenureYears"]),
    "claim_payments": (["PaymentAmount", "OutstandingReserve", "IncurredAmount"], ["LargeLossFlag"]),
    "claim_reserves": (["ReserveAmount", "PreviousReserve", "ReserveChange"],
                       ["LargeReserveFlag", "LatestSnapshotFlag", "ReserveAgeMonths"]),
    "coverage": (["CoverageLimit", "Excess"], ["IsIncludedFlag", "HighExposureFlag"]),
    "coverage_ref": (["CoverageLimit", "Excess"], ["IsIncludedFlag", "HighExposureFlag"]),
    "policy_risk": (["RiskScore", "AlarmRiskAdjustment", "ClaimsRiskAdjustment", "AdjustedRiskScore"],
                    ["PriorClaimsCount", "HasAlarmFlag", "HighRiskFlag", "RiskDataCompletenessScore"]),
    "premium_transactions": (["GrossPremium", "IPTPremiumTax", "AdminFee", "Discount", "NetPremium",
                              "CalculatedNetPremium", "NetPremiumVariance", "TotalWrittenPremium",
                              "TotalNetWrittenPremium", "IPTRatio", "DiscountRatio"],
                             ["PremiumDataQualityFlag", "InstallmentNumber", "IsInstallmentPlanFlag", "Year",
                              "Month", "IsYTDFlag", "IsLast12MonthsFlag"]),
}
PRESENT["policy_risk_ref"] = PRESENT["policy_risk"]


def silver_query(entity: str, kind: str = "silver") -> str:
    """SQL of a silver (or reject) table under the output convention."""
    name = f"{kind}_{entity}"
    doubles, bigints = PRESENT.get(entity, ((), ())) if kind == "silver" else ((), ())
    return build(S.present(name, doubles, bigints), name)
