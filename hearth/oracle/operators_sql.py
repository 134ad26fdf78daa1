"""DuckDB SQL for the single-operator and extension queries (twins of hearth.plans.operators_q)."""

from __future__ import annotations

from hearth.oracle import gold_sql  # noqa: F401
from hearth.oracle import sqlfn as S
from hearth.oracle.reports_sql import _present, ratio, rollup_sql
from hearth.oracle.silver_sql import PRESENT, build, raw_cols, silver_query
from hearth.plans.audits import ENTITIES
from hearth.plans.operators_q import (BROKER_SCORE_WEIGHTS, LOOKUP_POLICY, POSTCODE_SCORE_WEIGHTS,
                                      TOP_BROKERS)

OPERATOR_SQL: dict[str, str] = {}

_BR_COLS = ["BrokerName", "Channel", "Region", "Status", "CommissionModel", "BrokerSizeBand", "AppointmentYear",
            "RelationshipTenureYears", "CommissionRate", "EstimatedAnnualGWP_GBP"]
_changed = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in _BR_COLS)
_take = f"(t.BrokerID IS NULL OR (s.BrokerID IS NOT NULL AND ({_changed})))"


def _snk_merge1() -> str:
    from hearth.oracle.silver_sql import cte
    cte("merge_target", """SELECT CAST(row_number() OVER (ORDER BY BrokerID) AS INTEGER) AS BrokerKey,
  * REPLACE (CASE WHEN BrokerSizeBand = 'Large' THEN 'Legacy' ELSE CommissionModel END AS CommissionModel)
FROM silver_broker WHERE Status = 'Active'""", "silver_broker")
    body = f"""SELECT * REPLACE (CAST(BrokerKey AS BIGINT) AS BrokerKey) FROM (
  SELECT coalesce(BrokerKey, mx + row_number() OVER (PARTITION BY BrokerKey IS NULL ORDER BY BrokerID)) AS BrokerKey,
    * EXCLUDE (BrokerKey, mx, upd), CAST(CAST(upd AS INTEGER) AS BIGINT) AS UpdatedThisLoad FROM (
    SELECT t.BrokerKey, {', '.join(f'CASE WHEN {_take} THEN s.{c} ELSE t.{c} END AS {c}' for c in ['BrokerID'] + _BR_COLS)},
      {_take} AS upd, (SELECT max(BrokerKey) FROM merge_target) AS mx
    FROM silver_broker s FULL JOIN merge_target t ON s.BrokerID = t.BrokerID) m) k"""
    d, b = PRESENT["broker"]
    return build(S.present(f"({body}) q", d, b), "silver_broker", "merge_target")


OPERATOR_SQL["snk_merge1"] = _snk_merge1()
OPERATOR_SQL["snk_merge1_buckets"] = OPERATOR_SQL["snk_merge1"]        # the same image, written another way
OPERATOR_SQL["a_dupn"] = build("""SELECT PolicyID, CoverageType, count(*) AS dup_count FROM
  (SELECT NULLIF(trim(PolicyID, ' '), '') AS PolicyID, NULLIF(trim(CoverageType, ' '), '') AS CoverageType FROM raw_coverage) r
WHERE PolicyID IS NOT NULL AND CoverageType IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""", "raw_coverage")
OPERATOR_SQL["a_dist"] = build("SELECT PolicyStatus, count(*) AS row_count FROM raw_policy GROUP BY 1", "raw_policy")
OPERATOR_SQL["o_topk"] = _present(f"""SELECT Broker, net_premium FROM ({rollup_sql('broker', 'Broker', ['net_premium'])}) r
ORDER BY net_premium DESC, Broker LIMIT {TOP_BROKERS}""", ["net_premium"], ["grain", "broker_dim"])
OPERATOR_SQL["w_lag"] = build("""SELECT ExpenseCategory, ExpenseMonth, CAST(ExpenseAmount AS DOUBLE) AS ExpenseAmount,
  CAST(PreviousMonthAmount AS DOUBLE) AS PreviousMonthAmount, CAST(PreviousMonthRecomputed AS DOUBLE) AS PreviousMonthRecomputed,
  CAST(CAST(PreviousMonthRecomputed IS NOT DISTINCT FROM PreviousMonthAmount AS INTEGER) AS BIGINT) AS Agrees FROM
  (SELECT *, lag(ExpenseAmount) OVER (PARTITION BY ExpenseCategory ORDER BY ExpenseMonth) AS PreviousMonthRecomputed
   FROM fact_operating_expenses) t""", "fact_operating_expenses")
OPERATOR_SQL["w_latestsnap"] = build("""SELECT CAST(LatestSnapshotFlag AS BIGINT) AS LatestSnapshotFlag,
  CAST(IsLatest AS BIGINT) AS IsLatest, count(*) AS reserves FROM
  (SELECT LatestSnapshotFlag, CAST(row_number() OVER (PARTITION BY ClaimID ORDER BY SnapshotDate DESC NULLS LAST,
     ReserveID DESC NULLS LAST) = 1 AS INTEGER) AS IsLatest FROM silver_claim_reserves) t GROUP BY 1, 2""",
    "silver_claim_reserves")
OPERATOR_SQL["p_26"] = build(f"SELECT * FROM raw_policy_risk WHERE PolicyID = {S.q(LOOKUP_POLICY)}", "raw_policy_risk")


def _minmax_sql(src: str, weights: dict) -> str:
    lo_hi = ", ".join([f"CAST(min({c}) AS DOUBLE) AS _lo_{c}" for c in weights] +
                      [f"CAST(max({c}) AS DOUBLE) AS _hi_{c}" for c in weights])
    terms = " + ".join(f"{w} * coalesce((CAST({c} AS DOUBLE) - _lo_{c}) / NULLIF(_hi_{c} - _lo_{c}, 0), 0.0)"
                       for c, w in weights.items())
    return f"SELECT s.*, {terms} AS risk_score FROM ({src}) s, (SELECT {lo_hi} FROM ({src}) x) m"


_E04_SRC = f"""SELECT b.Broker, b.policies, b.loss_ratio, b.claims_frequency,
  {ratio('coalesce(h.high_risk_policies, 0)', 'b.policies')} AS high_risk_share
FROM (SELECT Broker, policies, loss_ratio, claims_frequency FROM ({rollup_sql('broker', 'Broker', ['loss_ratio', 'claims_frequency'])}) r) b
LEFT JOIN (SELECT coalesce(p.BrokerID, 'Unknown') AS Broker, count(*) AS high_risk_policies
  FROM (SELECT DISTINCT PolicyID FROM silver_policy_risk WHERE AdjustedRiskBand IN ('High', 'Very High')) hr
  JOIN silver_policy p ON hr.PolicyID = p.PolicyID GROUP BY 1) h ON b.Broker = h.Broker"""
_E04_RANKS = ", ".join(f"percent_rank() OVER (ORDER BY {c} NULLS FIRST) AS {c}_rank" for c in BROKER_SCORE_WEIGHTS)
OPERATOR_SQL["e_04"] = _present(
    f"SELECT r.*, {' + '.join(f'{w} * {c}_rank' for c, w in BROKER_SCORE_WEIGHTS.items())} AS risk_score "
    f"FROM (SELECT s.*, {_E04_RANKS} FROM ({_E04_SRC}) s) r",
    ["policies", "loss_ratio", "claims_frequency"], ["grain", "broker_dim", "silver_policy_risk", "silver_policy"],
    doubles=["high_risk_share", "risk_score"])
OPERATOR_SQL["e_04_minmax"] = _present(_minmax_sql(_E04_SRC, BROKER_SCORE_WEIGHTS),
                                ["policies", "loss_ratio", "claims_frequency"],
                                ["grain", "broker_dim", "silver_policy_risk", "silver_policy"],
                                doubles=["high_risk_share", "risk_score"])
_E05_SRC = f"SELECT PostcodeArea, policies, loss_ratio, claims_frequency FROM ({rollup_sql('address', 'PostcodeArea', ['loss_ratio', 'claims_frequency'])}) r"
OPERATOR_SQL["e_05"] = _present(_minmax_sql(_E05_SRC, POSTCODE_SCORE_WEIGHTS),
                                ["policies", "loss_ratio", "claims_frequency"], ["grain", "address_dim"],
                                doubles=["risk_score"])
OPERATOR_SQL["e_03"] = """SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events GROUP BY 1, 2"""

# every event counts once, however often it was delivered
OPERATOR_SQL["e_03_stream"] = OPERATOR_SQL["e_03"].replace(
    "FROM events", "FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1) e")

# after three loads the stored sums are those of the whole table
OPERATOR_SQL["e_01_rollups"] = build("""SELECT 'month' AS grain, coalesce(strftime(TransactionDate, '%Y-%m'), 'Unknown') AS key,
  count(*) AS rows, CAST(coalesce(sum(NetPremium), 0) AS DOUBLE) AS net_premium FROM silver_premium_transactions GROUP BY 2
UNION ALL SELECT 'broker', coalesce(p.BrokerID, 'Unknown'), count(*), CAST(coalesce(sum(t.NetPremium), 0) AS DOUBLE)
FROM silver_premium_transactions t LEFT JOIN silver_policy p ON t.PolicyID = p.PolicyID GROUP BY 2""",
    "silver_premium_transactions", "silver_policy")

# after the load the target holds every row of the feed, with the feed's amounts
OPERATOR_SQL["e_01"] = build("""SELECT year(TransactionDate) AS year, count(*) AS rows,
  CAST(coalesce(sum(NetPremium), 0) AS DOUBLE) AS net_premium FROM silver_premium_transactions GROUP BY 1""",
    "silver_premium_transactions")

# P-01..P-10 twins
from hearth.functions import clean as _C  # noqa: E402

_PARSER_SQL = {
    "p_01": ("policy", "PolicyID", "PolicyID", lambda x: f"trim({x}, ' ')", None),
    "p_02": ("claims", "ClaimID", "ClaimID", S.b2n, None),
    "p_03": ("policy_risk", "PolicyID", "RiskScore", S.default_text, None),
    "p_04": ("policy_risk", "PolicyID", "RiskScore", lambda x: S.safe_dec(x, 10, 2), "DOUBLE"),
    "p_05": ("address", "AddressID", "RebuildCostEstimate", lambda x: S.money(x, _C.MONEY_CHARS_ADDRESS), "DOUBLE"),
    "p_05_reserve": ("claim_reserves", "ReserveID", "ReserveAmount", lambda x: S.money(x, _C.MONEY_CHARS_RESERVE),
                     "DOUBLE"),
    "p_06": ("claim_payments", "PaymentID", "PaymentDate", lambda x: S.date(x, _C.UK), None),
    "p_07": ("policy", "PolicyID", "InceptionDate", lambda x: S.first_date(x, (_C.UK, _C.ISO, _C.YMD_SLASH)), None),
    "p_08": ("claims", "ClaimID", "LossDate",
             lambda x: S.first_date(S.date_text_iso(x), (_C.UK, _C.ISO, _C.ISO_TIME)), None),
    "p_08_prefix": ("claim_reserves", "ReserveID", "SnapshotDate",
                    lambda x: S.first_date(S.date_text_prefix(x), (_C.UK, _C.ISO, _C.YMD_SLASH, _C.DMY_DASH, "yyyyMMdd")),
                    None),
    "p_09": ("premium_transactions", "PremiumTransactionID", "PremiumDataQualityFlag", S.flag01, "BIGINT"),
    "p_09b": ("policy_risk", "PolicyID", "HasAlarm", S.flag_yn, None),
    "p_09c": ("claim_payments", "PaymentID", "LargeLossFlag", S.strict_flag, "BIGINT"),
    "p_10": ("premium_transactions", "PremiumTransactionID", "YearMonth", S.year_month, None),
}
for _name, (_e, _k, _c, _fn, _t) in _PARSER_SQL.items():
    _parsed = f"CAST({_fn(_c)} AS {_t})" if _t else _fn(_c)
    OPERATOR_SQL[_name] = build(f"SELECT {_k} AS Key, {_c} AS RawValue, {_parsed} AS Parsed FROM raw_{_e}", f"raw_{_e}")

OPERATOR_SQL["j_inner"] = build("""SELECT * REPLACE (CAST(ExpenseAmount AS DOUBLE) AS ExpenseAmount,
  CAST(InflationAdjustedAmount AS DOUBLE) AS InflationAdjustedAmount, CAST(PreviousMonthAmount AS DOUBLE) AS PreviousMonthAmount,
  CAST(MoMVariance AS DOUBLE) AS MoMVariance, CAST(ImpactsExpenseRatioFlag AS BIGINT) AS ImpactsExpenseRatioFlag)
FROM (SELECT * EXCLUDE (OperatingExpenseKey, ExpenseCategoryKey, DateKey) FROM fact_operating_expenses) f""",
    "fact_operating_expenses")
OPERATOR_SQL["a_cond"] = build("""SELECT count(CASE WHEN ClaimStatus = 'Closed' THEN 1 END) AS closed_claims,
  count(CASE WHEN ReopenedFlag = '1' THEN 1 END) AS reopened_claims, count(CASE WHEN FraudFlag = '1' THEN 1 END) AS fraud_flagged,
  count(CASE WHEN CatEventFlag = '1' THEN 1 END) AS catastrophe_claims,
  count(CASE WHEN ClaimComplexity = 'Complex' THEN 1 END) AS complex_claims FROM silver_claims""", "silver_claims")
OPERATOR_SQL["x_distinct"] = build("""SELECT DISTINCT coalesce(upper(NULLIF(trim(CoverageType, ' '), '')), 'UNKNOWN') AS CoverageType
FROM silver_coverage""", "silver_coverage")

# sources and sinks read back
OPERATOR_SQL["src_csv"] = build("SELECT * FROM raw_broker", "raw_broker")
_CLAIM_COLS = raw_cols("claims")
OPERATOR_SQL["src_csv_lf"] = build(f"SELECT {', '.join(f"NULLIF({c}, '') AS {c}" for c in _CLAIM_COLS)} FROM raw_claims", "raw_claims")
OPERATOR_SQL["src_badrows"] = build("""SELECT BrokerID, CASE WHEN right(trim(BrokerID, ' '), 1) IN ('3', '7')
  THEN 'Wrong number of fields' END AS RejectReason FROM raw_broker""", "raw_broker")
OPERATOR_SQL["snk_overwrite"] = silver_query("broker")
OPERATOR_SQL["snk_byname"] = build(S.present("(SELECT * REPLACE (CAST(NULL AS VARCHAR) AS CommissionModel) FROM silver_broker) q",
                                             *PRESENT["broker"]), "silver_broker")
OPERATOR_SQL["snk_addcol"] = build("""SELECT PremiumTransactionID, PolicyID, CAST(NetPremium AS DOUBLE) AS NetPremium,
  CAST(NULL AS DOUBLE) AS TotalWrittenPremium, CAST(NULL AS DOUBLE) AS TotalNetWrittenPremium, CAST(NULL AS DOUBLE) AS IPTRatio,
  CAST(NULL AS DOUBLE) AS DiscountRatio, SourceSystem FROM bronze_premium_transactions""", "bronze_premium_transactions")
_SYSTEM = {"policy": "'PolicyCSV'", "policy_risk": "'CalibratedCSV'", "premium_transactions": "'CalibratedCSV'",
           "operating_expenses": "SourceSystem"}
OPERATOR_SQL["snk_stamps"] = build(" UNION ALL ".join(
    f"SELECT '{e}' AS entity, {'NULL' if e in ('policy', 'policy_risk', 'premium_transactions') else S.q(e + '.csv')} AS SourceFile, "
    f"{_SYSTEM.get(e, 'NULL')} AS SourceSystem, '2002-01-01 00:00:00' AS loaded_at, count(*) AS rows FROM raw_{e} GROUP BY ALL"
    for e in ENTITIES), *[f"raw_{e}" for e in ENTITIES])
OPERATOR_SQL["j_anti"] = build("""SELECT PolicyID, PolicyStatus FROM silver_policy p WHERE NOT EXISTS
  (SELECT 1 FROM silver_premium_transactions t WHERE t.PolicyID = p.PolicyID)""", "silver_policy", "silver_premium_transactions")
OPERATOR_SQL["j_anti_expr"] = build("""SELECT CAST(CASE CoverageType WHEN 'UNKNOWN' THEN -1 WHEN 'BUILDINGS' THEN 1 WHEN 'CONTENTS' THEN 2
  ELSE 2 + row_number() OVER (PARTITION BY CoverageType IN ('UNKNOWN', 'BUILDINGS', 'CONTENTS') ORDER BY CoverageType) END AS BIGINT)
  AS CoverageKey, CoverageType FROM dim_coverage""", "dim_coverage")
OPERATOR_SQL["rpt_broker_policy"] = build("""SELECT PolicyID, BrokerID, ProductType, PolicyStatus, InceptionDate, ExpiryDate,
  BrokerName, Channel FROM silver_policy p LEFT JOIN broker_dim b ON p.BrokerID = b._dk""", "silver_policy", "broker_dim")
OPERATOR_SQL["rpt_claim_payment"] = build("""SELECT PaymentID, p.ClaimID, PaymentDate, CAST(PaymentAmount AS DOUBLE) AS PaymentAmount,
  p.ClaimType, PolicyID, LossDate, ClaimStatus, Severity FROM silver_claim_payments p LEFT JOIN fact_claim c ON p.ClaimID = c.ClaimID""",
    "silver_claim_payments", "fact_claim")
OPERATOR_SQL["o_top"] = build("SELECT PolicyID, CustomerID, PolicyStatus FROM silver_policy ORDER BY PolicyID LIMIT 20", "silver_policy")
OPERATOR_SQL["e_02"] = build("""SELECT CAST(Year AS BIGINT) AS Year, CAST(Month AS BIGINT) AS Month, count(*) AS rows,
  CAST(coalesce(sum(NetPremium), 0) AS DOUBLE) AS net_premium FROM silver_premium_transactions WHERE Year = 1998 GROUP BY 1, 2""",
    "silver_premium_transactions")
OPERATOR_SQL["d_01_second_load"] = build("""SELECT CAST(CASE WHEN known THEN k ELSE (SELECT count(*) FROM silver_address WHERE Tenure = 'Freehold') + k END
  AS BIGINT) AS AddressKey, AddressID, City, Tenure, CAST(1 AS BIGINT) AS Changed FROM
  (SELECT *, Tenure IS NOT DISTINCT FROM 'Freehold' AS known, row_number() OVER (PARTITION BY Tenure IS NOT DISTINCT FROM 'Freehold' ORDER BY AddressID) AS k
   FROM silver_address) a
UNION ALL SELECT -1, 'UNKNOWN', NULL, NULL, 0""", "silver_address")
OPERATOR_SQL["e_06_calibration"] = build("""SELECT count(*) AS policies,
  count(CASE WHEN EXISTS (SELECT 1 FROM silver_claims c WHERE c.PolicyID = p.PolicyID) THEN 1 END) AS policies_with_claim,
  CAST(1 AS BIGINT) AS calibrated FROM silver_policy p""", "silver_policy", "silver_claims")
OPERATOR_SQL["e_06_folds"] = build("""SELECT count(*) FILTER (NOT t) AS train_policies, count(*) FILTER (NOT t AND l) AS train_with_claim,
  count(*) FILTER (t) AS test_policies, count(*) FILTER (t AND l) AS test_with_claim,
  CAST(1 AS BIGINT) AS ranks_better, CAST(1 AS BIGINT) AS predicts_better
FROM (SELECT md5(PolicyID)[1] < '4' AS t, PolicyID IN (SELECT PolicyID FROM silver_claims WHERE PolicyID IS NOT NULL) AS l FROM silver_policy)""",
    "silver_policy", "silver_claims")
