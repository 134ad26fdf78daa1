"""DuckDB SQL for the star roll-ups and report queries (twins of hearth.plans.star/reports)."""

from __future__ import annotations

from hearth.functions import kpi as K
from hearth.oracle import gold_sql  # noqa: F401  (registers gold CTEs)
from hearth.oracle import sqlfn as S
from hearth.oracle.silver_sql import build, cte


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def per_thousand(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) * 1000.0 / NULLIF(CAST({b} AS DOUBLE), 0))"


def msum(x: str) -> str:
    return f"coalesce(sum({x}), 0)"


def age_band(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN 'Unknown' WHEN {x} < 1945 THEN {S.q(K.AGE_BANDS[0][1])} "
            f"WHEN {x} < 1980 THEN {S.q(K.AGE_BANDS[1][1])} WHEN {x} < 2000 THEN {S.q(K.AGE_BANDS[2][1])} "
            f"ELSE {S.q(K.AGE_BAND_TOP)} END")


def cost_band(x: str) -> str:
    return (f"CASE WHEN {x} < 5000 THEN {S.q(K.COST_BANDS[0][1])} WHEN {x} < 20000 THEN {S.q(K.COST_BANDS[1][1])} "
            f"WHEN {x} <= {K.LARGE_CLAIM} THEN {S.q(K.COST_BAND_HIGH)} ELSE {S.q(K.COST_BAND_TOP)} END")


cte("prem_pol", "SELECT PolicyID, 1 AS has_prem, sum(NetPremium) AS net, sum(GrossPremium) AS gross "
                "FROM silver_premium_transactions GROUP BY PolicyID", "silver_premium_transactions")
cte("claim_paid", "SELECT ClaimID, sum(PaymentAmount) AS ClaimPaid, count(*) AS payments "
                  "FROM silver_claim_payments GROUP BY ClaimID", "silver_claim_payments")
cte("paid_pol", "SELECT c.PolicyID, 1 AS has_paid, sum(cp.ClaimPaid) AS paid FROM claim_paid cp "
                "LEFT JOIN silver_claims c ON cp.ClaimID = c.ClaimID GROUP BY c.PolicyID", "claim_paid", "silver_claims")
cte("claims_pol", "SELECT PolicyID, 1 AS has_claim, count(*) AS n_claims FROM silver_claims GROUP BY PolicyID", "silver_claims")
cte("facts_pol", """SELECT coalesce(coalesce(p.PolicyID, q.PolicyID), n.PolicyID) AS PolicyID, net, gross, paid, n_claims,
  has_prem, has_paid, has_claim
FROM prem_pol p FULL JOIN paid_pol q ON p.PolicyID = q.PolicyID
FULL JOIN claims_pol n ON coalesce(p.PolicyID, q.PolicyID) = n.PolicyID""", "prem_pol", "paid_pol", "claims_pol")
cte("grain", """SELECT coalesce(pol.PolicyID, f.PolicyID) AS PolicyID, AddressID, BrokerID, PolicyStatus, InceptionDate,
  is_policy, net, gross, paid, n_claims, has_prem, has_paid, has_claim
FROM (SELECT PolicyID, AddressID, BrokerID, PolicyStatus, InceptionDate, 1 AS is_policy FROM silver_policy) pol
FULL JOIN facts_pol f ON pol.PolicyID = f.PolicyID""", "silver_policy", "facts_pol")
cte("address_dim", f"""SELECT AddressID AS _dk, City, Region, PropertyType, {age_band('BuildYear')} AS PropertyAgeBand,
  PostcodeArea FROM silver_address""", "silver_address")
cte("broker_dim", "SELECT BrokerID AS _dk, Channel, BrokerName, BrokerID AS Broker FROM silver_broker", "silver_broker")

PARTIALS = ("count(CASE WHEN is_policy = 1 THEN 1 END) AS policies, "
            "count(CASE WHEN PolicyStatus = 'Active' THEN 1 END) AS active_policies, "
            "sum(net) AS net_premium, sum(gross) AS gross_premium, sum(paid) AS claims_paid, "
            "sum(n_claims) AS claims")
FINISH = ("sum(policies) AS policies, sum(active_policies) AS active_policies, "
          "coalesce(sum(net_premium), 0) AS net_premium, coalesce(sum(gross_premium), 0) AS gross_premium, "
          "coalesce(sum(claims_paid), 0) AS claims_paid, coalesce(sum(claims), 0) AS claims")
RATIOS = (f"{ratio('claims_paid', 'net_premium')} AS loss_ratio, {ratio('claims', 'policies')} AS claims_frequency, "
          f"{ratio('claims_paid', 'claims')} AS avg_claim_cost, {per_thousand('claims', 'policies')} AS claims_per_1000")
DOUBLES = ["net_premium", "gross_premium", "claims_paid", "loss_ratio", "claims_frequency", "avg_claim_cost",
           "claims_per_1000"]
BIGINTS = ["policies", "active_policies", "claims"]


# Which rows of the policy grain a measure is about, besides the policies themselves.
ABOUT = {"net_premium": ("has_prem",), "gross_premium": ("has_prem",), "claims_paid": ("has_paid",), "claims": ("has_claim",),
         "loss_ratio": ("has_paid", "has_prem"), "claims_frequency": ("has_claim",),
         "avg_claim_cost": ("has_paid", "has_claim"), "claims_per_1000": ("has_claim",)}


def rollup_sql(dim: str, attr: str, measures: list[str]) -> str:
    fk = "AddressID" if dim == "address" else "BrokerID"
    rows = " OR ".join(f"{x} = 1" for x in dict.fromkeys(["is_policy", *[a for m in measures for a in ABOUT.get(m, ())]]))
    return (f"SELECT *, {RATIOS} FROM (SELECT coalesce(d.{attr}, 'Unknown') AS {attr}, {FINISH} "
            f"FROM (SELECT {fk}, {PARTIALS} FROM grain WHERE {rows} GROUP BY {fk}) pre "
            f"LEFT JOIN {dim}_dim d ON pre.{fk} = d._dk GROUP BY 1) t")


cte("totals", f"SELECT *, {RATIOS} FROM (SELECT {FINISH} FROM (SELECT {PARTIALS} FROM grain) p) t", "grain")
cte("expenses_impacting", "SELECT coalesce(sum(ExpenseAmount), 0) AS expenses FROM fact_operating_expenses "
                          "WHERE ImpactsExpenseRatioFlag = 1", "fact_operating_expenses")
cte("expenses_all", "SELECT coalesce(sum(ExpenseAmount), 0) AS all_expenses FROM fact_operating_expenses",
    "fact_operating_expenses")
cte("latest_reserves", """SELECT * FROM silver_claim_reserves WHERE ClaimID IS NOT NULL QUALIFY row_number() OVER
  (PARTITION BY ClaimID ORDER BY SnapshotDate DESC NULLS LAST, ReserveID DESC NULLS LAST) = 1""",
    "silver_claim_reserves")
def _present(sql: str, cols: list[str], deps: list[str], doubles=(), bigints=()) -> str:
    d = list(dict.fromkeys([c for c in cols if c in DOUBLES] + list(doubles)))
    b = list(dict.fromkeys([c for c in cols if c in BIGINTS] + list(bigints)))
    return build(S.present(f"({sql}) q", d, b), *deps)


def by_sql(dim: str, attr: str, cols: list[str]) -> str:
    return _present(f"SELECT {attr}, {', '.join(cols)} FROM ({rollup_sql(dim, attr, cols)}) r", [attr, *cols],
                    ["grain", f"{dim}_dim"])


def claim_type_stats() -> str:
    return ("SELECT ClaimType, coalesce(sum(paid), 0) AS claims_paid, count(*) AS claims FROM "
            "(SELECT coalesce(ClaimType, 'Unknown') AS ClaimType, ClaimID, sum(PaymentAmount) AS paid "
            "FROM silver_claim_payments GROUP BY 1, 2) x GROUP BY ClaimType")


REPORT_SQL: dict[str, str] = {}
REPORT_SQL["r_01"] = _present(f"""SELECT net_premium AS total_net_premium, gross_premium AS gross_written_premium,
  claims_paid, policies, active_policies, claims, loss_ratio, {ratio('expenses', 'net_premium')} AS expense_ratio,
  {ratio('claims_paid', 'net_premium')} + {ratio('expenses', 'net_premium')} AS combined_ratio,
  claims_frequency, avg_claim_cost, claims_paid + all_expenses AS combined_expenses
FROM totals, expenses_impacting, expenses_all""",
    ["total_net_premium", "gross_written_premium", "expense_ratio", "combined_ratio", "combined_expenses",
     "claims_paid", "policies", "active_policies", "claims", "loss_ratio", "claims_frequency", "avg_claim_cost"],
    ["totals", "expenses_impacting", "expenses_all"],
    doubles=["total_net_premium", "gross_written_premium", "expense_ratio", "combined_ratio", "combined_expenses"])
REPORT_SQL["r_02"] = _present("""SELECT coalesce(ClaimType, 'Unknown') AS ClaimType, coalesce(sum(PaymentAmount), 0)
  AS claims_paid, count(*) AS payments FROM silver_claim_payments GROUP BY 1""",
    ["claims_paid", "payments"], ["silver_claim_payments"], bigints=["payments"])
REPORT_SQL["r_03"] = _present("""SELECT strftime(PaymentDate, '%Y-%m') AS month, coalesce(sum(PaymentAmount), 0)
  AS claims_paid FROM silver_claim_payments GROUP BY 1""", ["claims_paid"], ["silver_claim_payments"])
REPORT_SQL["r_04"] = by_sql("address", "City", ["claims_paid", "claims"])
REPORT_SQL["r_05"] = _present(f"""SELECT ClaimType, claims_paid, {ratio('claims_paid', '_net')} AS loss_ratio
FROM ({claim_type_stats()}) s, (SELECT net_premium AS _net FROM totals) t""", ["claims_paid", "loss_ratio"], ["silver_claim_payments", "totals"])
REPORT_SQL["r_06"] = _present(f"""SELECT ClaimType, claims, {ratio('claims', '_pol')} AS claims_frequency FROM
  (SELECT coalesce(ClaimType, 'Unknown') AS ClaimType, count(*) AS claims FROM silver_claims GROUP BY 1) c,
  (SELECT policies AS _pol FROM totals) t""",
    ["claims", "claims_frequency"], ["silver_claims", "totals"])
REPORT_SQL["r_07"] = _present(f"""SELECT ClaimType, claims_paid, claims, {ratio('claims_paid', 'claims')} AS avg_claim_cost
FROM ({claim_type_stats()}) s""", ["claims_paid", "claims", "avg_claim_cost"], ["silver_claim_payments"])
REPORT_SQL["r_08"] = by_sql("broker", "Channel", ["claims_paid", "claims"])
REPORT_SQL["r_09"] = by_sql("address", "PropertyType", ["claims_paid", "claims"])
REPORT_SQL["r_10"] = by_sql("address", "PropertyType", ["active_policies", "policies"])
REPORT_SQL["r_11"] = _present(f"""SELECT coalesce(PropertyType, 'Unknown') AS PropertyType,
  coalesce(sum(RebuildCostEstimate), 0) AS total_rebuild, count(RebuildCostEstimate) AS addresses,
  {ratio('sum(RebuildCostEstimate)', 'count(RebuildCostEstimate)')} AS avg_rebuild FROM silver_address GROUP BY 1""",
    ["total_rebuild", "addresses", "avg_rebuild"], ["silver_address"], doubles=["total_rebuild", "avg_rebuild"],
    bigints=["addresses"])
REPORT_SQL["r_12"] = by_sql("broker", "Channel", ["net_premium", "gross_premium"])
REPORT_SQL["r_13"] = by_sql("address", "PropertyType", ["net_premium"])
REPORT_SQL["r_14"] = by_sql("address", "PropertyType", ["claims_paid", "claims", "avg_claim_cost"])
REPORT_SQL["r_15"] = by_sql("address", "PropertyType", ["net_premium", "claims_paid", "loss_ratio"])
REPORT_SQL["r_16"] = by_sql("broker", "Channel", ["claims", "policies", "claims_frequency"])
REPORT_SQL["r_17"] = by_sql("broker", "Channel", ["net_premium", "claims_paid", "loss_ratio"])
REPORT_SQL["r_18"] = by_sql("broker", "Channel", ["claims", "policies", "claims_per_1000"])
REPORT_SQL["r_19"] = _present(f"""SELECT Region, net_premium, claims_paid, loss_ratio FROM ({rollup_sql('address', 'Region', ['loss_ratio'])}) r
ORDER BY loss_ratio DESC NULLS LAST, Region LIMIT 3""", ["net_premium", "claims_paid", "loss_ratio"],
    ["grain", "address_dim"])
REPORT_SQL["r_20"] = by_sql("address", "Region", ["claims", "policies", "claims_frequency"])
REPORT_SQL["r_21"] = by_sql("address", "Region", ["claims_paid", "claims", "avg_claim_cost"])
REPORT_SQL["r_22"] = by_sql("address", "Region", ["net_premium", "loss_ratio"])
REPORT_SQL["r_23"] = _present(f"""SELECT {cost_band('ClaimPaid')} AS cost_band, count(*) AS claims,
  coalesce(sum(ClaimPaid), 0) AS claims_paid FROM claim_paid WHERE ClaimPaid IS NOT NULL GROUP BY 1""",
    ["claims", "claims_paid"], ["claim_paid"])
REPORT_SQL["r_24"] = _present(f"""SELECT Severity, coalesce(sum(paid), 0) AS claims_paid, count(*) AS claims,
  {ratio('sum(paid)', 'count(*)')} AS avg_claim_cost FROM
  (SELECT coalesce(ClaimSeverityBand, 'Unknown') AS Severity, ClaimID, sum(PaymentAmount) AS paid
   FROM silver_claim_payments GROUP BY 1, 2) p GROUP BY Severity""",
    ["claims_paid", "claims", "avg_claim_cost"], ["silver_claim_payments"])
REPORT_SQL["r_25"] = by_sql("address", "PropertyAgeBand", ["claims", "policies", "claims_per_1000"])
REPORT_SQL["r_26"] = _present(f"""SELECT Broker, policies, net_premium, claims_paid, loss_ratio,
  {ratio('net_premium', '_total')} AS premium_share
FROM ({rollup_sql('broker', 'Broker', ['loss_ratio'])}) b, (SELECT sum(net_premium) AS _total FROM ({rollup_sql('broker', 'Broker', ['net_premium'])}) x) t""",
    ["policies", "net_premium", "claims_paid", "loss_ratio", "premium_share"], ["grain", "broker_dim"],
    doubles=["premium_share"])
cte("monthly", """SELECT m, coalesce(sum(net_premium), 0) AS net_premium, coalesce(sum(claims_paid), 0) AS claims_paid,
  coalesce(sum(expenses), 0) AS expenses FROM (
  SELECT CAST(date_trunc('month', TransactionDate) AS DATE) AS m, NetPremium AS net_premium, NULL AS claims_paid, NULL AS expenses
    FROM silver_premium_transactions
  UNION ALL SELECT CAST(date_trunc('month', PaymentDate) AS DATE), NULL, PaymentAmount, NULL FROM silver_claim_payments
  UNION ALL SELECT CAST(date_trunc('month', ExpenseMonth) AS DATE), NULL, NULL, ExpenseAmount FROM fact_operating_expenses
    WHERE ImpactsExpenseRatioFlag = 1) u GROUP BY m""",
    "silver_premium_transactions", "silver_claim_payments", "fact_operating_expenses")
_R27_COLS = ["net_premium", "claims_paid", "expenses", "loss_ratio", "combined_ratio", "net_premium_prev_month",
             "net_premium_prev_year", "claims_paid_prev_month", "claims_paid_prev_year", "premium_mom", "premium_yoy"]
REPORT_SQL["r_27"] = _present(f"""SELECT coalesce(strftime(a.m, '%Y-%m'), 'Unknown') AS month, a.net_premium, a.claims_paid, a.expenses,
  {ratio('a.claims_paid', 'a.net_premium')} AS loss_ratio,
  {ratio('a.claims_paid', 'a.net_premium')} + {ratio('a.expenses', 'a.net_premium')} AS combined_ratio,
  pm.net_premium AS net_premium_prev_month, py.net_premium AS net_premium_prev_year,
  pm.claims_paid AS claims_paid_prev_month, py.claims_paid AS claims_paid_prev_year,
  {ratio('a.net_premium - pm.net_premium', 'pm.net_premium')} AS premium_mom,
  {ratio('a.net_premium - py.net_premium', 'py.net_premium')} AS premium_yoy
FROM (SELECT *, year(m) * 12 + month(m) - 1 AS mi FROM monthly) a
LEFT JOIN (SELECT *, year(m) * 12 + month(m) - 1 AS mi FROM monthly WHERE m IS NOT NULL) pm ON a.mi = pm.mi + 1
LEFT JOIN (SELECT *, year(m) * 12 + month(m) - 1 AS mi FROM monthly WHERE m IS NOT NULL) py ON a.mi = py.mi + 12""",
    _R27_COLS, ["monthly"], doubles=_R27_COLS)
REPORT_SQL["r_28"] = _present("""SELECT coalesce(a.Region, 'Unknown') AS Region, strftime(c.LossDate, '%Y-%m') AS month,
  count(*) AS claims FROM fact_claim c LEFT JOIN silver_policy p ON c.PolicyID = p.PolicyID
LEFT JOIN address_dim a ON p.AddressID = a._dk GROUP BY 1, 2""", ["claims"],
    ["fact_claim", "silver_policy", "address_dim"])
REPORT_SQL["r_28_high_risk"] = _present("""SELECT strftime(p.InceptionDate, '%Y-%m') AS month, count(*) AS high_risk_policies
FROM (SELECT DISTINCT PolicyID FROM silver_policy_risk WHERE AdjustedRiskBand IN ('High', 'Very High')) h
LEFT JOIN silver_policy p ON h.PolicyID = p.PolicyID GROUP BY 1""", ["high_risk_policies"],
    ["silver_policy_risk", "silver_policy"], bigints=["high_risk_policies"])
REPORT_SQL["r_29"] = _present("""SELECT ExpenseCategory, strftime(ExpenseMonth, '%Y-%m') AS month,
  coalesce(sum(ExpenseAmount), 0) AS expenses FROM fact_operating_expenses GROUP BY 1, 2""", ["expenses"],
    ["fact_operating_expenses"], doubles=["expenses"])
REPORT_SQL["r_30"] = _present(f"""SELECT a.*, coalesce(l.outstanding_latest, 0) AS outstanding_latest FROM
  (SELECT coalesce(ReserveMovementType, 'Unknown') AS ReserveMovementType, count(*) AS reserves,
     coalesce(sum(ReserveChange), 0) AS total_change,
     {ratio('sum(ReserveAgeMonths)', 'count(ReserveAgeMonths)')} AS avg_age_months
   FROM silver_claim_reserves GROUP BY 1) a
LEFT JOIN (SELECT coalesce(ReserveMovementType, 'Unknown') AS mt, coalesce(sum(ReserveAmount), 0) AS outstanding_latest
   FROM latest_reserves GROUP BY 1) l ON a.ReserveMovementType = l.mt""",
    ["reserves", "total_change", "avg_age_months", "outstanding_latest"], ["silver_claim_reserves", "latest_reserves"],
    doubles=["total_change", "avg_age_months", "outstanding_latest"], bigints=["reserves"])
