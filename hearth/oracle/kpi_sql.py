"""DuckDB SQL for the KPI queries (twins of hearth.plans.kpis)."""

from __future__ import annotations

from hearth.functions import kpi as K
from hearth.oracle import sqlfn as S
from hearth.oracle.reports_sql import _present, per_thousand, ratio, rollup_sql
from hearth.oracle.silver_sql import cte

cte("k_net", "SELECT coalesce(sum(NetPremium), 0) AS net_premium FROM silver_premium_transactions",
    "silver_premium_transactions")
cte("k_paid", "SELECT coalesce(sum(PaymentAmount), 0) AS claims_paid FROM silver_claim_payments", "silver_claim_payments")
cte("k_out", "SELECT coalesce(sum(ReserveAmount), 0) AS outstanding_reserves FROM latest_reserves", "latest_reserves")
cte("k_pol", """SELECT count(*) AS policies, count(DISTINCT PolicyID) AS unique_policies,
  count(CASE WHEN PolicyStatus = 'Active' THEN 1 END) AS active_policies, count(DISTINCT BrokerID) AS unique_brokers
FROM silver_policy""", "silver_policy")
cte("k_claims", "SELECT count(DISTINCT ClaimID) AS claims FROM silver_claims", "silver_claims")
cte("k_per_claim", "SELECT * FROM claim_paid WHERE ClaimPaid IS NOT NULL", "claim_paid")

_LR = ratio("claims_paid", "net_premium")
_ER = ratio("expenses", "net_premium")


def _lr_band(x: str) -> str:
    b = K.LOSS_RATIO_BANDS
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 0.60 THEN {S.q(b[0][1])} WHEN {x} < 0.80 THEN {S.q(b[1][1])} "
            f"WHEN {x} <= 1.00 THEN {S.q(b[2][1])} ELSE {S.q(K.LOSS_RATIO_TOP)} END")


def _lr_colour(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 0.80 THEN 'Green' WHEN {x} <= 1.00 THEN 'Amber' "
            f"ELSE {S.q(K.LOSS_RATIO_COLOUR_TOP)} END")


def _cr_band(x: str) -> str:
    b = K.COMBINED_RATIO_BANDS
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 0.90 THEN {S.q(b[0][1])} WHEN {x} <= 1.00 THEN {S.q(b[1][1])} "
            f"WHEN {x} <= 1.10 THEN {S.q(b[2][1])} ELSE {S.q(K.COMBINED_RATIO_TOP)} END")


def D(*c):
    return list(c)


KPI_SQL: dict[str, str] = {}
KPI_SQL["k_01"] = _present("SELECT net_premium AS total_net_premium FROM k_net", [], ["k_net"], doubles=D("total_net_premium"))
KPI_SQL["k_02"] = _present("SELECT coalesce(sum(GrossPremium), 0) AS written_premium FROM silver_premium_transactions",
                           [], ["silver_premium_transactions"], doubles=D("written_premium"))
KPI_SQL["k_03"] = _present("SELECT net_premium AS earned_premium FROM k_net", [], ["k_net"], doubles=D("earned_premium"))
KPI_SQL["k_03_prorata"] = _present("""SELECT
    round(coalesce(sum(CASE WHEN term > 0 THEN CAST(net AS DOUBLE) * elapsed / term END), 0.0), 2) AS earned_premium,
    CAST(coalesce(sum(CASE WHEN term > 0 THEN NULL ELSE net END), 0) AS DOUBLE) AS unknown_term_premium
FROM (SELECT net, date_diff('day', InceptionDate, ExpiryDate) AS term,
        least(greatest(date_diff('day', InceptionDate, DATE '2001-12-31'), 0),
              date_diff('day', InceptionDate, ExpiryDate)) AS elapsed
      FROM (SELECT PolicyID, sum(NetPremium) AS net FROM silver_premium_transactions
            GROUP BY PolicyID) t LEFT JOIN silver_policy p ON t.PolicyID = p.PolicyID) x""",
    [], ["silver_premium_transactions", "silver_policy"], doubles=D("earned_premium", "unknown_term_premium"))
KPI_SQL["k_04"] = _present("SELECT claims_paid FROM k_paid", ["claims_paid"], ["k_paid"])
KPI_SQL["k_05"] = _present("SELECT outstanding_reserves FROM k_out", [], ["k_out"], doubles=D("outstanding_reserves"))
KPI_SQL["k_06"] = _present("SELECT claims_paid + outstanding_reserves AS incurred_claims FROM k_paid, k_out", [],
                           ["k_paid", "k_out"], doubles=D("incurred_claims"))
KPI_SQL["k_07"] = _present(f"SELECT {_LR} AS loss_ratio FROM k_paid, k_net", ["loss_ratio"], ["k_paid", "k_net"])
KPI_SQL["k_07b"] = _present(f"SELECT {ratio('claims_paid + outstanding_reserves', 'net_premium')} AS loss_ratio "
                            f"FROM k_paid, k_net, k_out", ["loss_ratio"], ["k_paid", "k_net", "k_out"])
KPI_SQL["k_07c"] = KPI_SQL["k_07"]
KPI_SQL["k_08"] = _present(f"SELECT {_ER} AS expense_ratio FROM expenses_impacting, k_net", [],
                           ["expenses_impacting", "k_net"], doubles=D("expense_ratio"))
KPI_SQL["k_09"] = _present(f"SELECT {_LR} + {_ER} AS combined_ratio FROM k_paid, expenses_impacting, k_net", [],
                           ["k_paid", "expenses_impacting", "k_net"], doubles=D("combined_ratio"))
KPI_SQL["k_10"] = _present("""SELECT net_premium - claims_paid - outstanding_reserves - expenses AS underwriting_profit
FROM k_net, k_paid, k_out, expenses_impacting""", [], ["k_net", "k_paid", "k_out", "expenses_impacting"],
    doubles=D("underwriting_profit"))
KPI_SQL["k_11"] = _present("SELECT policies, unique_policies, active_policies FROM k_pol", [], ["k_pol"],
                           bigints=D("policies", "unique_policies", "active_policies"))
KPI_SQL["k_12"] = _present("SELECT unique_brokers FROM k_pol", [], ["k_pol"], bigints=D("unique_brokers"))
KPI_SQL["k_12_sketch"] = _present("""SELECT year(TransactionDate) AS year, count(DISTINCT PolicyID) AS policies, 1 AS sketch_within_4_percent
FROM silver_premium_transactions GROUP BY 1""", [], ["silver_premium_transactions"], bigints=D("year", "policies", "sketch_within_4_percent"))
KPI_SQL["k_13"] = _present("SELECT claims FROM k_claims", [], ["k_claims"], bigints=D("claims"))
KPI_SQL["k_14"] = _present(f"SELECT {per_thousand('claims', 'policies')} AS claims_per_1000 FROM k_claims, k_pol", [],
                           ["k_claims", "k_pol"], doubles=D("claims_per_1000"))
KPI_SQL["k_15"] = _present(f"SELECT {ratio('claims', 'policies')} AS claims_frequency FROM k_claims, k_pol", [],
                           ["k_claims", "k_pol"], doubles=D("claims_frequency"))
KPI_SQL["k_16"] = _present(f"SELECT {ratio('claims_paid', 'claims')} AS avg_claim_cost FROM k_paid, k_claims", [],
                           ["k_paid", "k_claims"], doubles=D("avg_claim_cost"))
KPI_SQL["k_17"] = _present("SELECT claims_paid + all_expenses AS combined_expenses FROM k_paid, expenses_all", [],
                           ["k_paid", "expenses_all"], doubles=D("combined_expenses"))
KPI_SQL["k_18"] = _present(f"""SELECT loss_ratio, {_lr_band('loss_ratio')} AS loss_ratio_band,
  {_lr_colour('loss_ratio')} AS loss_ratio_colour FROM (SELECT {_LR} AS loss_ratio FROM k_paid, k_net) t""",
    [], ["k_paid", "k_net"], doubles=D("loss_ratio"))
KPI_SQL["k_19"] = _present(f"""SELECT combined_ratio, {_cr_band('combined_ratio')} AS combined_ratio_band FROM
  (SELECT {_LR} + {_ER} AS combined_ratio FROM k_paid, expenses_impacting, k_net) t""",
    [], ["k_paid", "expenses_impacting", "k_net"], doubles=D("combined_ratio"))
KPI_SQL["k_20"] = _present(f"""SELECT high_risk_policies, {ratio('high_risk_policies', 'policies')} AS high_risk_share FROM
  (SELECT count(DISTINCT PolicyID) AS high_risk_policies FROM silver_policy_risk
   WHERE AdjustedRiskBand IN ('High', 'Very High')) t, (SELECT policies FROM k_pol) p""",
    [], ["silver_policy_risk", "k_pol"], doubles=D("high_risk_share"), bigints=D("high_risk_policies"))
KPI_SQL["k_21"] = _present("SELECT max(ClaimPaid) AS largest_claim FROM k_per_claim", [], ["k_per_claim"],
                           doubles=D("largest_claim"))
KPI_SQL["k_22"] = _present("""SELECT CAST(sum(ClaimPaid) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS median_claim FROM
  (SELECT ClaimPaid, row_number() OVER (ORDER BY ClaimPaid, ClaimID) AS rn, count(*) OVER () AS n FROM k_per_claim) t
WHERE rn = (n + 1) // 2 OR rn = (n + 2) // 2""", [], ["k_per_claim"], doubles=D("median_claim"))
KPI_SQL["k_22_by_type"] = _present("""SELECT Region, ClaimType, CAST(sum(ClaimPaid) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS median_claim FROM
  (SELECT *, row_number() OVER (PARTITION BY Region, ClaimType ORDER BY ClaimPaid) AS rn, count(*) OVER (PARTITION BY Region, ClaimType) AS n FROM
    (SELECT coalesce(a.Region, 'Unknown') AS Region, coalesce(c.ClaimType, 'Unknown') AS ClaimType, k.ClaimPaid FROM k_per_claim k
     LEFT JOIN silver_claims c ON k.ClaimID = c.ClaimID LEFT JOIN silver_policy p ON c.PolicyID = p.PolicyID
     LEFT JOIN silver_address a ON p.AddressID = a.AddressID) j) t
WHERE rn = (n + 1) // 2 OR rn = (n + 2) // 2 GROUP BY 1, 2""", [], ["k_per_claim", "silver_claims", "silver_policy", "silver_address"],
    doubles=D("median_claim"))
KPI_SQL["k_23"] = _present(f"""SELECT severe_claims, {ratio('severe_claims', '_n')} AS severe_share,
  {ratio('_sev', '_all')} AS severe_cost_share FROM
  (SELECT count(CASE WHEN ClaimPaid > {K.LARGE_CLAIM} THEN 1 END) AS severe_claims, count(*) AS _n,
     coalesce(sum(CASE WHEN ClaimPaid > {K.LARGE_CLAIM} THEN ClaimPaid END), 0) AS _sev,
     coalesce(sum(ClaimPaid), 0) AS _all FROM k_per_claim) t""",
    [], ["k_per_claim"], doubles=D("severe_share", "severe_cost_share"), bigints=D("severe_claims"))
KPI_SQL["k_24"] = _present(f"SELECT Broker, net_premium, claims, claims_paid, loss_ratio FROM ({rollup_sql('broker', 'Broker', ['net_premium', 'claims', 'claims_paid', 'loss_ratio'])}) r",
                           ["net_premium", "claims", "claims_paid", "loss_ratio"], ["grain", "broker_dim"])
KPI_SQL["k_25"] = _present(f"SELECT {ratio('policies', 'unique_brokers')} AS policies_per_broker FROM k_pol", [],
                           ["k_pol"], doubles=D("policies_per_broker"))
KPI_SQL["k_26"] = _present(f"""SELECT Channel, net_premium, {ratio('net_premium', '_total')} AS premium_share
FROM ({rollup_sql('broker', 'Channel', ['net_premium'])}) r, (SELECT sum(net_premium) AS _total FROM ({rollup_sql('broker', 'Channel', ['net_premium'])}) x) t""",
    ["net_premium"], ["grain", "broker_dim"], doubles=D("premium_share"))
KPI_SQL["k_27"] = _present(f"""SELECT coalesce(sum(RebuildCostEstimate), 0) AS total_rebuild,
  {ratio('sum(RebuildCostEstimate)', 'count(RebuildCostEstimate)')} AS avg_rebuild FROM silver_address""",
    [], ["silver_address"], doubles=D("total_rebuild", "avg_rebuild"))
KPI_SQL["k_28"] = _present(f"""SELECT {ratio('net_premium', 'policies')} AS avg_premium,
  {ratio('net_premium', 'policies')} / NULLIF({ratio('_rb', '_na')}, 0) AS premium_per_rebuild
FROM k_net, k_pol, (SELECT sum(RebuildCostEstimate) AS _rb, count(RebuildCostEstimate) AS _na FROM silver_address) a""",
    [], ["k_net", "k_pol", "silver_address"], doubles=D("avg_premium", "premium_per_rebuild"))
KPI_SQL["k_29"] = "SELECT strftime(TIMESTAMP '2002-01-01 00:00:00', '%Y-%m-%d %H:%M:%S') AS last_refresh " \
                  "FROM (SELECT count(*) AS n FROM lineitem) x"
