"""Report queries and KPI queries (§2.11, K-01..K-29).

Every function takes a ``Warehouse`` and returns a presented DataFrame
(money/ratios as double, counts as bigint, every column aliased).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions import kpi as K
from hearth.operators.windows import with_prior_periods
from hearth.plans import star
from hearth.plans.model import present

TOP_REGIONS = 3


def _p(df: DataFrame) -> DataFrame:
    return present(df)


# --------------------------------------------------------------------------- R
def r_01(wh) -> DataFrame:
    """Executive KPI row."""
    t = star.totals(wh).crossJoin(star.expenses(wh, True)).crossJoin(
        star.expenses(wh, False).withColumnRenamed("expenses", "all_expenses"))
    return _p(t.select(
        F.col("net_premium").alias("total_net_premium"), F.col("gross_premium").alias("gross_written_premium"),
        "claims_paid", "policies", "active_policies", "claims", "loss_ratio",
        K.ratio("expenses", "net_premium").alias("expense_ratio"),
        (K.ratio("claims_paid", "net_premium") + K.ratio("expenses", "net_premium")).alias("combined_ratio"),
        "claims_frequency", "avg_claim_cost",
        (F.col("claims_paid") + F.col("all_expenses")).alias("combined_expenses")))


def r_02(wh) -> DataFrame:
    """Claims paid by claim type (the payments' own claim type)."""
    p = wh.silver("claim_payments")
    return _p(p.groupBy(F.coalesce("ClaimType", F.lit("Unknown")).alias("ClaimType"))
               .agg(K.money_sum("PaymentAmount").alias("claims_paid"), F.count(F.lit(1)).alias("payments")))


def r_03(wh) -> DataFrame:
    """Monthly claims cost."""
    p = wh.silver("claim_payments")
    return _p(p.groupBy(F.date_format("PaymentDate", "yyyy-MM").alias("month"))
               .agg(K.money_sum("PaymentAmount").alias("claims_paid")))


def _by(wh, dim, attr, cols):
    return _p(star.rollup(wh, dim, [attr], cols))


def r_04(wh):
    return _by(wh, "address", "City", ["claims_paid", "claims"])


def _claim_type_stats(wh) -> DataFrame:
    """Per claim type: paid (payments), claims (distinct claims paid)."""
    cp = wh.silver("claim_payments")
    per_claim = cp.groupBy(F.coalesce("ClaimType", F.lit("Unknown")).alias("ClaimType"), "ClaimID") \
                  .agg(F.sum("PaymentAmount").alias("paid"))
    return per_claim.groupBy("ClaimType").agg(K.money_sum("paid").alias("claims_paid"),
                                              F.count(F.lit(1)).alias("claims"))


def r_05(wh):
    """Loss ratio by claim type: type's paid over the portfolio's net premium."""
    t = wh.silver("premium_transactions").agg(K.money_sum("NetPremium").alias("_net"))
    s = _claim_type_stats(wh).crossJoin(t)
    return _p(s.select("ClaimType", "claims_paid", K.ratio("claims_paid", "_net").alias("loss_ratio")))


def r_06(wh):
    """Claims frequency by claim type: claims of the type per policy."""
    t = wh.silver("policy").agg(F.count(F.lit(1)).alias("_pol"))
    c = wh.silver("claims").groupBy(F.coalesce("ClaimType", F.lit("Unknown")).alias("ClaimType")) \
          .agg(F.count(F.lit(1)).alias("claims"))
    return _p(c.crossJoin(t).select("ClaimType", "claims", K.ratio("claims", "_pol").alias("claims_frequency")))


def r_07(wh):
    s = _claim_type_stats(wh)
    return _p(s.select("ClaimType", "claims_paid", "claims", K.ratio("claims_paid", "claims").alias("avg_claim_cost")))


def r_08(wh):
    return _by(wh, "broker", "Channel", ["claims_paid", "claims"])


def r_09(wh):
    return _by(wh, "address", "PropertyType", ["claims_paid", "claims"])


def r_10(wh):
    return _by(wh, "address", "PropertyType", ["active_policies", "policies"])


def r_11(wh):
    """Average rebuild cost by property type (address grain)."""
    a = wh.silver("address")
    return _p(a.groupBy(F.coalesce("PropertyType", F.lit("Unknown")).alias("PropertyType")).agg(
        K.money_sum("RebuildCostEstimate").alias("total_rebuild"),
        F.count("RebuildCostEstimate").alias("addresses"),
        K.ratio(F.sum("RebuildCostEstimate"), F.count("RebuildCostEstimate")).alias("avg_rebuild")))


def r_12(wh):
    return _by(wh, "broker", "Channel", ["net_premium", "gross_premium"])


def r_13(wh):
    return _by(wh, "address", "PropertyType", ["net_premium"])


def r_14(wh):
    return _by(wh, "address", "PropertyType", ["claims_paid", "claims", "avg_claim_cost"])


def r_15(wh):
    return _by(wh, "address", "PropertyType", ["net_premium", "claims_paid", "loss_ratio"])


def r_16(wh):
    return _by(wh, "broker", "Channel", ["claims", "policies", "claims_frequency"])


def r_17(wh):
    return _by(wh, "broker", "Channel", ["net_premium", "claims_paid", "loss_ratio"])


def r_18(wh):
    return _by(wh, "broker", "Channel", ["claims", "policies", "claims_per_1000"])


def r_19(wh, k: int = TOP_REGIONS):
    """Top-k regions by loss ratio (O-TOPK-REGION); ties broken by name."""
    r = star.rollup(wh, "address", ["Region"], ["net_premium", "claims_paid", "loss_ratio"])
    return _p(r.orderBy(F.col("loss_ratio").desc_nulls_last(), F.col("Region")).limit(k))


def r_20(wh):
    return _by(wh, "address", "Region", ["claims", "policies", "claims_frequency"])


def r_21(wh):
    return _by(wh, "address", "Region", ["claims_paid", "claims", "avg_claim_cost"])


def r_22(wh):
    return _by(wh, "address", "Region", ["net_premium", "loss_ratio"])


def r_23(wh):
    """Claims by cost band (A-BAND over per-claim paid)."""
    c = star.claim_paid(wh).filter(F.col("ClaimPaid").isNotNull())
    return _p(c.groupBy(K.cost_band("ClaimPaid").alias("cost_band"))
               .agg(F.count(F.lit(1)).alias("claims"), K.money_sum("ClaimPaid").alias("claims_paid")))


def r_24(wh):
    """Average claim cost by severity band."""
    cp = wh.silver("claim_payments")
    per = cp.groupBy(F.coalesce("ClaimSeverityBand", F.lit("Unknown")).alias("Severity"), "ClaimID") \
            .agg(F.sum("PaymentAmount").alias("paid"))
    return _p(per.groupBy("Severity").agg(
        K.money_sum("paid").alias("claims_paid"), F.count(F.lit(1)).alias("claims"),
        K.ratio(F.sum("paid"), F.count(F.lit(1))).alias("avg_claim_cost")))


def r_25(wh):
    return _by(wh, "address", "PropertyAgeBand", ["claims", "policies", "claims_per_1000"])


def r_26(wh):
    """Broker league table: premium, contribution to total, loss ratio."""
    b = star.rollup(wh, "broker", ["Broker"], ["policies", "net_premium", "claims_paid", "loss_ratio"])
    total = b.agg(F.sum("net_premium").alias("_total"))          # one row, broadcast
    return _p(b.crossJoin(F.broadcast(total)).select(
        "Broker", "policies", "net_premium", "claims_paid", "loss_ratio",
        K.ratio("net_premium", "_total").alias("premium_share")))


def monthly(wh) -> DataFrame:
    """Premium, claims paid and ratio-relevant expenses per month; rows whose
    date is unknown form one row with a NULL month, so the columns add up to
    the portfolio.  One union and one grouping."""
    cols = ("net_premium", "claims_paid", "expenses")

    def side(df, month, **amount):
        return df.select(month.alias("m"), *[amount.get(c, F.lit(None)).cast("decimal(28,2)").alias(c) for c in cols])
    exp = wh.gold.expense_lines.filter(F.col("ImpactsExpenseRatioFlag") == 1)
    u = (side(wh.silver("premium_transactions"), F.trunc("TransactionDate", "month"), net_premium=F.col("NetPremium"))
         .unionByName(side(wh.silver("claim_payments"), F.trunc("PaymentDate", "month"), claims_paid=F.col("PaymentAmount")))
         .unionByName(side(exp, F.trunc("ExpenseMonth", "month"), expenses=F.col("ExpenseAmount"))))
    return u.groupBy("m").agg(*[K.money_sum(c).alias(c) for c in cols])


def r_27(wh):
    """Monthly premium, claims, loss and combined ratio with MoM / YoY (W-TREND);
    what has no date is the month 'Unknown'."""
    m = with_prior_periods(monthly(wh), [], "m", ["net_premium", "claims_paid"])
    return _p(m.select(
        F.coalesce(F.date_format("m", "yyyy-MM"), F.lit("Unknown")).alias("month"), "net_premium", "claims_paid", "expenses",
        K.ratio("claims_paid", "net_premium").alias("loss_ratio"),
        (K.ratio("claims_paid", "net_premium") + K.ratio("expenses", "net_premium")).alias("combined_ratio"),
        F.col("net_premium_prev_month"), F.col("net_premium_prev_year"),
        F.col("claims_paid_prev_month"), F.col("claims_paid_prev_year"),
        K.ratio(F.col("net_premium") - F.col("net_premium_prev_month"), "net_premium_prev_month").alias("premium_mom"),
        K.ratio(F.col("net_premium") - F.col("net_premium_prev_year"), "net_premium_prev_year").alias("premium_yoy")))


def r_28(wh):
    """Claims by region over time (loss month)."""
    c = (wh.gold.fact_claim.groupBy("PolicyID", F.date_format("LossDate", "yyyy-MM").alias("month"))
         .agg(F.count(F.lit(1)).alias("_n")))            # one row per policy and month before the joins
    pol = wh.silver("policy").select("PolicyID", "AddressID")
    a = star.address_dim(wh).select("_dk", "Region")
    j = c.join(pol, "PolicyID", "left").join(a, F.col("AddressID") == F.col("_dk"), "left")
    return _p(j.groupBy(F.coalesce("Region", F.lit("Unknown")).alias("Region"), "month")
               .agg(F.sum("_n").alias("claims")))


def r_28_high_risk(wh):
    """High-risk policies over time (inception month)."""
    hr = wh.silver("policy_risk").filter(F.col("AdjustedRiskBand").isin(*K.HIGH_RISK_BANDS)) \
           .select("PolicyID").distinct()
    pol = wh.silver("policy").select("PolicyID", F.date_format("InceptionDate", "yyyy-MM").alias("month"))
    return _p(hr.join(pol, "PolicyID", "left").groupBy("month").agg(F.count(F.lit(1)).alias("high_risk_policies")))


def r_29(wh):
    f = wh.gold.expense_lines
    return _p(f.groupBy("ExpenseCategory", F.date_format("ExpenseMonth", "yyyy-MM").alias("month"))
               .agg(K.money_sum("ExpenseAmount").alias("expenses")))


def r_30(wh):
    """Reserves by movement type: count, change, age, outstanding on latest snapshot."""
    r = wh.silver("claim_reserves")
    lt = star.latest_reserves(wh).groupBy(F.coalesce("ReserveMovementType", F.lit("Unknown")).alias("mt")) \
             .agg(K.money_sum("ReserveAmount").alias("outstanding_latest"))
    a = r.groupBy(F.coalesce("ReserveMovementType", F.lit("Unknown")).alias("ReserveMovementType")).agg(
        F.count(F.lit(1)).alias("reserves"), K.money_sum("ReserveChange").alias("total_change"),
        K.ratio(F.sum("ReserveAgeMonths"), F.count("ReserveAgeMonths")).alias("avg_age_months"))
    j = a.join(lt, F.col("ReserveMovementType") == F.col("mt"), "left").drop("mt")
    return _p(j.withColumn("outstanding_latest", F.coalesce("outstanding_latest", F.lit(0).cast("decimal(18,2)"))))


REPORTS = {f"r_{i:02d}": globals()[f"r_{i:02d}"] for i in range(1, 31)}
REPORTS["r_28_high_risk"] = r_28_high_risk
