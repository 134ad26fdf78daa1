"""KPI queries: one small result per measure.

Each query evaluates only the pieces it needs (Catalyst prunes the rest),
returns one row (or one row per broker/channel for K-24/K-26), and follows
the output convention of ``present``.  Earned premium defaults to net
premium (the published figures equate them, H-5); the pro-rata variant is
K-03 with ``mode='prorata'``, which reports the premium of policies without
a known term next to what is earned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions import kpi as K
from hearth.operators.selection import grouped_median
from hearth.plans import star
from hearth.plans.model import present
from hearth.sources.files import staged


def _prem(wh) -> DataFrame:
    return wh.silver("premium_transactions")


def _one(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.crossJoin(f)   # single-row aggregates only
    return out


def net_premium(wh):
    return _prem(wh).agg(K.money_sum("NetPremium").alias("net_premium"))


def claims_paid(wh):
    return wh.silver("claim_payments").agg(K.money_sum("PaymentAmount").alias("claims_paid"))


def outstanding(wh):
    return star.latest_reserves(wh).agg(K.money_sum("ReserveAmount").alias("outstanding_reserves"))


def expenses(wh, impacting=True):
    e = star.expenses(wh, impacting)
    return e if impacting else e.withColumnRenamed("expenses", "all_expenses")


def policy_counts(wh):
    p = wh.silver("policy")
    # silver policy is one row per PolicyID: its rows are its unique policies
    return p.agg(F.count(F.lit(1)).alias("policies"), F.count("PolicyID").alias("unique_policies"),
                 F.count_if(F.col("PolicyStatus") == star.ACTIVE_STATUS).alias("active_policies"),
                 F.countDistinct("BrokerID").alias("unique_brokers"))


def claim_count(wh):
    return wh.silver("claims").agg(F.count("ClaimID").alias("claims"))      # one row per ClaimID


def k_01(wh):
    return present(net_premium(wh).withColumnRenamed("net_premium", "total_net_premium"))


def k_02(wh):
    return present(_prem(wh).agg(K.money_sum("GrossPremium").alias("written_premium")))


def k_03(wh, mode: str = "net"):
    if mode == "net":
        return present(net_premium(wh).withColumnRenamed("net_premium", "earned_premium"))
    pol = wh.silver("policy").select("PolicyID", "InceptionDate", "ExpiryDate")
    # premium summed per policy first, so a policy with many transactions joins
    # as one row; amount x elapsed days is summed exactly per term length and
    # divided once per term, so nothing is rounded per policy
    per_pol = _prem(wh).groupBy("PolicyID").agg(F.sum("NetPremium").alias("net"))
    term = F.datediff("ExpiryDate", "InceptionDate")
    elapsed = F.least(F.greatest(F.datediff(F.lit(wh.as_of).cast("date"), F.col("InceptionDate")), F.lit(0)), F.col("term"))
    by_term = (per_pol.join(pol, "PolicyID", "left").withColumn("term", F.when(term > 0, term))
                      .groupBy("term").agg(F.sum(F.col("net") * F.when(F.col("term").isNull(), 1).otherwise(elapsed)).alias("weighted")))
    return present(by_term.agg(
        F.round(F.coalesce(F.sum(F.col("weighted").cast("double") / F.col("term")), F.lit(0.0)), 2).alias("earned_premium"),
        F.coalesce(F.sum(F.when(F.col("term").isNull(), F.col("weighted"))), F.lit(0)).cast("double")
         .alias("unknown_term_premium")))


def k_04(wh):
    return present(claims_paid(wh))


def k_05(wh):
    return present(outstanding(wh))


def k_06(wh):
    t = _one(claims_paid(wh), outstanding(wh))
    return present(t.select((F.col("claims_paid") + F.col("outstanding_reserves")).alias("incurred_claims")))


def k_07(wh, variant: str = "a"):
    """a: paid / net (default, reproduces the published figure); b: incurred /
    earned; c: paid / earned (earned = net in the default mode)."""
    t = _one(claims_paid(wh), net_premium(wh), outstanding(wh))
    num = {"a": F.col("claims_paid"), "b": F.col("claims_paid") + F.col("outstanding_reserves"),
           "c": F.col("claims_paid")}[variant]
    return present(t.select(K.ratio(num, "net_premium").alias("loss_ratio")))


def k_08(wh):
    t = _one(expenses(wh), net_premium(wh))
    return present(t.select(K.ratio("expenses", "net_premium").alias("expense_ratio")))


def k_09(wh):
    t = _one(claims_paid(wh), expenses(wh), net_premium(wh))
    return present(t.select((K.ratio("claims_paid", "net_premium") + K.ratio("expenses", "net_premium"))
                            .alias("combined_ratio")))


def k_10(wh):
    t = _one(net_premium(wh), claims_paid(wh), outstanding(wh), expenses(wh))
    return present(t.select((F.col("net_premium") - F.col("claims_paid") - F.col("outstanding_reserves")
                             - F.col("expenses")).alias("underwriting_profit")))


def k_11(wh):
    return present(policy_counts(wh).drop("unique_brokers"))


def k_12(wh):
    return present(policy_counts(wh).select("unique_brokers"))


def k_12_sketch(wh):
    """A-DCOUNT that can be merged: one sketch of the policies with premium per
    month is stored; the year's distinct policies are the union of its months'
    sketches, here next to the exact count (lgK 14: standard error 0.8 %)."""
    s = staged(wh.silver("premium_transactions").select(F.trunc("TransactionDate", "month").alias("month"), "PolicyID"), "policy-months")
    monthly = staged(s.groupBy("month").agg(F.hll_sketch_agg("PolicyID", 14).alias("sketch")), "policy-sketches")
    merged = monthly.groupBy(F.year("month").alias("_y")).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("_e"))
    exact = s.groupBy(F.year("month").alias("year")).agg(F.countDistinct("PolicyID").alias("policies"))
    near = F.abs(F.col("_e") - F.col("policies")) <= F.col("policies") * 0.04 + 1
    return present(exact.join(merged, F.col("year").eqNullSafe(F.col("_y"))).select("year", "policies", near.alias("sketch_within_4_percent")))


def k_13(wh):
    return present(claim_count(wh))


def k_14(wh):
    t = _one(claim_count(wh), policy_counts(wh))
    return present(t.select(K.per_thousand("claims", "policies").alias("claims_per_1000")))


def k_15(wh):
    t = _one(claim_count(wh), policy_counts(wh))
    return present(t.select(K.ratio("claims", "policies").alias("claims_frequency")))


def k_16(wh):
    t = _one(claims_paid(wh), claim_count(wh))
    return present(t.select(K.ratio("claims_paid", "claims").alias("avg_claim_cost")))


def k_17(wh):
    t = _one(claims_paid(wh), expenses(wh, False))
    return present(t.select((F.col("claims_paid") + F.col("all_expenses")).alias("combined_expenses")))


def k_18(wh):
    t = _one(claims_paid(wh), net_premium(wh)).select(K.ratio("claims_paid", "net_premium").alias("loss_ratio"))
    return present(t.select("loss_ratio", K.loss_ratio_band("loss_ratio").alias("loss_ratio_band"),
                            K.loss_ratio_colour("loss_ratio").alias("loss_ratio_colour")))


def k_19(wh):
    cr = k_09(wh)
    return cr.select("combined_ratio", K.combined_ratio_band("combined_ratio").alias("combined_ratio_band"))


def k_20(wh):
    high = (wh.silver("policy_risk").filter(F.col("AdjustedRiskBand").isin(*K.HIGH_RISK_BANDS))
              .agg(F.countDistinct("PolicyID").alias("high_risk_policies")))
    t = _one(high, policy_counts(wh).select("policies"))         # the share of the whole portfolio
    return present(t.select("high_risk_policies", K.ratio("high_risk_policies", "policies").alias("high_risk_share")))


def _per_claim(wh):
    return star.claim_paid(wh).filter(F.col("ClaimPaid").isNotNull())


def k_21(wh):
    return present(_per_claim(wh).agg(F.max("ClaimPaid").alias("largest_claim")))


def k_22(wh):
    return present(grouped_median(_per_claim(wh), "ClaimPaid").withColumnRenamed("median", "median_claim"))


def k_22_by_type(wh):
    """The median claim of every region and claim type, all found in the same passes."""
    claims = wh.silver("claims").select("ClaimID", "PolicyID", "ClaimType")
    policies = wh.silver("policy").select("PolicyID", "AddressID")
    regions = wh.silver("address").select("AddressID", "Region")
    c = (_per_claim(wh).select("ClaimID", "ClaimPaid").join(claims, "ClaimID", "left").join(policies, "PolicyID", "left")
         .join(regions, "AddressID", "left")
         .select(F.coalesce("Region", F.lit("Unknown")).alias("Region"), F.coalesce("ClaimType", F.lit("Unknown")).alias("ClaimType"), "ClaimPaid"))
    return present(grouped_median(c, "ClaimPaid", ["Region", "ClaimType"]).withColumnRenamed("median", "median_claim"))


def k_23(wh):
    c = _per_claim(wh)
    severe = F.col("ClaimPaid") > K.LARGE_CLAIM
    t = c.agg(F.count_if(severe).alias("severe_claims"), F.count(F.lit(1)).alias("_n"),
              K.money_sum(F.when(severe, F.col("ClaimPaid"))).alias("_sev"), K.money_sum("ClaimPaid").alias("_all"))
    return present(t.select("severe_claims", K.ratio("severe_claims", "_n").alias("severe_share"),
                            K.ratio("_sev", "_all").alias("severe_cost_share")))


def k_24(wh):
    return present(star.rollup(wh, "broker", ["Broker"], ["net_premium", "claims", "claims_paid", "loss_ratio"]))


def k_25(wh):
    t = policy_counts(wh)
    return present(t.select(K.ratio("policies", "unique_brokers").alias("policies_per_broker")))


def k_26(wh):
    r = star.rollup(wh, "broker", ["Channel"], ["net_premium"])
    total = r.agg(F.sum("net_premium").alias("_total"))
    return present(r.crossJoin(F.broadcast(total)).select("Channel", "net_premium",
                                                          K.ratio("net_premium", "_total").alias("premium_share")))


def k_27(wh):
    a = wh.silver("address")
    return present(a.agg(K.money_sum("RebuildCostEstimate").alias("total_rebuild"),
                         K.ratio(F.sum("RebuildCostEstimate"), F.count("RebuildCostEstimate")).alias("avg_rebuild")))


def k_28(wh):
    a = wh.silver("address").agg(F.sum("RebuildCostEstimate").alias("_rb"), F.count("RebuildCostEstimate").alias("_na"))
    t = _one(net_premium(wh), policy_counts(wh), a)
    avg_prem = K.ratio("net_premium", "policies")
    avg_rb = K.ratio("_rb", "_na")
    return present(t.select(avg_prem.alias("avg_premium"), F.try_divide(avg_prem, avg_rb).alias("premium_per_rebuild")))


def k_29(wh):
    f = wh.gold.fact_premium_transactions
    return f.agg(F.date_format(F.max("GoldLoadDts"), "yyyy-MM-dd HH:mm:ss").alias("last_refresh"))


KPIS = {f"k_{i:02d}": globals()[f"k_{i:02d}"] for i in range(1, 30)}
KPIS["k_03_prorata"] = lambda wh: k_03(wh, "prorata")
KPIS["k_22_by_type"] = k_22_by_type
KPIS["k_12_sketch"] = k_12_sketch
KPIS["k_07b"] = lambda wh: k_07(wh, "b")
KPIS["k_07c"] = lambda wh: k_07(wh, "c")
