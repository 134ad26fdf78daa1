"""Measure evaluation over the star.

Facts are aggregated to the policy grain *before* any dimension join, so
a policy with many premiums, claims and payments cannot fan out and the
joins carry one row per policy.  Report roll-ups aggregate the policy grain
once more to the dimension's key (one row per address or broker) before
joining the dimension, so the join input shrinks to the dimension's size.
All aggregations combine map-side (partial sums), which also bounds what a
hot key (one policy with a third of the rows) sends through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions import kpi as K
from hearth.operators.dedupe import latest
from hearth.operators.keys import assign_key

ACTIVE_STATUS = "Active"


def claim_paid(wh) -> DataFrame:
    """Per-claim paid amount (A-2LEVEL first level), from the payments' ClaimID."""
    return (wh.silver("claim_payments").groupBy("ClaimID")
              .agg(F.sum("PaymentAmount").alias("ClaimPaid"), F.count(F.lit(1)).alias("payments")))


def claims_with_paid(wh) -> DataFrame:
    """Claim grain: every claim and every paid ClaimID (full join), so claim
    counts and payments whose claim is unknown (NULL policy) both survive."""
    claims = wh.silver("claims", columns=("ClaimID", "PolicyID")).withColumn("is_claim", F.lit(1))
    return claims.join(claim_paid(wh).select("ClaimID", "ClaimPaid"), "ClaimID", "full")


_GRAIN_COLS = {"AddressID": "string", "BrokerID": "string", "PolicyStatus": "string",
               "is_policy": "int", "net": "decimal(28,2)", "gross": "decimal(28,2)", "paid": "decimal(38,2)",
               "n_claims": "bigint"}
POLICY_COLUMNS = ("PolicyID", "AddressID", "BrokerID", "PolicyStatus")      # read of silver policy
# What each measure is made of; a roll-up reads the inputs of its measures only.
_INPUTS = {"policies": (), "active_policies": (), "net_premium": ("net",), "gross_premium": ("gross",),
           "claims_paid": ("paid",), "claims": ("n_claims",), "loss_ratio": ("paid", "net"),
           "claims_frequency": ("n_claims",), "avg_claim_cost": ("paid", "n_claims"), "claims_per_1000": ("n_claims",)}
MEASURES = tuple(_INPUTS)


def inputs_of(measures: Sequence[str]) -> set[str]:
    return {i for m in measures for i in _INPUTS[m]}


def _side(df: DataFrame, **cols) -> DataFrame:
    """One input of the policy-grain union: its own columns, NULL elsewhere."""
    return df.select("PolicyID", *[(cols[c] if c in cols else F.lit(None)).cast(t).alias(c)
                                   for c, t in _GRAIN_COLS.items()])


def _claim_side(wh, needed: set[str]) -> DataFrame:
    if needed == {"n_claims"}:
        return _side(wh.silver("claims", columns=("ClaimID", "PolicyID")), n_claims=F.lit(1))
    if needed == {"paid"}:
        owner = wh.silver("claims", columns=("ClaimID", "PolicyID"))
        return _side(claim_paid(wh).join(owner, "ClaimID", "left"), paid=F.col("ClaimPaid"))
    return _side(claims_with_paid(wh), paid=F.col("ClaimPaid"), n_claims=F.col("is_claim"))


def policy_grain(wh, measures: Sequence[str] = MEASURES) -> DataFrame:
    """J-MERGED: one row per policy with what ``measures`` need.

    The premium rows and the claim rows, only if a measure needs them, are
    united and summed by PolicyID: amounts alone, so the sums are hash
    aggregates, pre-aggregated map-side and shuffled once.  Silver policy is one
    row per policy and lies by PolicyID already; the sums meet it in a full
    join, so amounts of unknown policies (and of none) stay."""
    needed = inputs_of(measures)
    lines = wh.policy_lines()
    if lines is not None and needed:
        return _grain(_stored_lines(lines, needed))
    pol = wh.silver("policy", columns=POLICY_COLUMNS).withColumn("is_policy", F.lit(1))
    if not needed:
        return _side(pol, **{c: F.col(c) for c in (*POLICY_COLUMNS[1:], "is_policy")})
    sides = []
    if needed & {"net", "gross"}:
        amounts = {c: n for c, n in (("net", "NetPremium"), ("gross", "GrossPremium")) if c in needed}
        premiums = wh.silver("premium_transactions", columns=("PolicyID", *amounts.values()))
        sides.append(_side(premiums, **{c: F.col(n) for c, n in amounts.items()}))
    if needed & {"paid", "n_claims"}:
        sides.append(_claim_side(wh, needed & {"paid", "n_claims"}))
    rows = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    sums = rows.groupBy("PolicyID").agg(*[
        F.sum(c).alias(c) if c in needed else F.lit(None).cast("bigint" if c == "n_claims" else "decimal(38,2)").alias(c)
        for c in ("net", "gross", "paid", "n_claims")])
    return pol.join(sums, "PolicyID", "full")


def policy_lines(wh) -> DataFrame:
    """What ``policy_grain`` adds up, to be stored in buckets of PolicyID: one
    row per policy and ``side`` (policy, premium, claim), so that a policy with
    a third of all premiums is still one row of a bucket.  ``has_payment`` tells
    whether a claim was paid on.  Rows without a policy share the NULL key."""
    pol, prem = wh.silver("policy"), wh.silver("premium_transactions")
    claims = (wh.silver("claims").select("ClaimID", "PolicyID", F.lit(1).alias("is_claim"))
                .join(claim_paid(wh), "ClaimID", "full"))
    sides = (
        ("policy", pol, {c: F.max(c) for c in ("AddressID", "BrokerID", "PolicyStatus")} | {"is_policy": F.max(F.lit(1))}),
        ("premium", prem, {"net": F.sum("NetPremium"), "gross": F.sum("GrossPremium")}),
        ("claim", claims, {"paid": F.sum("ClaimPaid"), "n_claims": F.sum("is_claim"), "has_payment": F.max(F.col("payments").isNotNull())}))
    types = _GRAIN_COLS | {"net": "decimal(38,2)", "gross": "decimal(38,2)", "has_payment": "boolean"}
    out = None
    for name, df, sums in sides:
        agg = df.groupBy("PolicyID").agg(*[c.alias(n) for n, c in sums.items()])
        rows = agg.select("PolicyID", F.lit(name).alias("side"),
                          *[(F.col(c) if c in sums else F.lit(None)).cast(t).alias(c) for c, t in types.items()])
        out = rows if out is None else out.unionByName(rows)
    return out


def _stored_lines(lines: DataFrame, needed: set[str]) -> DataFrame:
    """The stored rows that ``needed`` inputs are made of; buckets are sorted by side, so others are skipped."""
    keep = F.col("side") == "policy"
    if needed & {"net", "gross"}:
        keep = keep | (F.col("side") == "premium")
    if needed >= {"paid", "n_claims"}:
        keep = keep | (F.col("side") == "claim")
    elif "paid" in needed:
        keep = keep | ((F.col("side") == "claim") & F.col("has_payment"))
    elif "n_claims" in needed:
        keep = keep | ((F.col("side") == "claim") & F.col("n_claims").isNotNull())
    blank = [c for c in ("net", "gross", "paid", "n_claims") if c not in needed]
    return lines.where(keep).withColumns({c: F.lit(None).cast("decimal(38,2)" if c != "n_claims" else "bigint") for c in blank})


def _grain(u: DataFrame) -> DataFrame:
    return u.groupBy("PolicyID").agg(
        F.max("AddressID").alias("AddressID"), F.max("BrokerID").alias("BrokerID"),
        F.max("PolicyStatus").alias("PolicyStatus"), F.max("is_policy").alias("is_policy"),
        *[F.sum(c).alias(c) for c in ("net", "gross", "paid", "n_claims")])


def _partials(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count_if(F.col("is_policy") == 1).alias("policies"),
        F.count_if(F.col("PolicyStatus") == ACTIVE_STATUS).alias("active_policies"),
        F.sum("net").alias("net_premium"), F.sum("gross").alias("gross_premium"),
        F.sum("paid").alias("claims_paid"), F.sum("n_claims").alias("claims"))


def _finish(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    agg = df.groupBy(*keys).agg(
        F.sum("policies").alias("policies"), F.sum("active_policies").alias("active_policies"),
        K.money_sum("net_premium").alias("net_premium"), K.money_sum("gross_premium").alias("gross_premium"),
        K.money_sum("claims_paid").alias("claims_paid"),
        F.coalesce(F.sum("claims"), F.lit(0)).alias("claims"))
    return with_ratios(agg)


def with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "loss_ratio": K.ratio("claims_paid", "net_premium"),
        "claims_frequency": K.ratio("claims", "policies"),
        "avg_claim_cost": K.ratio("claims_paid", "claims"),
        "claims_per_1000": K.per_thousand("claims", "policies"),
    })


def address_dim(wh) -> DataFrame:
    a = wh.silver("address")
    return a.select(F.col("AddressID").alias("_dk"), "City", "Region", "PropertyType",
                    K.age_band("BuildYear").alias("PropertyAgeBand"), "PostcodeArea")


def broker_dim(wh) -> DataFrame:
    b = wh.silver("broker")
    return b.select(F.col("BrokerID").alias("_dk"), "Channel", "BrokerName", F.col("BrokerID").alias("Broker"))


def rollup(wh, dim: str, attrs: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    """``measures`` of the policies by dimension attributes (unmatched -> 'Unknown').

    Groups are those of the inputs read: policies, and the premiums, claims
    and payments that a measure asks for."""
    fk = "AddressID" if dim == "address" else "BrokerID"
    d = address_dim(wh) if dim == "address" else broker_dim(wh)
    pre = _partials(policy_grain(wh, measures), [fk])       # one row per address / broker
    j = pre.join(d.select("_dk", *attrs), pre[fk] == d["_dk"], "left")
    keys = [F.coalesce(F.col(a), F.lit("Unknown")).alias(a) for a in attrs]
    return _finish(j, keys).select(*attrs, *measures)


def totals(wh) -> DataFrame:
    """The portfolio totals in one row (K-01, K-04, K-11, K-13 ...): plain
    one-row aggregates of each table, no policy grain and no shuffle of rows."""
    pol = wh.silver("policy").agg(
        F.count(F.lit(1)).alias("policies"), F.count_if(F.col("PolicyStatus") == ACTIVE_STATUS).alias("active_policies"))
    prem = wh.silver("premium_transactions").agg(
        K.money_sum("NetPremium").alias("net_premium"), K.money_sum("GrossPremium").alias("gross_premium"))
    paid = wh.silver("claim_payments").agg(K.money_sum("PaymentAmount").alias("claims_paid"))
    clm = wh.silver("claims").agg(F.count(F.lit(1)).alias("claims"))
    return with_ratios(pol.crossJoin(prem).crossJoin(paid).crossJoin(clm))


def expenses(wh, impacting_only: bool = True) -> DataFrame:
    f = wh.gold.expense_lines
    if impacting_only:
        f = f.filter(F.col("ImpactsExpenseRatioFlag") == 1)
    return f.agg(K.money_sum("ExpenseAmount").alias("expenses"))


def latest_reserves(wh) -> DataFrame:
    """W-LATESTSNAP: newest snapshot per claim (ties broken by ReserveID)."""
    return latest(wh.silver("claim_reserves"), ["ClaimID"], ["SnapshotDate", "ReserveID"])


def exact_median(df: DataFrame, value: str, tiebreak: str) -> DataFrame:
    """A-MEDIAN, exact and distributed: values are numbered in order by
    range partitioning (``assign_key``), then the one or two middle rows are
    averaged.  No group is gathered into one task; a hot value is split
    across partitions by the tie-break column."""
    v = df.select(value, tiebreak).filter(F.col(value).isNotNull())
    n = v.agg(F.count(F.lit(1)).alias("_n"))
    pos = assign_key(v, [value, tiebreak], "_pos")
    mid = pos.crossJoin(F.broadcast(n)).filter(
        (F.col("_pos") == F.floor((F.col("_n") + 1) / 2)) | (F.col("_pos") == F.floor((F.col("_n") + 2) / 2)))
    return mid.agg(F.try_divide(F.sum(value).cast("double"), F.count(F.lit(1)).cast("double")).alias("median"))
