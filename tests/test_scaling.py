"""Steps that must not repeat their work: parsers run once per row, silver is derived once per query."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hearth.operators.dedupe import latest
from hearth.plans import audits, kpis, model_claims, operators_q, star
from hearth.plans import silver as S
from hearth.plans.model import Warehouse
from hearth.plans.rollups import PremiumRollups
from hearth.sources import testviews

SMOKE = "/root/testdata/sf0.001"
NOW = datetime(2002, 1, 1)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_reserve_parsers_run_once_per_row(spark):
    """Five date formats and three amounts, for both snapshots of the source at once and not again in the verdict's filter."""
    plan = _plan(Warehouse(spark, SMOKE).silver("claim_reserves").select("ReserveAmount", "SnapshotDate"))
    assert plan.count("gettimestamp") == 5 and plan.count("RLIKE") == 8


def test_payment_parsers_run_once_per_row(spark):
    plan = _plan(Warehouse(spark, SMOKE).silver("claim_payments").select("PaymentAmount", "PaymentDate"))
    assert plan.count("gettimestamp") == 1 and plan.count("RLIKE") == 4


def test_policy_dates_are_parsed_once_per_row(spark):
    plan = _plan(Warehouse(spark, SMOKE).silver("policy").select("InceptionDate", "ExpiryDate"))
    assert plan.count("gettimestamp") == 6


@pytest.mark.parametrize(("amount", "day", "reason"), [
    ("£1,234.50", "05/01/2001", None), ("$7", "2001-1-5", None), ("1.0", " 05/01/2001 10:00", None),
    ("n/a", "45/13/2001", "SnapshotDate invalid/missing; ReserveAmount invalid/missing; "), (None, None, "SnapshotDate invalid/missing; ReserveAmount invalid/missing; ")])
def test_reserve_rows(spark, amount, day, reason):
    cols = "ReserveID ClaimID SnapshotDate ReserveAmount PreviousReserve ReserveChange ReserveStatus ReserveType ReserveMovementType LargeReserveFlag LatestSnapshotFlag SourceFile"
    df = spark.createDataFrame([(" R1 ", "C1", day, amount, "0.00", "0", "Open", None, "", "1", "x", "f.csv")],
                               ", ".join(f"{c} string" for c in cols.split())).withColumn("BronzeLoadDts", F.lit(NOW))
    c = S.silver_claim_reserves(df, NOW)
    good, reject = c.good.collect(), c.reject.collect()
    if reason is None:
        assert not reject and good[0]["ReserveID"] == "R1" and str(good[0]["SnapshotDate"]) == "2001-01-05"
    else:
        assert not good and reject[0]["RejectReason"] == reason and reject[0]["ReserveAmountRaw"] == amount and reject[0]["SnapshotDateRaw"] == day


def test_sketches_and_exact_counts_share_one_derivation(spark):
    assert "l_orderkey" not in _plan(kpis.k_12_sketch(Warehouse(spark, SMOKE)))


def test_rollup_loads_share_one_derivation(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(PremiumRollups, "load", lambda self, n, feed, policies: seen.extend([_plan(feed), _plan(policies)]))
    monkeypatch.setattr(PremiumRollups, "sums", lambda self, n: spark.range(1))
    operators_q.e_01_rollups(Warehouse(spark, SMOKE))
    assert len(seen) == 6 and not any("l_orderkey" in p or "o_orderkey" in p for p in seen)


def test_columns_behind_the_last_asked_do_not_decide(spark):
    """Ties, nulls and repeated rows: what is asked for is what the comparison of all columns gives."""
    rows = [("k1", "a", None, "z"), ("k1", "b", 1, "a"), ("k1", "b", 2, None), ("k2", None, 5, "x"), ("k2", None, 5, "x"),
            ("k3", "c", None, "q"), (None, "d", 1, "r"), (None, "d", 3, "s")]
    df = spark.createDataFrame(rows, "k string, a string, b int, c string")
    for asked in (["a"], ["b"], ["a", "b"], ["b", "c"], []):
        got = latest(df, ["k"], asked=asked).select("k", *asked).collect()
        want = latest(df, ["k"]).select("k", *asked).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want)), asked
    assert not [line for line in _plan(latest(df, ["k"], asked=["a"]).select("a")).splitlines() if "Window" in line and "c#" in line]


def test_keys_alone_are_grouped_without_a_sort(spark):
    df = spark.createDataFrame([("k1", "a"), ("k1", "b"), ("k2", None), (None, "c"), (None, "c")], "k string, a string")
    keys = latest(df, ["k"], asked=["k"]).select("k")
    assert sorted(map(repr, keys.collect())) == sorted(map(repr, latest(df, ["k"]).select("k").collect()))
    plan = keys._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in plan and "Window" not in plan and "Sort" not in plan


@pytest.mark.parametrize(("entity", "keys", "column"), [
    ("broker", ("BrokerID",), "Channel"), ("coverage", ("PolicyID", "CoverageType"), "CoverageTier"), ("customer", ("CustomerID",), "LastName"),
    ("claims", ("ClaimID",), "PolicyID"), ("policy", ("PolicyID",), "BrokerID")])
def test_asked_columns_of_repeated_and_missing_keys(spark, entity, keys, column):
    """Ties, blank and missing keys, a later load: keys and asked columns are those of the whole rows."""
    names = [n for n, _ in testviews.VIEWS[entity].cols if n != "SourceLine"]
    days = {"InceptionDate": ("2001-01-05", "2001-01-05", "2001-06-01"), "ExpiryDate": ("2002-01-05", "2001-01-01", "2002-06-01")}
    rows = [tuple(k if n in keys else days[n][i % 3] if n in days else v if n == column else f"x{i % 4}" for n in names) + (load,)
            for i, (k, v, load) in enumerate([("1", "a", NOW), ("1", "b", NOW), (" 1 ", "b", NOW), ("2", None, NOW), ("2", "z", datetime(2001, 1, 1)),
                                              ("", "c", NOW), (None, "c", NOW), ("3", "d", NOW), ("3", "d", NOW)])]
    extra = ", BronzeLoadDts timestamp"
    b = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names) + extra).withColumn("SourceFile", F.lit("f.csv"))
    b = b.withColumns({"SourceSystem": F.lit("s"), "BronzeRowID": F.lit(1).cast("bigint")}) if entity == "policy" else b
    whole = S.SILVER[entity](b, NOW)
    for asked in ((), keys, (*keys, column)):
        part, cols = S.SILVER[entity](b, NOW, asked=asked), asked or keys
        assert part.rows.schema.names == whole.rows.schema.names
        assert _rows(part.good.select(*cols)) == _rows(whole.good.select(*cols)), asked
        assert part.reject.count() == whole.reject.count(), asked


def test_reference_checks_carry_keys_only(spark):
    plan = _plan(audits.v_22(Warehouse(spark, SMOKE)))
    assert not [c for c in ("TransactionStatus", "LossDate", "PaymentPlan", "CoverageLimit", "CommissionModel") if c in plan]


@pytest.mark.parametrize("audit", [audits.v_01, audits.v_24])
def test_row_counts_carry_no_column_they_do_not_need(spark, audit):
    plan = _plan(audit(Warehouse(spark, SMOKE)))
    assert not [c for c in ("TransactionStatus", "LossDate", "PaymentPlan", "CoverageLimit", "CommissionModel", "LifeStageSegment",
                            "RiskDataCompletenessScore") if c in plan]


def test_counting_counts_what_the_whole_rows_count(spark):
    wh = Warehouse(spark, SMOKE)
    few, ones = wh.counting(), F.count(F.lit(1))
    for entity in ("broker", "claims", "coverage", "customer", "policy"):
        assert few.silver(entity).columns == wh.silver(entity).columns
        assert _rows(few.silver(entity).agg(ones)) == _rows(wh.silver(entity).agg(ones)), entity
        assert _rows(few.rejects(entity).agg(ones)) == _rows(wh.rejects(entity).agg(ones)), entity


def test_silver_columns_are_the_whole_table_s(spark):
    wh = Warehouse(spark, SMOKE)
    for entity, columns in (("premium_transactions", ("PolicyID", "NetPremium")), ("policy_risk", ("PolicyID", "AdjustedRiskBand")),
                            ("policy", ("PolicyID", "BrokerID", "ExpiryDate")), ("claims", ("ClaimID", "PolicyID")), ("broker", ("BrokerID", "Channel")),
                            ("coverage", ("PolicyID", "CoverageType")), ("coverage", ("CoverageLimit",)), ("customer", ("CustomerID", "Email")),
                            ("claims", ("ClaimID",)), ("broker", ("BrokerID",))):
        got, want = wh.silver(entity, columns=columns), wh.silver(entity).select(*columns)
        assert got.schema == want.schema and got.exceptAll(want).count() == 0 == want.exceptAll(got).count(), entity


def test_model_features_carry_no_column_they_do_not_need(spark):
    plan = _plan(model_claims.tree_features(Warehouse(spark, SMOKE)))
    assert not [c for c in ("TransactionStatus", "AdjustedRiskBand", "CreatedDate", "LossDate") if c in plan]


def test_broker_factors_carry_no_column_they_do_not_need(spark):
    plan = _plan(operators_q._broker_factors(Warehouse(spark, SMOKE)))
    assert not [c for c in ("TransactionStatus", "RiskDataCompletenessScore", "CreatedDate", "LossDate") if c in plan]


def test_policy_grain_sums_amounts_by_hash_and_sorts_no_wide_rows(spark):
    df = star.policy_grain(Warehouse(spark, SMOKE))
    assert "SortAggregate" not in df._jdf.queryExecution().sparkPlan().toString()


class _Silver:
    """A warehouse of given silver rows."""

    def __init__(self, **tables):
        self.tables = tables

    def silver(self, entity, columns=None):
        return self.tables[entity].select(*columns) if columns else self.tables[entity]

    def policy_lines(self):
        return None


def test_policy_grain_keeps_amounts_of_unknown_policies(spark):
    money = "decimal(18,2)"
    wh = _Silver(
        policy=spark.createDataFrame([("P1", "A1", "B1", "Active"), ("P2", None, None, None), ("P3", "A1", "B2", "Lapsed")],
                                     "PolicyID string, AddressID string, BrokerID string, PolicyStatus string"),
        premium_transactions=spark.sql(f"""SELECT PolicyID, cast(g AS {money}) AS GrossPremium, cast(n AS {money}) AS NetPremium
            FROM VALUES ('P1', 3, 1), ('P1', 3, 1), ('P9', 5, NULL), (NULL, 2, 2) AS t(PolicyID, g, n)"""),
        claims=spark.createDataFrame([("C1", "P1"), ("C2", "P1"), ("C3", None), ("C4", "P3")], "ClaimID string, PolicyID string"),
        claim_payments=spark.sql(f"SELECT ClaimID, cast(a AS {money}) AS PaymentAmount FROM VALUES ('C1', 4), ('C1', 4), ('C7', 9) AS t(ClaimID, a)"))
    rows = lambda *m: sorted((tuple(r) for r in star.policy_grain(wh, *m).collect()), key=repr)
    num = lambda r: tuple(int(x) if x is not None and not isinstance(x, str) else x for x in r)
    assert [num(r) for r in rows()] == sorted([
        ("P1", "A1", "B1", "Active", 1, 2, 6, 8, 2), ("P2", None, None, None, 1, None, None, None, None),
        ("P3", "A1", "B2", "Lapsed", 1, None, None, None, 1), ("P9", None, None, None, None, None, 5, None, None),
        (None, None, None, None, None, 2, 2, 9, 1)], key=repr)
    assert [num(r) for r in rows(["net_premium"])] == sorted([
        ("P1", "A1", "B1", "Active", 1, 2, None, None, None), ("P2", None, None, None, 1, None, None, None, None),
        ("P3", "A1", "B2", "Lapsed", 1, None, None, None, None), ("P9", None, None, None, None, None, None, None, None),
        (None, None, None, None, None, 2, None, None, None)], key=repr)
