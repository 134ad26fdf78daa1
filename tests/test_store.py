"""The stored warehouse (bronze -> silver -> gold written once) answers the
same as the all-in-one plans computed from the raw tables."""

import os

from compare import compare  # noqa: F401  (same helper module as the oracle tests)

from hearth.plans import audits, kpis, reports
from hearth.plans.model import Warehouse
from hearth.plans.store import build_store

SMOKE = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_store_matches_raw_plans(spark, tmpdir_path):
    stored, timings = build_store(spark, SMOKE, os.path.join(tmpdir_path, "store"))
    assert set(timings) == {"bronze", "silver", "gold"}
    live = Warehouse(spark, SMOKE)
    for fn in (reports.r_01, reports.r_10, reports.r_13, reports.r_15, reports.r_16, reports.r_19, reports.r_23, reports.r_26, reports.r_27, kpis.k_22, kpis.k_05):
        assert _rows(fn(stored)) == _rows(fn(live)), fn.__name__
    parts = os.listdir(os.path.join(tmpdir_path, "store", "gold", "fact_premium_transactions"))
    assert any(p.startswith("Year=") for p in parts)            # E-02 layout
    # one table per entity serves both outputs, and the counts taken while writing are the counted ones
    live_counts = {(e, kind): df.count() for e in audits.ENTITIES
                   for kind, df in (("silver", live.silver(e)), ("reject", live.rejects(e)), ("bronze", live.bronze(e)))}
    seen = {(r["entity"], r["layer"]): r["rows"] for r in stored.counted().collect()}
    assert {k: seen[k] for k in live_counts} == live_counts
    assert not os.path.exists(os.path.join(tmpdir_path, "store", "reject"))
    assert {"Verdict=good", "Verdict=reject"} <= set(os.listdir(os.path.join(tmpdir_path, "store", "silver", "claim_payments")))
    for fn in (audits.v_01, audits.v_02, audits.v_21, audits.v_24):
        assert _rows(fn(stored)) == _rows(fn(live)), fn.__name__
    assert all("RejectLoadDts" in live.rejects(e).columns and "RejectLoadDts" in stored.rejects(e).columns for e in audits.ENTITIES)


def test_silver_is_written_by_one_job_per_entity(spark, tmpdir_path):
    """The write derives, de-duplicates and classifies once: one scan of the keyed rows, one window."""
    from hearth.plans.model import Warehouse as W
    for e in ("claim_payments", "claim_reserves", "policy", "address"):
        plan = W(spark, SMOKE).classified(e).rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Window [") == (0 if e == "claim_reserves" else 1), e


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_policy_grain_is_read_from_buckets(spark, tmpdir_path):
    """Over a store, r_15 exchanges nothing on PolicyID, also in a session whose catalog does not know the table."""
    from hearth.operators.buckets import _table_name
    from hearth.plans.star import MEASURES, policy_grain
    from hearth.plans.store import POLICY_LINES
    store = os.path.join(tmpdir_path, "store")
    stored, _ = build_store(spark, SMOKE, store)
    spark.sql(f"DROP TABLE {_table_name(f'{store}/{POLICY_LINES}')}")
    live = Warehouse(spark, SMOKE)
    assert "hashpartitioning(PolicyID" in _final_plan(reports.r_15(live))
    again = Warehouse(spark, SMOKE, store=store)
    plan = _final_plan(reports.r_15(again))
    assert "hashpartitioning(PolicyID" not in plan and "Bucketed: true" in plan
    for m in ([x] for x in MEASURES):
        assert _rows(policy_grain(again, m)) == _rows(policy_grain(live, m)), m
    assert _rows(policy_grain(again)) == _rows(policy_grain(live))
