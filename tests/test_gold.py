"""Gold-layer invariants: unknown members, incremental dimension, incremental load."""

from datetime import date, datetime

from pyspark.sql import functions as F

from hearth.plans.gold import dim_coverage_from
from hearth.plans.incremental import incremental_load
from hearth.plans.model import Warehouse

SMOKE = "/root/testdata/sf0.001"


def test_dimensions_have_unique_keys_and_unknown_member(spark):
    g = Warehouse(spark, SMOKE).gold
    for dim, key in (("dim_address", "AddressKey"), ("dim_broker", "BrokerKey"), ("dim_coverage", "CoverageKey")):
        df = getattr(g, dim)
        n, distinct = df.count(), df.select(key).distinct().count()
        assert n == distinct
        assert df.filter(F.col(key) == -1).count() == 1


def test_fact_lookup_defaults_to_unknown(spark):
    g = Warehouse(spark, SMOKE).gold
    f = g.fact_policy_coverage
    blanks = f.filter(F.col("CoverageType").isNull()).count()
    assert f.filter(F.col("CoverageKey") == -1).count() >= blanks


def test_incremental_dimension_keeps_keys(spark):
    s = spark.createDataFrame([("P1", "Contents"), ("P2", " buildings ")], "PolicyID string, CoverageType string")
    now = datetime(2024, 1, 1)
    first = dim_coverage_from(s, now)
    more = s.unionByName(spark.createDataFrame([("P3", "Flood")], "PolicyID string, CoverageType string"))
    second = dim_coverage_from(more, now, current=first)
    k1 = {r["CoverageType"]: r["CoverageKey"] for r in first.collect()}
    k2 = {r["CoverageType"]: r["CoverageKey"] for r in second.collect()}
    assert all(k2[t] == k for t, k in k1.items())                 # existing keys unchanged
    assert k2["FLOOD"] == max(k1.values()) + 1                     # new member numbered after max


def test_incremental_load_upserts_after_high_water_mark(spark):
    t = spark.createDataFrame([("a", date(2024, 1, 1), 1), ("b", date(2024, 1, 2), 2)], "k string, d date, v int")
    feed = spark.createDataFrame([("b", date(2024, 1, 1), 99), ("b", date(2024, 1, 3), 3), ("c", date(2024, 1, 4), 4),
                                  ("d", None, 5)], "k string, d date, v int")
    out = {r["k"]: r["v"] for r in incremental_load(t, feed, ["k"], "d").collect()}
    assert out == {"a": 1, "b": 3, "c": 4, "d": 5}        # a row without a load time is new
