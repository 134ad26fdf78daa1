"""Upserts in key-hash buckets, signed-delta roll-ups, medians by selection, percentile ranks, one-pass integrity."""

from __future__ import annotations

import os
import random
import statistics
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from hearth.operators.buckets import BUCKET, bucketed, merge_buckets, read_buckets, touched, write_buckets
from hearth.operators.selection import grouped_median
from hearth.operators.windows import with_percent_rank
from hearth.plans.rollups import PremiumRollups

DAY = [datetime(2024, 1, d) for d in range(1, 6)]


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_merge_writes_only_the_buckets_of_changed_members(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "dim")
    target = spark.createDataFrame([(i + 1, f"K{i:02d}", "old", DAY[0]) for i in range(40)], "sk bigint, k string, v string, GoldLoadDts timestamp")
    write_buckets(target, path, ["k"], 16)
    before = files(path)
    feed = spark.createDataFrame([("K03", "new"), ("K05", "old"), ("K90", "x"), ("K80", "y")], "k string, v string")
    written = merge_buckets(path, target.schema, feed, "k", ["v"], "sk", DAY[1], buckets=16)
    assert written == touched(bucketed(feed.filter("k != 'K05'"), ["k"], 16))
    after = files(path)
    untouched = {f for f in before if int(f.split(f"{BUCKET}=")[1].split("/")[0]) not in written}
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    assert {f for f in after if f not in before} and not {f for f in before if f not in untouched and f in after}
    got = {r["k"]: (r["sk"], r["v"], r["GoldLoadDts"]) for r in read_buckets(spark, path, target.schema).collect()}
    assert len(got) == 42 and got["K03"] == (4, "new", DAY[1]) and got["K05"] == (6, "old", DAY[0])
    assert got["K80"][:2] == (41, "y") and got["K90"][:2] == (42, "x")          # after the greatest, in key order
    plan = read_buckets(spark, path, target.schema, [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{BUCKET}" in plan or "PartitionFilters: [isnotnull" in plan
    assert merge_buckets(path, target.schema, feed, "k", ["v"], "sk", DAY[2], buckets=16) == []     # nothing new: nothing written
    assert files(path) == after


PREMIUMS = "PremiumTransactionID string, PolicyID string, TransactionDate date, NetPremium decimal(18,2), LoadDts timestamp"


def premiums(spark, rows):
    return spark.createDataFrame([(i, p, None if d is None else datetime.strptime(d, "%Y-%m-%d").date(), None if v is None else Decimal(v), t)
                                  for i, p, d, v, t in rows], PREMIUMS)


def test_rollups_by_signed_deltas(spark, tmpdir_path):
    policies = spark.createDataFrame([("P1", "B1"), ("P2", "B2"), ("P3", None)], "PolicyID string, BrokerID string")
    path = os.path.join(tmpdir_path, "rollups")
    r = PremiumRollups(spark, path, premiums(spark, []).schema, buckets=8)
    feeds = [
        [("a", "P1", "2024-01-05", "10.00", DAY[0]), ("b", "P2", "2024-01-06", "20.00", DAY[0]), ("c", "P3", None, "5.50", DAY[0]),
         ("d", "P1", "2024-02-01", "7.00", DAY[0])],
        # a: other amount; b: other month and policy; d comes again with its old time and another amount: not taken
        [("a", "P1", "2024-01-05", "11.25", DAY[1]), ("b", "P1", "2024-02-06", "20.00", DAY[1]), ("d", "P1", "2024-02-01", "99.00", DAY[0]),
         ("e", "P9", "2024-01-01", "1.00", DAY[1]), ("e", "P9", "2024-01-01", "2.00", DAY[2])],
        # c is dated now, e goes to a known policy, a late row without an amount
        [("c", "P3", "2023-12-31", "5.50", DAY[3]), ("e", "P2", "2024-01-01", "2.00", DAY[3]), ("f", None, None, None, None)]]
    state = {}
    owner = {"P1": "B1", "P2": "B2"}
    for n, rows in enumerate(feeds, 1):
        buckets = r.load(n, premiums(spark, rows), policies)
        mark = max([t for *_, t in state.values() if t], default=None)
        newest = {}
        for row in rows:
            if (mark is None or row[4] is None or row[4] > mark) and (row[0] not in newest or row[4] > newest[row[0]][4]):
                newest[row[0]] = row
        state |= newest
        assert len(buckets) <= len(newest)
        want = {}
        for _, policy, day, amount, _ in state.values():
            for key in (("month", (day or "Unknown")[:7]), ("broker", owner.get(policy, "Unknown"))):
                count, total = want.get(key, (0, Decimal(0)))
                want[key] = count + 1, total + Decimal(amount or 0)
        assert {(s["grain"], s["key"]): (s["rows"], s["net_premium"]) for s in r.sums(n).collect()} == want
        assert r.fact().count() == len(state)


def test_later_loads_read_the_touched_buckets_only(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "rollups")
    r = PremiumRollups(spark, path, premiums(spark, []).schema, buckets=16)
    policies = spark.createDataFrame([("P1", "B1")], "PolicyID string, BrokerID string")
    r.load(1, premiums(spark, [(f"t{i}", "P1", "2024-01-05", "1.00", DAY[0]) for i in range(60)]), policies)
    before = files(os.path.join(path, "fact"))
    feed = premiums(spark, [("t7", "P1", "2024-01-05", "3.00", DAY[1])])
    plan = r.replaced(r.changes(2, feed))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{BUCKET}" in plan or "PartitionFilters: [isnotnull" in plan
    assert len(r.load(2, feed, policies)) == 1
    after = files(os.path.join(path, "fact"))
    assert len({f for f in before if after.get(f) != before[f]}) == 1
    assert {(s["grain"], s["rows"], s["net_premium"]) for s in r.sums(2).collect()} == {("month", 60, Decimal("62.00")), ("broker", 60, Decimal("62.00"))}
    assert r.load(3, feed, policies) == [] and r.sums(3).count() == 2      # the same feed again changes nothing


def test_median_by_selection(spark):
    """Hot values, negative ones, null groups, odd and even counts, wide ranges; no sort of the values."""
    rng = random.Random(3)
    groups = {"a": [rng.randint(-10**7, 10**9) / 100 for _ in range(301)] + [5.0] * 400, "b": [1.25, 3.5], "c": [7.0],
              None: [rng.randint(0, 10**14) / 100 for _ in range(50)], "d": [2.0] * 9}
    rows = [(g, None if v is None else Decimal(f"{v:.2f}")) for g, vs in groups.items() for v in [*vs, None]] + [("e", None)]
    df = spark.createDataFrame(rows, "g string, x decimal(20,2)")
    got = {r["g"]: r["median"] for r in grouped_median(df, "x", ["g"], bins=64).collect()}
    want = {g: float(statistics.median([Decimal(f"{v:.2f}") for v in vs])) for g, vs in groups.items()}
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-6 for g in want)
    whole = [Decimal(f"{v:.2f}") for vs in groups.values() for v in vs]
    assert abs(grouped_median(df, "x").first()[0] - float(statistics.median(whole))) < 1e-6
    assert [r[0] for r in grouped_median(df.limit(0), "x").collect()] == [None] and grouped_median(df.limit(0), "x", ["g"]).collect() == []


def test_percent_rank_equals_the_window(spark):
    from pyspark.sql import Window
    rng = random.Random(4)
    df = spark.createDataFrame([(i, rng.choice([None, 1.0, 2.5, -3.0, float(rng.randint(0, 50))])) for i in range(300)] + [(999, 1e9)], "id int, x double")
    want = {r["id"]: r["p"] for r in df.withColumn("p", F.percent_rank().over(Window.orderBy(F.col("x").asc_nulls_first()))).collect()}
    assert {r["id"]: r["p"] for r in with_percent_rank(df, "x", "p", 5).collect()} == want
    assert [r["p"] for r in with_percent_rank(df.limit(1), "x", "p").collect()] == [0.0]
    assert with_percent_rank(df.limit(0), "x", "p").collect() == []


def test_integrity_in_one_exchange(spark):
    from hearth.plans.audits import v_22
    from hearth.plans.model import Warehouse

    plan = v_22(Warehouse(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(relation#") == 2 and "LeftAnti" not in plan     # by key, then by relation
