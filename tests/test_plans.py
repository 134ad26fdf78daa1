"""Plan assertions: push-down, pruning, top-1 per key, bounded broadcasts."""

import __spark_entry__ as entry

SMOKE = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan_and_dedupe_is_partial(spark):
    p = plan(entry.queries()["s_03"](spark, SMOKE))
    assert "EqualTo(l_returnflag,R)" in p            # pushed into the parquet scan
    assert "WindowGroupLimit" in p                   # dedupe keeps one row per key before the shuffle
    assert "SortAggregate" not in p                  # and does not sort the payload to aggregate it


def test_trend_reads_each_fact_once(spark):
    p = plan(entry.queries()["r_27"](spark, SMOKE))
    assert "SortMergeJoin [_mi" not in p and p.count("Union") == 1


def test_column_pruning(spark):
    p = plan(entry.queries()["s_10"](spark, SMOKE))
    assert "o_orderkey" in p and "o_totalprice" not in p   # policy never reads the order amount


def test_calendar_join_is_broadcast(spark):
    p = plan(entry.queries()["f_04"](spark, SMOKE))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_rollups_read_only_what_their_measures_need(spark):
    q = entry.queries()
    assert "lineitem" not in plan(q["r_10"](spark, SMOKE))          # active policies by property type
    p = plan(q["r_13"](spark, SMOKE))                               # net premium: no claims, no payments
    assert "CL-" not in p and "PAY-" not in p


def test_totals_are_not_joined_or_grouped_by_policy(spark):
    q = entry.queries()
    for name in ("r_01", "r_05", "r_06"):
        p = plan(q[name](spark, SMOKE))
        assert "Join [PolicyID" not in p
        assert p.count("hashpartitioning(PolicyID") <= 1            # the dedupe of the raw policies


def test_coverage_lookup_is_broadcast_and_nothing_is_dealt_round_robin(spark):
    p = plan(entry.queries()["f_05"](spark, SMOKE))
    assert "BroadcastHashJoin" in p and "RoundRobin" not in p
    assert "RoundRobin" not in plan(entry.queries()["r_15"](spark, SMOKE))


def test_one_year_reads_only_its_folders(spark):
    p = plan(entry.queries()["e_02"](spark, SMOKE))
    assert "PartitionFilters: [isnotnull(Year" in p


def test_reports_add_up_to_the_totals(spark):
    q = entry.queries()
    r, k1, k4 = (q[n](spark, SMOKE) for n in ("r_27", "k_01", "k_04"))
    net, paid = r.selectExpr("sum(net_premium)", "sum(claims_paid)").first()
    assert abs(net - k1.first()[0]) < 0.01 and abs(paid - k4.first()[0]) < 0.01
    loaded = q["e_01"](spark, SMOKE).selectExpr("sum(rows)").first()[0]
    assert loaded == q["s_12"](spark, SMOKE).count()
