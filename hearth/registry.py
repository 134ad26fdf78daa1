"""Every registered query: ``QUERIES[id](spark, sf_dir) -> DataFrame`` and its
DuckDB twin ``ORACLE[id]``.  IDs follow SURVEY §2 (lower case, '-' -> '_').

Each callable builds a fresh ``Warehouse`` over ``sf_dir`` (reading the
supplied parquet tables) and returns the DataFrame unevaluated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hearth.plans.model import Warehouse, present

# Fixed order of the entities, as numbered in SURVEY §2.9 (B-xx / S-xx).
ENTITIES = ("address", "broker", "claim_payments", "claim_reserves", "claims", "coverage", "customer", "date",
            "operating_expenses", "policy", "policy_risk", "premium_transactions")
DIMS = ("dim_address", "dim_broker", "dim_coverage", "dim_customers", "dim_date", "dim_expense_category",
        "dim_policy", "dim_policy_risk", "dim_claim_type", "dim_claim_status")
FACTS = ("fact_claim", "fact_claim_payments", "fact_claim_reserves", "fact_operating_expenses",
         "fact_policy_coverage", "fact_premium_transactions")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _wh_query(fn) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Warehouse(spark, sf_dir))
    return q


def _register() -> None:
    from hearth.oracle import audits_sql, gold_sql, kpi_sql, operators_sql, reports_sql, silver_sql
    from hearth.oracle import sqlfn as S
    from hearth.plans import audits, kpis, operators_q, reports
    from hearth.plans.gold import rich_calendar

    # bronze B-01..B-12
    for i, e in enumerate(ENTITIES, 1):
        QUERIES[f"b_{i:02d}"] = _wh_query(lambda wh, e=e: present(wh.bronze(e)))
        if e == "policy":
            sql = silver_sql.build("SELECT * EXCLUDE (SourceLine), SourceLine AS BronzeRowID, "
                                   "'PolicyCSV' AS SourceSystem FROM raw_policy", "raw_policy")
        elif e in ("policy_risk", "premium_transactions"):
            d, b = silver_sql.PRESENT[e]
            sql = silver_sql.build(S.present(f"bronze_{e}", d, b), f"bronze_{e}")
        else:
            sql = silver_sql.build(f"SELECT * FROM raw_{e}", f"raw_{e}")
        ORACLE[f"b_{i:02d}"] = sql

    # silver S-01..S-12 and their rejects; reference grain for S-06 / S-11
    for i, e in enumerate(ENTITIES, 1):
        QUERIES[f"s_{i:02d}"] = _wh_query(lambda wh, e=e: present(wh.silver(e)))
        ORACLE[f"s_{i:02d}"] = silver_sql.silver_query(e, "silver")
        QUERIES[f"s_{i:02d}_reject"] = _wh_query(lambda wh, e=e: present(wh.rejects(e)))
        ORACLE[f"s_{i:02d}_reject"] = silver_sql.silver_query(e, "reject")
    for i, e in ((6, "coverage"), (11, "policy_risk")):
        QUERIES[f"s_{i:02d}_ref_grain"] = _wh_query(lambda wh, e=e: present(wh.silver(e, "reference")))
        d, b = silver_sql.PRESENT[f"{e}_ref"]
        ORACLE[f"s_{i:02d}_ref_grain"] = silver_sql.build(S.present(f"silver_{e}_ref", d, b), f"silver_{e}_ref")

    # gold D-01..D-10, D-11, F-01..F-06
    for i, n in enumerate(DIMS, 1):
        QUERIES[f"d_{i:02d}"] = _wh_query(lambda wh, n=n: present(getattr(wh.gold, n)))
        ORACLE[f"d_{i:02d}"] = gold_sql.gold_query(n)
    QUERIES["d_05_fixed_range"] = _wh_query(lambda wh: present(wh.gold.fixed_calendar))
    ORACLE["d_05_fixed_range"] = gold_sql.gold_query("fixed_calendar")
    QUERIES["d_11"] = _wh_query(lambda wh: present(rich_calendar(wh.gold)))
    ORACLE["d_11"] = gold_sql.rich_calendar_sql()
    for i, n in enumerate(FACTS, 1):
        QUERIES[f"f_{i:02d}"] = _wh_query(lambda wh, n=n: present(getattr(wh.gold, n)))
        ORACLE[f"f_{i:02d}"] = gold_sql.gold_query(n)

    for name, fn in {**reports.REPORTS, **kpis.KPIS, **audits.AUDITS, **operators_q.OPERATORS}.items():
        QUERIES[name] = _wh_query(fn)
    ORACLE.update(reports_sql.REPORT_SQL)
    ORACLE.update(kpi_sql.KPI_SQL)
    ORACLE.update(audits_sql.AUDIT_SQL)
    ORACLE.update(operators_sql.OPERATOR_SQL)


_register()

# Queries with no SQL twin on purpose (iterative model / streaming): the driver
# records a rows-only check for them.
NO_ORACLE = sorted(set(QUERIES) - set(ORACLE))
