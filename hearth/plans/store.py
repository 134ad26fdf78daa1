"""Load every layer once and write it (SNK-OVERWRITE / SNK-CTAS, E-02).

``build_store`` writes the bronze tables of all twelve entities, one
classified table per silver entity (good and reject rows in folders of their
own, plus the reference-grain variants), then every gold dimension and fact,
into ``store``.  Each layer is derived from the *written* layer before it, so
nothing is computed twice.  Rows are counted on the way (``Dataset.observe``)
and the counts are a small table of the store.  The premium fact is laid out by year and month (E-02), so
period filters prune folders; the rows behind the policy grain lie in sorted
buckets of PolicyID.  ``store`` must be shared storage on a cluster;
``default_store`` places it under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hearth.operators.buckets import write_colocated
from hearth.operators.quality import VERDICT
from hearth.plans import bronze as B
from hearth.plans import star
from hearth.plans.model import Warehouse
from hearth.session import ensure_checkpoint_dir
from hearth.sources.files import write_table

ENTITIES = ("address", "broker", "claim_payments", "claim_reserves", "claims", "coverage", "customer", "date",
            "operating_expenses", "policy", "policy_risk", "premium_transactions")
REFERENCE_GRAIN = ("coverage", "policy_risk")
GOLD_TABLES = ("dim_address", "dim_broker", "dim_coverage", "dim_customers", "dim_date", "expense_categories",
               "dim_expense_category", "expense_lines", "dim_policy", "dim_policy_risk", "dim_claim_type",
               "dim_claim_status", "fact_claim", "fact_claim_payments", "fact_claim_reserves",
               "fact_premium_transactions", "fact_operating_expenses", "fact_policy_coverage")
POLICY_LINES = "gold/policy_lines"       # E-02: one exchange at load time, none on PolicyID in the reports
PARTITIONED = {"fact_premium_transactions": ("Year", "Month")}


def default_store(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location the session names."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/hearth-store/{name}"


def _observed(df: DataFrame, counts: list, *cols) -> DataFrame:
    """``df`` with its rows counted by the job that writes it; ``counts`` gets the observation."""
    seen = Observation()
    counts.append(seen)
    return df.observe(seen, *(cols or [F.count(F.lit(1)).alias("rows")]))


def _write_all(jobs: list[tuple], workers: int) -> None:
    """Run independent writes as concurrent Spark jobs (one thread each):
    small tables no longer leave cores idle while their job starts."""
    if workers <= 1:
        for df, path, parts in jobs:
            write_table(df, path, partition_by=parts)
        return
    with ThreadPoolExecutor(max_workers=workers) as pool:
        for f in [pool.submit(write_table, df, path, parts) for df, path, parts in jobs]:
            f.result()


def build_store(spark: SparkSession, sf_dir: str, store: str, workers: int = 4,
                **kw) -> tuple[Warehouse, dict[str, float]]:
    """Write bronze, then silver from the written bronze (one write per entity
    serves the good and the reject output), then gold from the written silver.
    Each layer is derived once; every later step starts from a written table
    (lineage cut, restartable per layer).  Writes within a layer are
    independent and run ``workers`` at a time."""
    timings: dict[str, float] = {}
    counts: list[tuple[str, str, int]] = []
    src = Warehouse(spark, sf_dir, **kw)
    t = time.perf_counter()
    jobs, raw, bronze = [], [], []
    for e in ENTITIES:
        jobs.append((_observed(B.bronze(_observed(src.raw(e), raw), e, src.now), bronze), f"{store}/bronze/{e}", ()))
    _write_all(jobs, workers)
    for e, r, b in zip(ENTITIES, raw, bronze, strict=True):
        counts += [("raw", e, r.get["rows"]), ("bronze", e, b.get["rows"])]
    timings["bronze"] = time.perf_counter() - t
    t = time.perf_counter()
    from_bronze = Warehouse(spark, sf_dir, store=store, stored=("bronze",), **kw)
    jobs, names, seen = [], [], []
    for e in ENTITIES:
        for g in ("declared", "reference") if e in REFERENCE_GRAIN else ("declared",):
            c = from_bronze.classified(e, g)
            names.append(e if g == "declared" else f"{e}__{g}")
            jobs.append((_observed(c.rows, seen, *c.counts()), f"{store}/silver/{names[-1]}", (VERDICT,)))
    _write_all(jobs, workers)
    for name, s in zip(names, seen, strict=True):
        counts += [("silver", name, s.get["silver"]), ("reject", name, s.get["reject"])]
    timings["silver"] = time.perf_counter() - t
    t = time.perf_counter()
    mid = Warehouse(spark, sf_dir, store=store, stored=("bronze", "silver"), **kw)
    # building the frames runs the (eager) key numbering in order; the writes then run concurrently
    seen = []
    frames = [(_observed(getattr(mid.gold, name), seen), f"{store}/gold/{name}", PARTITIONED.get(name, ())) for name in GOLD_TABLES]
    _write_all(frames, workers)
    write_colocated(star.policy_lines(mid), f"{store}/{POLICY_LINES}", "PolicyID", ("side", "PolicyID"))
    counts += [("gold", name, s.get["rows"]) for name, s in zip(GOLD_TABLES, seen, strict=True)]
    write_table(spark.createDataFrame(counts, "layer string, entity string, rows bigint").coalesce(1), f"{store}/counts")
    timings["gold"] = time.perf_counter() - t
    return Warehouse(spark, sf_dir, store=store, **kw), timings
