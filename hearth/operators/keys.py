"""Key resolution and dense surrogate keys.

``assign_key`` numbers rows 1..N in business-key order without a global
window (which would pull every row into one task): rows are range
partitioned on the order columns, sorted inside each partition, tagged with
their position, and each partition adds the row count of all partitions
before it.  The per-partition counts table has one row per partition, so
its size is bounded by the partition count, not by the data.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.clean import composite_key
from hearth.sources.files import staged


def _norm(name: str) -> str:
    return re.sub(r"[\s_]", "", name).lower()


def resolve_key(columns: Sequence[str], ranked: Sequence[str],
                composite: Sequence[str] | None = None) -> list[str]:
    """P-22: pick the best key column from a ranked candidate list.

    Names compare case-, space- and underscore-insensitively.  Falls back to
    the ``composite`` columns when all of them exist, else raises.  Works on
    column names only; no data is touched.
    """
    by_norm = {_norm(c): c for c in columns}
    for cand in ranked:
        hit = by_norm.get(_norm(cand))
        if hit is not None:
            return [hit]
    if composite:
        hits = [by_norm.get(_norm(c)) for c in composite]
        if all(h is not None for h in hits):
            return hits  # type: ignore[return-value]
    raise ValueError(f"no key column among {list(ranked)} (composite {composite}) in {list(columns)}")


def key_expr(keys: Sequence[str], sep: str = "|") -> Column:
    """A single text key: the column itself, or P-23 for composites."""
    return F.col(keys[0]) if len(keys) == 1 else composite_key(*keys, sep=sep)


def assign_key(df: DataFrame, order_cols: Sequence[str | Column], name: str, start: int = 1,
               num_partitions: int | None = None) -> DataFrame:
    """Dense ``bigint`` key ``start..start+N-1`` following ``order_cols``.

    The tagged rows are written as a Parquet table under the reliable
    checkpoint folder: range bounds come from a sample, so counts and rows must
    read one and the same partitioning, also after an executor is lost.  The
    counts read one column of it.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    tagged = (df.repartitionByRange(n, *cols)
                .sortWithinPartitions(*cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = staged(tagged, "numbered")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a tiny single-task window, bounded by n
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_off") + pos + F.lit(start).cast("bigint"))
                  .drop("_pid", "_mid", "_off"))
