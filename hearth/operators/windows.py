"""Ordered window helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.sources.files import staged


def with_lag(df: DataFrame, partition: Sequence[str], order: Sequence[str], col: str, n: int = 1,
             out: str | None = None) -> DataFrame:
    """Previous value ``n`` rows back within each partition (W-LAG)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(out or f"{col}_lag{n}", F.lag(col, n).over(w))


def month_index(c) -> F.Column:
    """Months since year 0, so 'same month last year' is index - 12 even
    when months are missing (W-TREND)."""
    return F.year(c) * 12 + F.month(c) - 1


def with_prior_periods(df: DataFrame, partition: Sequence[str], month_col: str, cols: Sequence[str]) -> DataFrame:
    """Month-on-month and year-on-year values by calendar position.

    ``df`` has one row per month (and partition).  A ``RANGE`` frame on the
    month index looks exactly one and twelve months back, so gaps in the
    series do not shift the comparison month, the aggregate is computed once and
    nothing is joined.  A row without a month has no prior ones.  Without a
    partition the window's one task holds as many rows as there are months."""
    at = Window.partitionBy(*partition).orderBy("_mi")
    base = df.withColumn("_mi", month_index(F.col(month_col)))
    back = {f"{c}_prev_{name}": F.when(F.col("_mi").isNotNull(), F.first(c).over(at.rangeBetween(-n, -n)))
            for n, name in ((1, "month"), (12, "year")) for c in cols}
    return base.withColumns(back).drop("_mi")


def with_percent_rank(df: DataFrame, col: str, out: str, num_partitions: int | None = None) -> DataFrame:
    """SQL's ``percent_rank() OVER (ORDER BY col NULLS FIRST)``, exact and without a global window.

    Values are counted first, so ties (and a hot value) are one row.  The
    distinct values are range partitioned; a value's rank is the number of rows
    in the ranges before its own plus a running sum inside its range.  A single
    row ranks 0.  ``df`` is read twice: pass a written or small table."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = staged(df.groupBy(F.col(col).alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
                      .repartitionByRange(n, "_x").withColumn("_pid", F.spark_partition_id()), "ranks")
    # one row per range: a tiny single-task window, bounded by n
    ranges = counts.groupBy("_pid").agg(F.sum("_c").alias("_n"))
    before = ranges.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    total = counts.agg(F.sum("_c").alias("_total"))
    inside = F.sum("_c").over(Window.partitionBy("_pid").orderBy("_x")) - F.col("_c")
    share = F.coalesce(F.try_divide((F.col("_off") + F.col("_in")).cast("double"), (F.col("_total") - 1).cast("double")), F.lit(0.0))
    ranks = (counts.withColumn("_in", inside).join(F.broadcast(before), "_pid").crossJoin(F.broadcast(total))
                   .select("_x", share.alias(out)))
    return df.join(ranks, F.col(col).eqNullSafe(F.col("_x")), "left").drop("_x")
