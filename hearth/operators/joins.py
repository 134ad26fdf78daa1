"""Fact-to-dimension joins.

Broadcast is forced only for dimensions whose size is bounded by
construction (calendar, claim types, regions).  Everything else is left to
the planner: the static ``autoBroadcastJoinThreshold`` check on plan
statistics and AQE's runtime check on real shuffle sizes choose broadcast
when the side is small and fall back to a sort-merge/shuffled-hash join
when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Rows (a code and a key each) up to which a counted dimension is broadcast.
SMALL_DIMENSION = 100_000


def join_dim(fact: DataFrame, dim: DataFrame, fact_keys: Sequence[str], dim_keys: Sequence[str],
             how: str = "left", key_col: str | None = None, unknown: int = -1) -> DataFrame:
    """J-INNER / J-LEFT / J-LOOKUP.

    Keys compare after ``trim`` (SQL Server ignores trailing blanks, H-6).
    With ``key_col`` the dimension's surrogate is carried over and unmatched
    fact rows get ``unknown`` (-1).
    """
    d, cond = dim, None
    for fk, dk in zip(fact_keys, dim_keys):
        c = F.trim(fact[fk]) == F.trim(d[dk])
        cond = c if cond is None else cond & c
    out = fact.join(d, cond, how)
    if key_col is not None and how == "left":
        out = out.withColumn(key_col, F.coalesce(F.col(key_col), F.lit(unknown)))
    return out


def lookup_key(fact: DataFrame, dim: DataFrame, fact_key: Column, dim_key: str, key_col: str,
               unknown: int = -1, small: int = SMALL_DIMENSION) -> DataFrame:
    """J-LOOKUP: add the dimension surrogate for a computed fact key, -1 when absent.

    The dimension's rows are counted; up to ``small`` it is broadcast, so a
    fact with a handful of skewed codes is not shuffled on them, and beyond
    that the planner's shuffled join (with skew handling) takes over."""
    d = dim.select(F.col(dim_key).alias("_lk"), F.col(key_col))
    if d.count() <= small:
        d = F.broadcast(d)
    return (fact.join(d, fact_key == F.col("_lk"), "left").drop("_lk")
                .withColumn(key_col, F.coalesce(F.col(key_col), F.lit(unknown))))


def anti(left: DataFrame, right: DataFrame, on: Sequence[str] | Column) -> DataFrame:
    """J-ANTI / J-ANTI-EXPR / J-XCHECK: rows of ``left`` with no match (NOT EXISTS)."""
    return left.join(right, on, "left_anti")
