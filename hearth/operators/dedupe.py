"""Keep the newest row per key.

A top-1 window: the planner puts a group limit below the exchange, so every map
task keeps its own winner of a key and a hot key costs one row per map task
on the wire.  Rows are sorted by key and load time; the other columns are
looked at only where those are equal.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOAD_TIME = "BronzeLoadDts"


def latest(df: DataFrame, keys: Sequence[str], first: Sequence[str] | None = None,
           asked: Collection[str] | None = None) -> DataFrame:
    """W-LATEST / -TIE / -COMP / -EXPR: one row per key, newest first.

    Rows compare by ``first`` (the load timestamp if omitted and present),
    then by every other column, greatest first and NULL last, so the winner
    is fully determined by the data (the reference picks arbitrarily, H-3).

    ``asked`` names the columns that will be read of the result.  The columns
    behind the last of them decide only between rows that agree in all that is
    read, so they are not compared, and neither sorted nor shuffled.  If nothing
    but keys is asked for, any row of a key will do: keys are grouped by hash,
    per map task first, without a sort.
    """
    if first is None:
        first = [LOAD_TIME] if LOAD_TIME in df.columns else []
    rest = [c for c in df.columns if c not in keys and c not in first]
    if asked is not None:
        if not set(asked) & {*first, *rest}:
            return df.dropDuplicates(list(keys))
        rest = rest[:max((i for i, c in enumerate(rest, 1) if c in asked), default=0)]
    order = [F.col(c).desc_nulls_last() for c in (*first, *rest)] or [F.lit(0)]
    newest = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") == 1).drop("_n")
