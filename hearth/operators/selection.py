"""A-MEDIAN by distributed selection (no sort, no numbering of the values).

The middle values are found by histograms: each pass counts the values of the
range still in question in at most ``BINS`` equal bins (combined map-side),
picks the bin that holds the wanted rank and goes on inside it.  A range of R
units takes log(R) / log(BINS) passes; what a pass moves is bins, not values,
so one value with a third of the rows costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.sources.files import staged

BINS = 4096
#: Groups, two short rows each, up to which the state of the search is broadcast; beyond, it is joined.
SMALL_STATE = 100_000


def grouped_median(df: DataFrame, value: str, by: Sequence[str] = (), scale: int = 2, bins: int = BINS) -> DataFrame:
    """``by..., median``: the exact median of a decimal column of at most ``scale`` decimals, per group.

    Null values are left out; of an even number of values the two middle ones
    are averaged.  Null is a group of its own.  Without ``by``: one row (null
    if there is no value)."""
    unit = 10 ** scale
    groups = [f"_g{i}" for i in range(len(by))]
    v = staged(df.filter(F.col(value).isNotNull()).select(
        *[F.col(c).alias(g) for c, g in zip(by, groups, strict=True)],
        (F.col(value).cast(f"decimal(36,{scale})") * unit).cast("bigint").alias("_v")), "values")
    ranks = F.explode(F.array_distinct(F.array(F.expr("(n - 1) div 2"), F.expr("n div 2"))))
    state = (v.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
              .filter("n > 0").select(*groups, ranks.alias("rank"), "lo", "hi", F.lit(0).cast("bigint").alias("below")))
    while True:
        state = staged(state, "selection")
        seen = state.agg(F.max(F.col("hi") - F.col("lo")).alias("range"), F.count(F.lit(1)).alias("rows")).first()
        if not seen["range"]:
            break
        asked = state.withColumn("width", F.expr(f"(hi - lo) div {bins} + 1"))
        for g in groups:
            asked = asked.withColumnRenamed(g, f"s{g}")
        if seen["rows"] <= SMALL_STATE:
            asked = F.broadcast(asked)
        same = F.lit(True)
        for g in groups:
            same = same & F.col(g).eqNullSafe(F.col(f"s{g}"))
        keys = [*groups, "rank", "lo", "hi", "below", "width"]
        hist = (v.join(asked, same & (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
                 .groupBy(*keys, F.expr("(_v - lo) div width").alias("bin")).agg(F.count(F.lit(1)).alias("c")))
        upto = F.sum("c").over(Window.partitionBy(*groups, "rank").orderBy("bin"))
        state = (hist.withColumn("upto", F.col("below") + upto).filter("upto - c <= rank and rank < upto")
                     .select(*groups, "rank", F.expr("lo + bin * width").alias("lo"),
                             F.expr("least(hi, lo + (bin + 1) * width - 1)").alias("hi"), F.expr("upto - c").alias("below")))
    total = (F.sum("lo").cast("decimal(38,0)") / F.lit(unit)).cast(f"decimal(38,{scale})").cast("double")
    out = state.groupBy(*groups).agg(F.try_divide(total, F.count(F.lit(1)).cast("double")).alias("median"))
    return out.select(*[F.col(g).alias(c) for c, g in zip(by, groups, strict=True)], "median")
