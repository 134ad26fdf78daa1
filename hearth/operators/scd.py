"""Unknown members and the type-1 upsert (SURVEY SRC-LITERAL, SNK-MERGE1, H-7, H-9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearth.operators.keys import assign_key
from hearth.sources.files import staged


def unknown_member(spark: SparkSession, schema: StructType, overrides: Mapping[str, object]) -> DataFrame:
    """One literal row: ``overrides`` where given, NULL elsewhere (typed)."""
    cols = []
    for f in schema.fields:
        v = overrides.get(f.name)
        cols.append((F.lit(v) if v is not None else F.lit(None)).cast(f.dataType).alias(f.name))
    return spark.range(1).select(*cols)


def with_unknown(dim: DataFrame, overrides: Mapping[str, object]) -> DataFrame:
    """Append the unknown member (key -1 by convention) to a dimension."""
    return dim.unionByName(unknown_member(dim.sparkSession, dim.schema, overrides))


def _changed(tracked: Sequence[str]):
    cond = F.lit(False)
    for c in tracked:
        cond = cond | ~F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
    return cond


def top_key(dim: DataFrame, key_col: str) -> DataFrame:
    """One row: the greatest surrogate key so far as ``_top``, 0 when only unknown members exist."""
    return dim.agg(F.greatest(F.coalesce(F.max(key_col), F.lit(0)), F.lit(0)).cast("bigint").alias("_top"))


def scd1_merge(target: DataFrame, source: DataFrame, key: str, tracked: Sequence[str],
               key_col: str, now: datetime, load_col: str = "GoldLoadDts") -> DataFrame:
    """Type-1 upsert on plain files: returns the new full image of ``target``.

    * key in both and any tracked column differs (NULL-safe) -> source values, new stamp
    * key in both, nothing changed -> target row untouched
    * key only in source -> inserted with surrogate ``max(existing, 0)+1..``, so a
      dimension holding only the unknown member (-1) starts at 1
    * key only in target -> kept
    Existing surrogate keys never change.  A load writes the result into its
    own store, next to the previous one it read (``build_store``).
    """
    t, s = target.alias("t"), source.alias("s")
    joined = s.join(t, F.col(f"s.{key}") == F.col(f"t.{key}"), "full_outer")
    data_cols = [c for c in target.columns if c not in (key_col, load_col)]
    in_s, in_t = F.col(f"s.{key}").isNotNull(), F.col(f"t.{key}").isNotNull()
    upd = in_s & in_t & _changed(tracked)
    take_source = (in_s & ~in_t) | upd
    merged = joined.select(
        F.col(f"t.{key_col}").cast("bigint").alias(key_col),
        *[F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in data_cols],
        F.when(take_source, F.lit(now).cast("timestamp")).otherwise(F.col(f"t.{load_col}")).alias(load_col),
    )
    merged = staged(merged, "merged")      # joined once, read by both branches; the new members alone are numbered
    existing = merged.filter(F.col(key_col).isNotNull())
    new = merged.filter(F.col(key_col).isNull()).drop(key_col)
    numbered = assign_key(new, [key], "_k").crossJoin(F.broadcast(top_key(target, key_col)))
    numbered = numbered.withColumn(key_col, F.col("_k") + F.col("_top")).drop("_k", "_top")
    return existing.unionByName(numbered.select(*existing.columns))
