"""Tables in key-hash buckets, upserted in place (SNK-MERGE1, E-01).

A table is laid out by ``Bucket``, a hash of its key, as folders.  A load reads
only the buckets that its feed touches and writes only those in which a row
really changes (dynamic partition overwrite); every other file stays as it is.
The new image of a bucket is written to a staging folder first, so the
overwrite reads nothing it replaces and can be repeated.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from hearth.operators.keys import assign_key
from hearth.operators.scd import top_key
from hearth.sources.files import staged

BUCKET = "Bucket"
BUCKETS = 64


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` with the bucket of each row's key."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def touched(rows: DataFrame) -> list[int]:
    """The buckets of ``rows``: at most as many numbers as there are buckets."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """A first load: the whole table, one task per bucket."""
    _write(bucketed(df, keys, buckets), path, "static")


def _write(df: DataFrame, path: str, mode: str) -> None:
    (df.repartition(F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", mode)
       .partitionBy(BUCKET).parquet(path))


def read_buckets(spark: SparkSession, path: str, schema: StructType, which: Sequence[int] | None = None) -> DataFrame:
    """The table, or only the folders of some buckets.  ``schema`` is the rows' without the bucket."""
    full = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
    df = spark.read.schema(full).parquet(path)
    return df if which is None else df.filter(F.col(BUCKET).isin(list(which)))


def replace_rows(path: str, schema: StructType, rows: DataFrame, keys: Sequence[str]) -> list[int]:
    """Rows with a bucket take the place of those of the same key, or are added; returns the buckets written.

    ``rows`` is read more than once: pass a written table."""
    dirty = touched(rows)
    if dirty:
        old = read_buckets(rows.sparkSession, path, schema, dirty)
        kept = old.join(rows.select(*keys), list(keys), "left_anti")
        image = staged(kept.select(old.columns).unionByName(rows.select(old.columns)), "bucket-image")
        _write(image, path, "dynamic")
    return dirty


def merge_buckets(path: str, schema: StructType, source: DataFrame, key: str, tracked: Sequence[str], key_col: str,
                  now: datetime, load_col: str = "GoldLoadDts", buckets: int = BUCKETS) -> list[int]:
    """SNK-MERGE1 in place: the type-1 upsert of ``scd1_merge`` on a bucketed dimension.

    Members whose tracked columns differ (NULL-safe) take the source's values
    and the new stamp; unknown ones are added with surrogates after the
    greatest, in key order; all others, and every file of a bucket without
    such a member, stay untouched.  Only new members are numbered.  Returns
    the buckets written.
    """
    spark = source.sparkSession
    feed = staged(bucketed(source, [key], buckets), "feed")
    known = read_buckets(spark, path, schema, touched(feed)).select(key, key_col, *[F.col(c).alias(f"_t_{c}") for c in tracked])
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in tracked], F.lit(False))
    changed = staged(feed.join(known, key, "left").filter(F.col(key_col).isNull() | differs)
                         .select(*feed.columns, F.col(key_col).cast("bigint").alias(key_col)), "changes")
    new = assign_key(changed.filter(F.col(key_col).isNull()).select(key), [key], "_k")
    top = top_key(read_buckets(spark, path, schema).select(key_col), key_col)          # one column, one row
    new = new.crossJoin(F.broadcast(top)).select(key, (F.col("_k") + F.col("_top")).alias("_new"))
    rows = (changed.join(new, key, "left").withColumn(key_col, F.coalesce(F.col(key_col), F.col("_new")))
                   .withColumn(load_col, F.lit(now).cast("timestamp")).drop("_new"))
    return replace_rows(path, schema, staged(rows, "upsert"), [key])


# --------------------------------------------------------------------------
# Co-located tables: Spark's own buckets, so grouping by the key needs no exchange
# --------------------------------------------------------------------------

def _table_name(path: str) -> str:
    return f"hearth_{hashlib.md5(path.encode()).hexdigest()}"


def write_colocated(df: DataFrame, path: str, key: str, sort_by: Sequence[str], buckets: int | None = None) -> None:
    """E-02: ``df`` in ``buckets`` sorted buckets of ``key`` (one file each) under ``path``.

    ``buckets`` is the session's shuffle partitions unless given.  A bucket is
    read by one task, so ``df`` should hold a bounded number of rows for each key."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(*sort_by)
       .option("path", path).saveAsTable(_table_name(path)))
    layout = spark.createDataFrame([(key, list(sort_by), n, df.schema.json())],
                                   "key string, sort_by array<string>, buckets int, schema string")
    layout.coalesce(1).write.mode("overwrite").parquet(f"{path}__layout")


def colocated_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_colocated``; a session that did not write it enters it in its catalog first."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        at = spark.read.parquet(f"{path}__layout").first()          # one row
        cols = StructType.fromJson(json.loads(at["schema"])).toDDL()
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY (`{at['key']}`) "
                  f"SORTED BY ({', '.join(f'`{c}`' for c in at['sort_by'])}) INTO {at['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)
