"""Raw files in, layer tables out."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hearth.session import ensure_checkpoint_dir

CORRUPT = "_corrupt_record"


def text_schema(columns: Sequence[str]) -> StructType:
    """Staging schema: every column nullable text, in file order."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_raw(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC-CSV / SRC-CSV-LF / SRC-BADROWS: headered UTF-8 CSV as all text.

    No quote handling (quote characters stay literal, like BULK INSERT with a
    plain field terminator); CRLF and LF row ends are both accepted, a stray
    CR left at the end of the last column is removed by the money/text
    cleaners.  A row with a wrong field count keeps its whole text in
    ``_corrupt_record`` (NULL for the others), so one classified pass serves
    the good and the bad rows (``split_malformed``).  Files split across
    tasks; nothing is collected.
    """
    return (spark.read.schema(StructType(schema.fields + [StructField(CORRUPT, StringType(), True)]))
            .option("header", True).option("quote", "").option("escape", "")
            .option("encoding", "UTF-8").option("mode", "PERMISSIVE")
            .option("columnPruning", False)        # a wrong field count shows only when all columns are parsed
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def split_malformed(classified: DataFrame, max_share: float | None = None) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` rows of a classified read; no row is lost.

    ``bad`` is the malformed rows' first field, text and reason, for the reject output.
    ``max_share`` (off by default) fails the load when a greater share of the
    rows is malformed, whatever the size of the input."""
    data = [c for c in classified.columns if c != CORRUPT]
    # always true, but a reader that prunes to the corrupt-record column alone refuses the query
    parsed = F.length(F.coalesce(F.col(data[0]), F.lit(""))) >= 0
    is_bad = F.col(CORRUPT).isNotNull() & parsed
    if max_share is not None:
        t = classified.agg(F.count_if(is_bad).alias("bad"), F.count(F.lit(1)).alias("rows"), F.count(data[0])).first()
        if t["bad"] > max_share * t["rows"]:
            raise ValueError(f"{t['bad']} of {t['rows']} rows are malformed (limit {max_share:.2%})")
    bad = classified.filter(is_bad).select(data[0], F.col(CORRUPT).alias("RawLine"),
                                           F.lit("Wrong number of fields").alias("RejectReason"))
    return classified.filter(~is_bad).select(*data), bad


def stamp(df: DataFrame, ts_col: str | None = None, now: datetime | None = None,
          source_file: str | Column | None = None, source_system: str | None = None) -> DataFrame:
    """SNK-STAMP-TS / -FILE / -SYS: load metadata.

    ``now`` is passed in (never ``current_timestamp()``) so reruns are
    reproducible.  Existing non-blank values are kept (set-where-null)."""
    out = df
    if ts_col is not None:
        out = out.withColumn(ts_col, F.lit(now).cast("timestamp"))
    if source_file is not None:
        sf = F.lit(source_file) if isinstance(source_file, str) else source_file
        cur = F.nullif(F.trim(F.col("SourceFile")), F.lit("")) if "SourceFile" in out.columns else F.lit(None)
        out = out.withColumn("SourceFile", F.coalesce(cur.cast("string"), sf))
    if source_system is not None:
        cur = F.nullif(F.trim(F.col("SourceSystem")), F.lit("")) if "SourceSystem" in out.columns else F.lit(None)
        out = out.withColumn("SourceSystem", F.coalesce(cur.cast("string"), F.lit(source_system)))
    return out


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """SNK-ADDCOL: add missing nullable columns (name -> type)."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """SNK-BYNAME / SNK-BYCAT / SNK-TRUNC / SNK-CLONE: the columns of ``schema``
    in its order and types, by name; absent ones as NULL, others left out (the
    catalogue is ``schema``; metadata only)."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                fmt: str = "parquet") -> None:
    """SNK-OVERWRITE / SNK-CTAS: full refresh of a layer table.

    ``partition_by`` (E-02) lays facts out by e.g. year/month so later
    filters prune whole folders."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a folder of its own under the shared checkpoint location, and read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/hearth-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
