"""Compare a Spark DataFrame with a DuckDB query over the same parquet tables.

Used by the tests and by hand while developing.  Columns are compared by
name (sorted), rows order-insensitively; floats are compared after rounding
to 9 significant digits, decimals as floats, dates as ISO text.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _kind(arrow_type) -> str:
    import pyarrow as pa
    if pa.types.is_integer(arrow_type):
        return f"int{arrow_type.bit_width}"
    if pa.types.is_floating(arrow_type):
        return "float"
    if pa.types.is_decimal(arrow_type):
        return "decimal"
    if pa.types.is_string(arrow_type) or pa.types.is_large_string(arrow_type):
        return "string"
    if pa.types.is_date(arrow_type):
        return "date"
    if pa.types.is_timestamp(arrow_type):
        return "timestamp"
    if pa.types.is_boolean(arrow_type):
        return "bool"
    return str(arrow_type)


def compare(spark_df, sql: str, con) -> dict:
    sa = spark_df.toArrow()
    da = con.sql(sql).arrow()
    if hasattr(da, "read_all"):
        da = da.read_all()
    res = {"spark_rows": sa.num_rows, "oracle_rows": da.num_rows}
    sc, dc = sorted(sa.column_names), sorted(da.column_names)
    res["columns_match"] = sc == dc
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sc, dc
        res["ok"] = False
        return res
    sk = {c: _kind(sa.schema.field(c).type) for c in sc}
    dk = {c: _kind(da.schema.field(c).type) for c in dc}
    res["schema_diff"] = {c: (sk[c], dk[c]) for c in sc if sk[c] != dk[c]}
    srows = sorted((tuple(_norm(v) for v in r) for r in zip(*[sa.column(c).to_pylist() for c in sc])),
                   key=repr)
    drows = sorted((tuple(_norm(v) for v in r) for r in zip(*[da.column(c).to_pylist() for c in dc])),
                   key=repr)
    res["values_match"] = srows == drows
    if not res["values_match"]:
        sset, dset = set(map(repr, srows)), set(map(repr, drows))
        res["only_spark"] = sorted(sset - dset)[:3]
        res["only_oracle"] = sorted(dset - sset)[:3]
    res["ok"] = res["values_match"] and sa.num_rows == da.num_rows and not res["schema_diff"]
    return res
