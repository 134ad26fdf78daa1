"""Property test: each Spark parser and its DuckDB twin agree on arbitrary
dirty text (the oracle is only as good as this agreement)."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearth.functions import clean as C
from hearth.oracle import sqlfn as S

NUMERIC_ALPHABET = "0123456789.,-+e £$\t"
DATE_ALPHABET = "0123456789/- T:"

numeric_text = st.lists(st.text(NUMERIC_ALPHABET, max_size=9), min_size=1, max_size=60)
date_text = st.lists(st.one_of(
    st.text(DATE_ALPHABET, max_size=12),
    st.builds(lambda d, m, y, sep: f"{d}{sep}{m}{sep}{y}", st.integers(0, 40), st.integers(0, 14),
              st.integers(1899, 2101), st.sampled_from("/-")),
    st.builds(lambda y, m, d: f"{y}-{m:02d}-{d:02d}", st.integers(1899, 2101), st.integers(0, 13), st.integers(0, 32)),
), min_size=1, max_size=60)

CASES = {
    "safe_decimal": (C.safe_decimal, S.safe_dec),
    "safe_int": (C.safe_int, S.safe_int),
    "money": (lambda c: C.money(c), lambda x: S.money(x)),
    "money_reserve": (lambda c: C.money(c, C.MONEY_CHARS_RESERVE), lambda x: S.money(x, C.MONEY_CHARS_RESERVE)),
    "flag01": (C.flag01, S.flag01),
    "year_month": (C.year_month, S.year_month),
}
DATE_CASES = {
    "uk": (lambda c: C.safe_date(c, C.UK), lambda x: S.date(x, C.UK)),
    "ordered": (lambda c: C.first_date(c, (C.UK, C.ISO, C.YMD_SLASH, C.DMY_DASH)),
                lambda x: S.first_date(x, (C.UK, C.ISO, C.YMD_SLASH, C.DMY_DASH))),
}


def _compare(spark, values, spark_fn, sql_fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r[0]: r[1] for r in df.select("i", spark_fn(F.col("x"))).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    exp = dict(con.execute(f"SELECT i, {sql_fn('x')} FROM t").fetchall())
    bad = [(values[i], got[i], exp[i]) for i in got if got[i] != exp[i]]
    assert not bad, bad[:5]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=numeric_text)
def test_numeric_twins(spark, values):
    for name, (sf, qf) in CASES.items():
        _compare(spark, values, sf, qf)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=date_text)
def test_date_twins(spark, values):
    for name, (sf, qf) in DATE_CASES.items():
        _compare(spark, values, sf, qf)
