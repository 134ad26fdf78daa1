"""DuckDB spellings of the cleaning functions (twins of hearth.functions.clean)."""

from __future__ import annotations

from collections.abc import Sequence

from hearth.functions import clean as C

FMT = {C.UK: "%d/%m/%Y", C.ISO: "%Y-%m-%d", C.YMD_SLASH: "%Y/%m/%d", C.DMY_DASH: "%d-%m-%Y",
       "yyyyMMdd": "%Y%m%d", C.ISO_TIME: "%Y-%m-%d %H:%M:%S"}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def b2n(x: str) -> str:
    return f"NULLIF(trim({x}, ' '), '')"


def default_text(x: str, d: str = C.UNKNOWN_TEXT) -> str:
    return f"coalesce({b2n(x)}, {q(d)})"


def safe_dec(x: str, p: int = 18, s: int = 2) -> str:
    return f"CASE WHEN regexp_matches({x}, {q(C.NUMERIC_RE)}) THEN TRY_CAST(trim({x}, ' ') AS DECIMAL({p},{s})) END"


def safe_int(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, {q(C.INTEGER_RE)}) THEN TRY_CAST(trim({x}, ' ') AS INTEGER) END"


def money(x: str, chars: str = C.MONEY_CHARS_ADDRESS) -> str:
    return safe_dec(f"regexp_replace({x}, {q(chars)}, '', 'g')")


def date(x: str, fmt: str = C.UK) -> str:
    return f"TRY_CAST(try_strptime(trim({x}, ' '), {q(FMT[fmt])}) AS DATE)"


def first_date(x: str, fmts: Sequence[str]) -> str:
    return "coalesce(" + ", ".join(date(x, f) for f in fmts) + ")"


def date_text_prefix(x: str, width: int = 10) -> str:
    return f"left(trim(replace({x}, chr(160), ' '), ' '), {width})"


def date_text_iso(x: str) -> str:
    plain = f"trim(replace(replace(replace({x}, chr(160), ' '), '\"', ''), 'T', ' '), ' ')"
    return f"regexp_replace({plain}, '(:[0-9]+)[.][0-9]+$', '\\1')"


def flag01(x: str) -> str:
    t = ", ".join(q(v) for v in C.FLAG_TRUE)
    f = ", ".join(q(v) for v in C.FLAG_FALSE)
    return f"CASE WHEN upper(trim({x}, ' ')) IN ({t}) THEN 1 WHEN upper(trim({x}, ' ')) IN ({f}) THEN 0 END"


def flag_yn(x: str) -> str:
    t = ", ".join(q(v) for v in C.FLAG_TRUE)
    f = ", ".join(q(v) for v in C.FLAG_FALSE)
    return f"CASE WHEN upper(trim({x}, ' ')) IN ({t}) THEN 'Y' WHEN upper(trim({x}, ' ')) IN ({f}) THEN 'N' END"


def strict_flag(x: str) -> str:
    return f"CASE WHEN {x} IN ('0', '1') THEN CAST({x} AS INTEGER) END"


def strict_flag_invalid(x: str) -> str:
    return f"(coalesce(trim({x}, ' '), '') <> '' AND {x} NOT IN ('0', '1'))"


def year_month(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}, ' '), {q(C.YEAR_MONTH_RE)}) THEN left(trim({x}, ' '), 7) END"


def missing(x: str) -> str:
    return f"({x} IS NULL OR trim({x}, ' ') = '')"


def nonblank(x: str) -> str:
    return f"(coalesce(trim({x}, ' '), '') <> '')"


def month_diff(a: str, b: str) -> str:
    return f"((year({b}) - year({a})) * 12 + month({b}) - month({a}))"


def desc_all(cols: Sequence[str]) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def first_reason(rules: Sequence[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN {q(text)}" for cond, text in rules) + " END"


def all_reasons(rules: Sequence[tuple[str, str]], sep: str = "; ") -> str:
    parts = " || ".join(f"CASE WHEN {cond} THEN {q(text + sep)} ELSE '' END" for cond, text in rules)
    return f"NULLIF({parts}, '')"


def with_ctes(ctes: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes.items()) + "\n" + body


def present(src: str, doubles=(), bigints=(), exclude=()) -> str:
    """Output convention twin of ``hearth.plans.model.present``."""
    rep = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles] + [f"CAST({c} AS BIGINT) AS {c}" for c in bigints]
    ex = f" EXCLUDE ({', '.join(exclude)})" if exclude else ""
    r = f" REPLACE ({', '.join(rep)})" if rep else ""
    return f"SELECT *{ex}{r} FROM {src}"
