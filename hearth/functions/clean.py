"""Row-level text cleaning, parsing and predicates.

Every function maps ``Column -> Column`` and uses built-in expressions only,
so the optimizer can fold, push down and code-generate them.  Parsers never
raise: a value that does not convert becomes NULL (Spark's ``try_*``
family), and strictness that Spark's casts lack is added with a regex guard.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
# ---------------------------------------------------------------------------
# Flag synonyms (P-09): accepted spellings for true and false.
FLAG_TRUE = ("Y", "YES", "1", "TRUE")
FLAG_FALSE = ("N", "NO", "0", "FALSE")
# Strict flag domain (P-09c).
STRICT_FLAG = ("0", "1")
# Default for blank descriptive text (P-03).
UNKNOWN_TEXT = "Unknown"
# Character sets removed from money text (P-05).
MONEY_CHARS_ADDRESS = "[\r\n\t,£]"
MONEY_CHARS_RESERVE = "[,£$ ]"
# Year-month pattern (P-10).
YEAR_MONTH_RE = r"^[12][0-9]{3}-[01][0-9]\z"
# Date formats, Spark pattern letters (P-06/P-07).
UK = "d/M/yyyy"          # dd/mm/yyyy, style 103
ISO = "yyyy-M-d"         # yyyy-mm-dd, style 23
YMD_SLASH = "yyyy/M/d"   # yyyy/mm/dd, style 111
DMY_DASH = "d-M-yyyy"    # dd-mm-yyyy, style 105
ISO_TIME = "yyyy-M-d HH:mm:ss"  # style 120 after 'T' -> ' '

# Plain decimal text: optional sign, digits with an optional point, no
# exponent.  Spark's cast accepts '1e5'; the reference's does not (H-2).
# \z (not $): Java's $ also matches before a trailing line break.
NUMERIC_RE = r"^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+) *\z"
INTEGER_RE = r"^ *[+-]?[0-9]+ *\z"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P-01
def trim_spaces(c: Column | str) -> Column:
    """Strip spaces at both ends (spaces only, like LTRIM/RTRIM)."""
    return F.trim(_c(c))


# P-02
def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_c(c)), F.lit(""))


# P-03
def default_text(c: Column | str, default: str = UNKNOWN_TEXT) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


# P-04
def safe_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """Text -> decimal(p,s); NULL when not plain numeric text (rounds half up)."""
    c = _c(c)
    return F.when(c.rlike(NUMERIC_RE), F.trim(c).try_cast(f"decimal({precision},{scale})"))


def safe_int(c: Column | str) -> Column:
    """Text -> int; NULL unless the text is a whole number."""
    c = _c(c)
    return F.when(c.rlike(INTEGER_RE), F.trim(c).try_cast("int"))


# P-05
def money(c: Column | str, chars: str = MONEY_CHARS_ADDRESS,
          precision: int = 18, scale: int = 2) -> Column:
    """Strip currency symbols, separators and control characters, then P-04.
    ``chars`` is a character class; ``translate`` deletes its members (no
    regex engine per value)."""
    members = chars[1:-1] if chars.startswith("[") and chars.endswith("]") else chars
    return safe_decimal(F.translate(_c(c), members, ""), precision, scale)


# Digit-and-separator shape of each format: a superset of what the pattern
# can parse.  ``try_to_date`` signals a failed parse through an exception
# internally, which is costly per row; text of the wrong shape never reaches it.
DATE_SHAPE = {            # 'yyyy' needs at least four digits
    UK: r"^[0-9]+/[0-9]+/[0-9]{4,}\z",
    ISO: r"^[0-9]{4,}-[0-9]+-[0-9]+\z",
    YMD_SLASH: r"^[0-9]{4,}/[0-9]+/[0-9]+\z",
    DMY_DASH: r"^[0-9]+-[0-9]+-[0-9]{4,}\z",
    "yyyyMMdd": r"^[0-9]{8,}\z",
    ISO_TIME: r"^[0-9]{4,}-[0-9]+-[0-9]+ [0-9]+:[0-9]+:[0-9]+\z",
}


# P-06
def safe_date(c: Column | str, fmt: str = UK) -> Column:
    t = F.trim(_c(c))
    parsed = F.try_to_date(t, fmt)
    shape = DATE_SHAPE.get(fmt)
    return F.when(t.rlike(shape), parsed) if shape else parsed


# P-07
def first_date(c: Column | str, formats: Sequence[str] = (UK, ISO)) -> Column:
    """The first format that parses wins."""
    return F.coalesce(*[safe_date(c, f) for f in formats])


# P-08
def date_text_prefix(c: Column | str, width: int = 10) -> Column:
    """No-break space -> space, trim, keep the first ``width`` characters."""
    return F.left(F.trim(F.translate(_c(c), "\u00a0", " ")), F.lit(width))


def date_text_iso(c: Column | str) -> Column:
    """Drop double quotes, no-break spaces, the ISO 'T' separator and the
    fraction of a second (the date does not depend on it)."""
    c = F.translate(_c(c), "\u00a0", " ")
    c = F.trim(F.regexp_replace(F.regexp_replace(c, '"', ""), "T", " "))
    return F.regexp_replace(c, r"(:[0-9]+)[.][0-9]+$", "$1")


# P-09
def flag01(c: Column | str) -> Column:
    u = F.upper(F.trim(_c(c)))
    return F.when(u.isin(*FLAG_TRUE), F.lit(1)).when(u.isin(*FLAG_FALSE), F.lit(0))


# P-09b
def flag_yn(c: Column | str) -> Column:
    u = F.upper(F.trim(_c(c)))
    return F.when(u.isin(*FLAG_TRUE), F.lit("Y")).when(u.isin(*FLAG_FALSE), F.lit("N"))


# P-09c
def strict_flag(c: Column | str) -> Column:
    c = _c(c)
    return F.when(c.isin(*STRICT_FLAG), c.cast("int"))


def strict_flag_invalid(c: Column | str) -> Column:
    """Non-blank text outside '0'/'1' (the reject test of P-09c)."""
    c = _c(c)
    return (F.coalesce(F.trim(c), F.lit("")) != "") & ~c.isin(*STRICT_FLAG)


# P-10
def year_month(c: Column | str) -> Column:
    t = F.trim(_c(c))
    return F.when(t.rlike(YEAR_MONTH_RE), F.left(t, F.lit(7)))


# P-14
def not_in_domain(c: Column | str, values: Iterable[str]) -> Column:
    """Three-valued like SQL NOT IN: NULL stays NULL (neither in nor out)."""
    return ~_c(c).isin(*list(values))


# P-15
def has_char_outside(c: Column | str, char_class: str = "0-9.\\-") -> Column:
    return _c(c).rlike(f"[^{char_class}]")


# P-16
def is_missing(c: Column | str) -> Column:
    c = _c(c)
    return c.isNull() | (F.trim(c) == "")


# P-18
def off_by_more_than(expr: Column, tolerance: float = 0.50) -> Column:
    return F.abs(expr) > F.lit(tolerance)


# P-19
def before(a: Column | str, b: Column | str) -> Column:
    return _c(a) < _c(b)


# P-20
def out_of_range(c: Column | str, lo: float = 0, hi: float = 100) -> Column:
    return ~_c(c).between(lo, hi)


# P-23
def composite_key(*parts: Column | str, sep: str = "|") -> Column:
    """Parts joined by ``sep``; NULL parts count as '' like T-SQL CONCAT."""
    return F.concat_ws(sep, *[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts])


# P-25
def month_diff(start: Column | str, end: Column | str) -> Column:
    """Calendar-month boundaries crossed (DATEDIFF(month, start, end))."""
    s, e = _c(start), _c(end)
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


# P-11
def first_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    """Ordered CASE: the text of the first failing rule, else NULL."""
    out = None
    for cond, text in rules:
        out = F.when(cond, F.lit(text)) if out is None else out.when(cond, F.lit(text))
    return out


# P-12
def all_reasons(rules: Sequence[tuple[Column, str]], sep: str = "; ") -> Column:
    """Every failing rule, each followed by ``sep`` (reference text keeps the
    trailing separator); NULL when every rule passes."""
    parts = [F.when(cond, F.lit(text + sep)).otherwise(F.lit("")) for cond, text in rules]
    return F.nullif(F.concat(*parts), F.lit(""))
