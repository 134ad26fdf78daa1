"""Rule-based classification, reject routing and generic audits.

SURVEY §2.1 SNK-REJECT, §2.2 P-11..P-13, §2.4 A-COUNT/A-DUP*/A-COND/A-DIST/A-RECON.
A classified DataFrame carries ``RejectReason``; good rows are those with a
NULL reason.  Both outputs come from one definition, so they are complementary
by construction (the reference repeats each rule two or three times).

``Classified`` is the written form: one table of all rows with their verdict,
laid out by verdict, from which the good and the reject output are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions.clean import all_reasons, first_reason

REASON = "RejectReason"


def classify(df: DataFrame, rules: Sequence[tuple[Column, str]], mode: str = "first",
             out: str = REASON) -> DataFrame:
    """Add the reject reason: ``first`` failing rule (ordered CASE) or ``all``."""
    if mode == "first":
        reason = first_reason(rules)
    elif mode == "all":
        reason = all_reasons(rules)
    else:
        raise ValueError(f"mode must be 'first' or 'all', not {mode!r}")
    return df.withColumn(out, reason)


def with_parsed(df: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """Add columns that cost a parser, each computed once per row.

    They come from a generator of one row.  A filter on a column of a plain
    projection is moved below it with a copy of the column's expression, so a
    verdict on parsed values would run every parser over the source's own
    expressions once per mention; below a generator no such filter goes."""
    rest = [c for c in df.columns if c not in parsed]
    return df.select(*rest, F.inline(F.array(F.struct(*[c.alias(n) for n, c in parsed.items()]))))


def is_good(reason_col: str = REASON) -> Column:
    """P-13: a row is good exactly when no rule failed."""
    return F.col(reason_col).isNull()


def split_rejects(df: DataFrame, reason_col: str = REASON) -> tuple[DataFrame, DataFrame]:
    """Return ``(good, reject)``: two filters over one classified frame.

    When both are written, the caller persists ``df`` (or writes it once)
    so the source is scanned a single time.
    """
    return df.filter(is_good(reason_col)).drop(reason_col), df.filter(~is_good(reason_col))


VERDICT = "Verdict"
GOOD, REJECT, BOTH = "good", "reject", "both"
_REJECT_PREFIX = "R_"


@dataclass(frozen=True)
class Classified:
    """SNK-REJECT in one pass: every row once, with its verdict.

    ``rows`` holds ``Verdict`` (``good``, ``reject``, or ``both`` for a row
    that loads with a conversion failure and is reported as well), the good
    output's columns under their names and the reject output's under a prefix.
    Written with ``partitionBy(Verdict)`` it serves both outputs, each reading
    its own folders only."""

    rows: DataFrame

    def _columns(self, reject: bool) -> list[str]:
        return [c for c in self.rows.columns if c != VERDICT and c.startswith(_REJECT_PREFIX) == reject]

    @property
    def good(self) -> DataFrame:
        return self.rows.filter(F.col(VERDICT).isin(GOOD, BOTH)).select(*self._columns(False))

    @property
    def reject(self) -> DataFrame:
        return (self.rows.filter(F.col(VERDICT).isin(REJECT, BOTH))
                    .select(*[F.col(c).alias(c[len(_REJECT_PREFIX):]) for c in self._columns(True)]))

    def counts(self) -> list[Column]:
        """What ``Dataset.observe`` counts while the rows are written: rows of the good and of the reject output."""
        return [F.count_if(F.col(VERDICT).isin(GOOD, BOTH)).alias("silver"), F.count_if(F.col(VERDICT).isin(REJECT, BOTH)).alias("reject")]


def _prefixed(df: DataFrame, cols: Sequence[str | Column]) -> list[Column]:
    names = df.select(*cols).columns
    return [(F.col(c) if isinstance(c, str) else c).alias(_REJECT_PREFIX + n) for c, n in zip(cols, names, strict=True)]


def classified(df: DataFrame, good: Sequence[str | Column], reject: Sequence[str | Column], verdict: Column,
               no_key: DataFrame | None = None, no_key_reject: Sequence[str | Column] | None = None) -> Classified:
    """The two outputs of ``df`` as one table; rows of ``no_key`` are all rejects."""
    rows = df.select(verdict.alias(VERDICT), *good, *_prefixed(df, reject))
    if no_key is not None:
        missing = no_key.select(F.lit(REJECT).alias(VERDICT), *_prefixed(no_key, no_key_reject or reject))
        rows = rows.unionByName(missing, allowMissingColumns=True)
    return Classified(rows)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "dup_count") -> DataFrame:
    """A-DUP1 / A-DUPN: keys that occur more than once (partial counts are
    combined map-side, so a hot key ships one partial row per task)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .filter(F.col(count_col) > 1))


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """A-COND: one row of ``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` counts."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])


def distribution(df: DataFrame, cols: str | Column | Sequence[str | Column],
                 count_col: str = "row_count") -> DataFrame:
    """A-DIST: value frequencies (order with ``orderBy(desc(count_col))`` when shown)."""
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))


def recon(counts: Mapping[str, DataFrame]) -> DataFrame:
    """A-RECON: several scalar counts side by side in one row.

    Each input is reduced to a one-row count first, so the cross join is
    between single rows (bounded, never a cross product of data)."""
    out = None
    for name, df in counts.items():
        one = df.agg(F.count(F.lit(1)).alias(name))
        out = one if out is None else out.crossJoin(one)
    return out
