"""Gold star schema.

Surrogate keys come from ``assign_key`` (range-partitioned, no global
window).  Unknown members (key -1) are literal one-row frames appended with
``unionByName``.  Fact-to-dimension joins use business keys; only the
calendar and the claim-type/status lists are broadcast by construction
(their size does not grow with the data).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions import clean as C
from hearth.operators.dedupe import latest
from hearth.operators.joins import anti, join_dim, lookup_key
from hearth.operators.keys import assign_key, resolve_key
from hearth.operators.scd import scd1_merge, top_key, with_unknown
from hearth.plans.silver import CUSTOMER_KEYS
from hearth.sources.calendar import calendar, calendar_between, date_attributes

UNKNOWN_KEY = -1
UNKNOWN_CODE = "UNKNOWN"
CLAIM_DATE_FORMATS = (C.UK, C.ISO, C.ISO_TIME)
EXPENSE_MONTH_FORMATS = (C.ISO, C.UK)


def normalised_cover(c) -> F.Column:
    """D-03 / J-ANTI-EXPR: upper-cased trimmed type, blank -> UNKNOWN."""
    return F.coalesce(F.upper(C.blank_to_null(c)), F.lit(UNKNOWN_CODE))


def stored(fn):
    """A gold table: read from the warehouse's store when gold is stored,
    else derived by ``fn``; memoised like ``cached_property``."""
    name = fn.__name__

    def get(self):
        if "gold" in self.wh.stored:
            return self.wh.spark.read.parquet(f"{self.wh.store}/gold/{name}")
        return fn(self)
    get.__name__ = name
    get.__doc__ = fn.__doc__
    return cached_property(get)


def _stamp(df: DataFrame, now) -> DataFrame:
    return df.withColumn("GoldLoadDts", F.lit(now).cast("timestamp"))


def dim_coverage_from(silver_coverage: DataFrame, now, current: DataFrame | None = None) -> DataFrame:
    """D-03: distinct normalised types; UNKNOWN is the -1 member.  With
    ``current`` only new types are added (J-ANTI-EXPR) and numbered after
    the existing maximum."""
    types = (silver_coverage.select(normalised_cover("CoverageType").alias("CoverageType")).distinct()
             .filter(F.col("CoverageType") != UNKNOWN_CODE))
    if current is None:
        dim = assign_key(types, ["CoverageType"], "CoverageKey")
        dim = _stamp(dim, now).select("CoverageKey", "CoverageType", "GoldLoadDts")
        return with_unknown(dim, {"CoverageKey": UNKNOWN_KEY, "CoverageType": UNKNOWN_CODE})
    new = anti(types, current, ["CoverageType"])
    new = assign_key(new, ["CoverageType"], "_k").crossJoin(F.broadcast(top_key(current, "CoverageKey")))
    new = _stamp(new.withColumn("CoverageKey", F.col("_k") + F.col("_top")), now)
    return current.unionByName(new.select(*current.columns))


class Gold:
    def __init__(self, wh):
        self.wh = wh
        self.now = wh.now

    def _dim(self, name: str, source: DataFrame, key: str, key_col: str, unknown: dict | None = None) -> DataFrame:
        """A dimension of ``source`` by business key.  On a first load the keys
        follow the business key; after that the rows are merged into the
        previous load's image (type 1): known members keep their surrogate,
        new ones are numbered after the greatest, vanished ones stay."""
        previous = self.wh.previous(name)
        if previous is not None:
            tracked = [c for c in source.columns if c != key]
            return scd1_merge(previous, source, key, tracked, key_col, self.now)
        dim = _stamp(assign_key(source, [key], key_col), self.now)
        dim = dim.select(key_col, *[c for c in dim.columns if c != key_col])
        return with_unknown(dim, {key_col: UNKNOWN_KEY, **unknown}) if unknown else dim

    def unnumbered(self, name: str) -> DataFrame:
        """The rows of a gold table without the surrogate key of a fact or first-load dimension, for counting:
        numbering keeps every row, so it is left out; unknown members are there."""
        if "gold" not in self.wh.stored and self.wh.previous_store is None:
            if name == "fact_operating_expenses":
                return self.expense_lines
            if name == "fact_policy_coverage":
                return self.wh.silver("coverage")
            if name in ("dim_address", "dim_broker", "dim_customers"):
                s = self.wh.silver({"dim_customers": "customer"}.get(name, name[4:])).select(F.lit(1).alias("r"))
                return s if name == "dim_customers" else s.unionByName(self.wh.spark.range(1).select(F.lit(1).alias("r")))
        return getattr(self, name)

    # -- dimensions ----------------------------------------------------------
    @stored
    def dim_address(self) -> DataFrame:
        s = self.wh.silver("address").drop("PostcodeArea", "CustomerID", "BronzeLoadDts", "SilverLoadDts",
                                            "SourceFile")
        return self._dim("dim_address", s, "AddressID", "AddressKey", {"AddressID": UNKNOWN_CODE})

    @stored
    def dim_broker(self) -> DataFrame:
        s = self.wh.silver("broker").drop("BronzeLoadDts", "SilverLoadDts", "SourceFile")
        return self._dim("dim_broker", s, "BrokerID", "BrokerKey", {"BrokerID": UNKNOWN_CODE})

    @stored
    def dim_coverage(self) -> DataFrame:
        return dim_coverage_from(self.wh.silver("coverage", columns=("CoverageType",)), self.now, self.wh.previous("dim_coverage"))

    @stored
    def dim_customers(self) -> DataFrame:
        s = self.wh.silver("customer").drop("BronzeLoadDts", "SilverLoadDts", "SourceFile")  # P-21
        key = resolve_key(s.columns, CUSTOMER_KEYS)[0]
        return self._dim("dim_customers", s, key, "CustomerKey")

    @stored
    def dim_date(self) -> DataFrame:
        """D-05: calendar over the span of the silver dates (+1 year for expiries),
        widened to whole years; bounded by the number of days."""
        day = C.safe_date("Date", C.ISO)
        bounds = self.wh.silver("date").agg(F.min(day).alias("lo"), F.date_add(F.max(day), 365).alias("hi"))
        return self._calendar(calendar_between(bounds))

    @cached_property
    def fixed_calendar(self) -> DataFrame:
        """D-05 over the reference's fixed range, 2015 to 2035, whatever the data's dates."""
        return self._calendar(calendar(self.wh.spark))

    def _calendar(self, days: DataFrame) -> DataFrame:
        return _stamp(days.select(*[c.alias(n) for n, c in date_attributes(F.col("FullDate")).items()]), self.now)

    @stored
    def expense_categories(self) -> DataFrame:
        """One row per trimmed category (W-LATEST-EXPR, deterministic winner)."""
        s = self.wh.silver("operating_expenses").select(
            F.trim("ExpenseCategory").alias("ExpenseCategory"),
            C.strict_flag("ImpactsExpenseRatioFlag").alias("ImpactsExpenseRatioFlag"),
            F.col("ExpenseType"), F.col("CostCentre"))
        return latest(s, ["ExpenseCategory"])

    @stored
    def dim_expense_category(self) -> DataFrame:
        """D-06: the categories with a surrogate key; no unknown member."""
        cat = self.expense_categories
        dim = self._dim("dim_expense_category", cat, "ExpenseCategory", "ExpenseCategoryKey")
        return dim.select(*cat.columns, "ExpenseCategoryKey", "GoldLoadDts")

    @cached_property
    def expense_typed(self) -> DataFrame:
        return self.wh.silver("operating_expenses").select(
            C.first_date("ExpenseMonthStart", EXPENSE_MONTH_FORMATS).alias("ExpenseMonth"),
            F.trim("ExpenseCategory").alias("ExpenseCategory"),
            C.safe_decimal("ExpenseAmount").alias("ExpenseAmount"),
            C.safe_decimal("InflationAdjustedAmount").alias("InflationAdjustedAmount"),
            C.safe_decimal("PreviousMonthAmount").alias("PreviousMonthAmount"),
            C.safe_decimal("MoMVariance").alias("MoMVariance"),
            F.col("Currency"))

    @stored
    def expense_lines(self) -> DataFrame:
        """The rows of F-04 without surrogate keys (what KPIs aggregate):
        the same inner join to the categories, no numbering job."""
        cat = self.expense_categories.select(F.col("ExpenseCategory").alias("_cat"), "ImpactsExpenseRatioFlag")
        return join_dim(self.expense_typed, cat, ["ExpenseCategory"], ["_cat"], how="inner").drop("_cat")

    @stored
    def dim_policy(self) -> DataFrame:
        return _stamp(self.wh.silver("policy").drop("SilverLoadDts"), self.now)

    @stored
    def dim_policy_risk(self) -> DataFrame:
        return _stamp(self.wh.silver("policy_risk").drop("SilverLoadDts"), self.now)

    def _code_dim(self, name: str, col: str, key: str) -> DataFrame:
        vals = (self.wh.silver("claims").select(C.blank_to_null(col).alias(col)).filter(F.col(col).isNotNull())
                .distinct())
        return self._dim(name, vals, col, key, {col: UNKNOWN_CODE})

    @stored
    def dim_claim_type(self) -> DataFrame:
        return self._code_dim("dim_claim_type", "ClaimType", "ClaimTypeKey")

    @stored
    def dim_claim_status(self) -> DataFrame:
        return self._code_dim("dim_claim_status", "ClaimStatus", "ClaimStatusKey")

    # -- facts -----------------------------------------------------------------
    @stored
    def fact_claim(self) -> DataFrame:
        """F-01: three dates parsed (P-08 + P-07), flags and integers typed."""
        s = self.wh.silver("claims")
        dates = {c: C.first_date(C.date_text_iso(c), CLAIM_DATE_FORMATS) for c in ("LossDate", "ReportedDate", "ClosedDate")}
        return _stamp(s.select(
            "ClaimID", "PolicyID", *[v.alias(k) for k, v in dates.items()],
            "ClaimType", "Severity", "ClaimStatus", "ClaimComplexity",
            C.safe_int("ReportingDelayDays").alias("ReportingDelayDays"),
            C.safe_int("ClaimDurationDays").alias("ClaimDurationDays"),
            *[C.strict_flag(c).alias(c) for c in ("ReopenedFlag", "FraudFlag", "CatEventFlag")]), self.now)

    @stored
    def fact_claim_payments(self) -> DataFrame:
        return _stamp(self.wh.silver("claim_payments").drop("SilverLoadDts"), self.now)

    @stored
    def fact_claim_reserves(self) -> DataFrame:
        return _stamp(self.wh.silver("claim_reserves").drop("SilverLoadDts"), self.now)

    @stored
    def fact_premium_transactions(self) -> DataFrame:
        return _stamp(self.wh.silver("premium_transactions").drop("SilverLoadDts"), self.now)

    @stored
    def fact_operating_expenses(self) -> DataFrame:
        """F-04: inner join to categories (rows of no category vanish; V-22
        counts them), left join to the calendar (bounded, broadcast), surrogate key."""
        s = self.expense_typed
        cat = self.dim_expense_category.select("ExpenseCategoryKey", F.col("ExpenseCategory").alias("_cat"),
                                               "ImpactsExpenseRatioFlag")
        j = join_dim(s, cat, ["ExpenseCategory"], ["_cat"], how="inner").drop("_cat")
        cal = self.dim_date.select(F.col("FullDate").alias("_d"), "DateKey")
        j = j.join(F.broadcast(cal), F.col("ExpenseMonth") == F.col("_d"), "left").drop("_d")
        # two spellings of one month are two lines: the amounts settle the order
        return _stamp(assign_key(j, ["ExpenseMonth", "ExpenseCategory", "ExpenseAmount", "InflationAdjustedAmount",
                                     "PreviousMonthAmount", "MoMVariance", "Currency"], "OperatingExpenseKey"), self.now)

    def _with_coverage_key(self, s: DataFrame) -> DataFrame:
        return lookup_key(s, self.dim_coverage, normalised_cover(F.col("CoverageType")), "CoverageType", "CoverageKey")

    @cached_property
    def coverage_lines(self) -> DataFrame:
        """The rows of F-05 without their surrogate key: coverage rows + CoverageKey lookup (-1 when absent)."""
        return self._with_coverage_key(self.wh.silver("coverage").drop("SilverLoadDts", "BronzeLoadDts", "SourceFile"))

    @cached_property
    def coverage_keys(self) -> DataFrame:
        """The CoverageKey of every row of F-05, which reads the type alone."""
        return self._with_coverage_key(self.wh.silver("coverage", columns=("CoverageType",))).select("CoverageKey")

    @stored
    def fact_policy_coverage(self) -> DataFrame:
        """F-05: the coverage lines with a surrogate key."""
        j = self.coverage_lines
        return _stamp(assign_key(j, ["PolicyID", "CoverageType"], "PolicyCoverageKey"), self.now)


def rich_calendar(gold: Gold) -> DataFrame:
    """D-11: the generated calendar with the staging file's richer attributes
    (ISO week, period bounds, April fiscal year, relative flags, holidays)."""
    from hearth.sources.calendar import STAGING_DATE_COLUMNS, rich_attributes
    d = F.col("FullDate")
    hol = ((F.month(d) == 1) & (F.dayofmonth(d) == 1)) | ((F.month(d) == 12) & (F.dayofmonth(d) == 25))
    attrs = {**date_attributes(d), **rich_attributes(d, F.lit(gold.wh.as_of).cast("date"), 4, hol)}
    attrs["HolidayName"] = (F.when(hol & (F.month(d) == 1), F.lit("New Year's Day"))
                            .when(hol, F.lit("Christmas Day")).otherwise(F.lit("")))
    names = ["DateKey", "FullDate"] + [c for c in STAGING_DATE_COLUMNS if c in attrs and c not in ("DateKey",)]
    return gold.dim_date.select("FullDate").select(*[attrs[n].alias(n) for n in dict.fromkeys(names)])
