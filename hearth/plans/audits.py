"""Data-quality audits.

Rule audits return the offending rows (empty = pass); reconciliation audits
return one row per checked item with the numbers side by side.  All of them
are plain filters and aggregations, so they run distributed over whole
tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hearth.functions import clean as C
from hearth.operators.quality import distribution, duplicate_keys, recon
from hearth.plans.model import present

KEY_OF = {"address": ["AddressID"], "broker": ["BrokerID"], "claim_payments": ["PaymentID"],
          "claim_reserves": ["ReserveID"], "claims": ["ClaimID"], "coverage": ["PolicyID", "CoverageType"],
          "customer": ["CustomerID"], "date": ["DateKey"], "operating_expenses": ["ExpenseMonthStart", "ExpenseCategory"],
          "policy": ["PolicyID"], "policy_risk": ["PolicyID", "RiskType"], "premium_transactions": ["PremiumTransactionID"]}
ENTITIES = tuple(KEY_OF)


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def _missing_any(keys):
    return reduce(lambda a, b: a | b, [C.is_missing(k) for k in keys])


# The columns the staging checks look at, and the characters a number may hold there.
NUMBER_CHARS = {
    "address": {"Bedrooms": "0-9.", "BuildYear": "0-9", "RebuildCostEstimate": "0-9."},
    "claim_payments": {"PaymentAmount": "0-9.", "OutstandingReserve": "0-9.", "IncurredAmount": "0-9.", "LargeLossFlag": "0-9"},
    "claim_reserves": {"ReserveAmount": "0-9.\\-", "PreviousReserve": "0-9.\\-", "ReserveChange": "0-9.\\-", "ReserveAgeMonths": "0-9"},
    "coverage": {"CoverageLimit": "0-9.", "Excess": "0-9."},
    "customer": {"Age": "0-9", "CustomerTenureMonths": "0-9", "CustomerTenureYears": "0-9.", "RecordCompletenessScore": "0-9"},
}
FLAG_COLUMNS = {
    "claims": ("ReopenedFlag", "FraudFlag", "CatEventFlag"),
    "customer": ("HasEmail", "IsValidEmail", "HasPhone", "IsValidPhone", "MarketingOptInFlag", "ContactableFlag",
                 "VulnerableCustomerFlag"),
    "date": ("IsToday", "IsCurrentMonth", "IsCurrentYear", "IsYTD", "IsLast7Days", "IsLast30Days", "IsLast90Days",
             "IsBusinessDay", "IsUKBankHoliday", "IsWeekendFlag"),
    "premium_transactions": ("PremiumDataQualityFlag", "IsInstallmentPlanFlag", "IsYTDFlag", "IsLast12MonthsFlag"),
}
DATE_FLAGS = ("0", "1", "Y", "N")          # the calendar's flags come as digits or letters
YES_NO_COLUMNS = {"coverage": ("IsIncluded",), "customer": ("MarketingOptIn",), "policy_risk": ("HasAlarm",)}
DATE_COLUMNS = {"customer": ("DateOfBirth", "CreatedDate"), "date": ("Date",), "operating_expenses": ("ExpenseMonthStart",)}
TYPED_COLUMNS = {
    "policy_risk": {"RiskScore": "decimal", "PriorClaimsCount": "int", "AlarmRiskAdjustment": "decimal",
                    "ClaimsRiskAdjustment": "decimal", "AdjustedRiskScore": "decimal", "RiskDataCompletenessScore": "int"},
    "premium_transactions": {"TransactionDate": "date", "GrossPremium": "decimal", "NetPremium": "decimal"},
}
DEFAULTED_COLUMNS = {"policy_risk": ("RiskType", "RiskBand", "ClaimsHistoryBand", "AdjustedRiskBand"),
                     "premium_transactions": ("TransactionStatus", "TransactionType", "PremiumBand")}
UNIQUE_KEYS = ("broker", "coverage", "customer", "operating_expenses", "policy_risk", "premium_transactions")
GOLD_OF = {"address": "dim_address", "broker": "dim_broker", "claim_payments": "fact_claim_payments",
           "claim_reserves": "fact_claim_reserves", "claims": "fact_claim", "coverage": "fact_policy_coverage",
           "customer": "dim_customers", "date": "dim_date", "operating_expenses": "fact_operating_expenses",
           "policy": "dim_policy", "policy_risk": "dim_policy_risk", "premium_transactions": "fact_premium_transactions"}


def _row_key(entity):
    """The raw key as one text, NULL parts as empty."""
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in KEY_OF[entity]])


def _cells(wh, entity, bad):
    """The raw cells for which ``bad[column]`` holds, one scan per table: ``entity, row_key, column_name, value``."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"), cond.alias("bad"))
                                for c, cond in bad.items()]))
    return (wh.raw(entity).select(F.lit(entity).alias("entity"), _row_key(entity).alias("row_key"), cells.alias("c"))
              .filter(F.col("c.bad")).select("entity", "row_key", "c.column_name", "c.value"))


def _count_columns(wh, entity, conditions, what):
    """Rows per column for which a condition holds, one scan: ``entity, column_name, <what>, rows``."""
    cols = list(conditions)
    one = wh.raw(entity).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(conditions[c]).alias(c) for c in cols])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias(what)) for c in cols]))
    return one.select("rows", pairs.alias("p")).select(F.lit(entity).alias("entity"), "p.column_name", f"p.{what}", "rows")


def _filled(c):
    return F.coalesce(F.trim(c), F.lit("")) != ""


def _counts(wh, layer, entity, derive):
    """One row, ``rows``: as counted while the store was written, else counted now."""
    counted = wh.counted()
    if counted is None:
        return derive().agg(F.count(F.lit(1)).alias("rows"))
    return (counted.filter((F.col("layer") == layer) & (F.col("entity") == entity))
                   .agg(F.coalesce(F.max("rows"), F.lit(0)).alias("rows")))


def v_01(wh):
    """Row counts across all layers (raw, bronze, silver, reject, gold) per entity.
    Over a store they are the counts taken while it was written; else every layer
    is derived as far as its number of rows depends on it."""
    counted = wh.counted()
    if counted is not None:
        table_of = F.create_map(*[F.lit(v) for e in ENTITIES for v in (GOLD_OF[e], e)])
        c = counted.withColumn("entity", F.when(F.col("layer") == "gold", table_of[F.col("entity")]).otherwise(F.col("entity")))
        return present(c.filter(F.col("entity").isin(*ENTITIES)).groupBy("entity").agg(
            *[F.max(F.when(F.col("layer") == layer, F.col("rows"))).alias(f"{layer}_rows")
              for layer in ("raw", "bronze", "silver", "reject", "gold")]))
    wh = wh.counting()
    rows = [recon({"raw_rows": wh.raw(e), "bronze_rows": wh.bronze(e), "silver_rows": wh.silver(e),
                   "reject_rows": wh.rejects(e), "gold_rows": wh.gold.unnumbered(GOLD_OF[e])})
            .select(F.lit(e).alias("entity"), "*") for e in ENTITIES]
    return present(_union(rows))


def v_02(wh):
    """silver + reject = source (claim_reserves: every row; claim_payments:
    missing-key rows + one latest row per key).  Over a store, silver and
    reject are the counts taken while it was written; the source is counted."""
    cr = wh.raw("claim_reserves").agg(F.count(F.lit(1)).alias("source_rows"))
    cp_raw = wh.raw("claim_payments").select(C.blank_to_null("PaymentID").alias("k"))
    cp = cp_raw.agg((F.count_if(F.col("k").isNull()) + F.countDistinct("k")).alias("source_rows"))
    out = []
    for e, src in (("claim_reserves", cr), ("claim_payments", cp)):
        s = _counts(wh, "silver", e, lambda e=e: wh.silver(e)).withColumnRenamed("rows", "silver_rows")
        j = _counts(wh, "reject", e, lambda e=e: wh.rejects(e)).withColumnRenamed("rows", "reject_rows")
        out.append(src.crossJoin(s).crossJoin(j).select(
            F.lit(e).alias("entity"), "source_rows", "silver_rows", "reject_rows",
            (F.col("silver_rows") + F.col("reject_rows") == F.col("source_rows")).cast("int").alias("balanced")))
    return present(_union(out))


def v_03(wh):
    """Duplicate keys in the raw tables whose key should be unique (A-DUP1 / A-DUPN)."""
    out = []
    for e in UNIQUE_KEYS:
        keyed = wh.raw(e).filter(~_missing_any(KEY_OF[e])).select(
            F.lit(e).alias("entity"), F.concat_ws("|", *[C.blank_to_null(k) for k in KEY_OF[e]]).alias("row_key"))
        out.append(duplicate_keys(keyed, ["entity", "row_key"]))
    return present(_union(out))


def v_04(wh):
    """Null or blank key counts per entity."""
    return present(_union([wh.raw(e).agg(F.count_if(_missing_any(KEY_OF[e])).alias("missing_keys"))
                           .select(F.lit(e).alias("entity"), "missing_keys") for e in ENTITIES]))


def v_05(wh):
    """Non-numeric text in the raw number columns (P-15 character classes)."""
    return present(_union([_cells(wh, e, {c: _filled(c) & C.has_char_outside(F.trim(c), chars) for c, chars in cols.items()})
                           for e, cols in NUMBER_CHARS.items()]))


def v_06(wh):
    """Flag domains: rows with a value outside 0/1 (calendar: 0/1/Y/N) per raw flag column."""
    def bad(e, c):
        return _filled(c) & ~F.col(c).isin(*DATE_FLAGS) if e == "date" else C.strict_flag_invalid(c)
    return present(_union([_count_columns(wh, e, {c: bad(e, c) for c in cols}, "invalid_rows")
                           for e, cols in FLAG_COLUMNS.items()]))


def v_07(wh):
    """Y/N domain of the raw yes/no columns (blank is allowed)."""
    return present(_union([_cells(wh, e, {c: _filled(c) & C.not_in_domain(F.upper(F.trim(c)), ["Y", "N"]) for c in cols})
                           for e, cols in YES_NO_COLUMNS.items()]))


def v_08(wh):
    """Raw dates that neither the UK nor the ISO format parses (blank is allowed)."""
    return present(_union([_cells(wh, e, {c: _filled(c) & C.first_date(c, (C.UK, C.ISO)).isNull() for c in cols})
                           for e, cols in DATE_COLUMNS.items()]))


def v_09(wh):
    """DateKey equals the formatted date."""
    r = wh.raw("date")
    return present(r.filter(F.col("DateKey") != F.date_format(C.safe_date("Date", C.ISO), "yyyyMMdd"))
                    .select("Date", "DateKey"))


def v_10(wh):
    r = wh.raw("operating_expenses")
    return present(r.filter(_filled("Currency") & (F.upper(F.trim("Currency")) != "GBP")).select("ExpenseMonthStart", "ExpenseCategory", "Currency"))


def v_11(wh):
    """Month-on-month identity: inflation-adjusted amount - previous = variance (tolerance 0.50)."""
    r = wh.raw("operating_expenses")
    a, p, v = (C.safe_decimal(c) for c in ("InflationAdjustedAmount", "PreviousMonthAmount", "MoMVariance"))
    return present(r.filter(C.off_by_more_than(a - p - v)).select(
        "ExpenseMonthStart", "ExpenseCategory", "InflationAdjustedAmount", "PreviousMonthAmount", "MoMVariance"))


def v_12(wh):
    """Risk-score identity on typed bronze."""
    b = wh.bronze("policy_risk")
    diff = F.col("RiskScore") + F.col("AlarmRiskAdjustment") + F.col("ClaimsRiskAdjustment") - F.col("AdjustedRiskScore")
    return present(b.filter(C.off_by_more_than(diff)).select("PolicyID", "RiskType", "RiskScore", "AdjustedRiskScore"))


def v_13(wh):
    """Premium variance identity: net - calculated net = variance."""
    b = wh.bronze("premium_transactions")
    diff = F.col("NetPremium") - F.col("CalculatedNetPremium") - F.col("NetPremiumVariance")
    return present(b.filter(C.off_by_more_than(diff)).select("PremiumTransactionID", "PolicyID", "NetPremium",
                                                             "CalculatedNetPremium", "NetPremiumVariance"))


def v_14(wh):
    """Coverage flags agree with Y/N and with the 300,000 exposure threshold."""
    r = wh.raw("coverage")
    lim = C.safe_decimal("CoverageLimit")
    bad = ((F.col("IsIncluded") == "Y") != (F.col("IsIncludedFlag") == "1")) | \
          ((lim >= 300000) != (F.col("HighExposureFlag") == "1"))
    return present(r.filter(bad).select("PolicyID", "CoverageType", "IsIncluded", "IsIncludedFlag",
                                        "CoverageLimit", "HighExposureFlag"))


def v_15(wh):
    """Contactable although there is neither an opt-in nor a valid email or phone."""
    r = wh.raw("customer")
    bad = ((F.col("ContactableFlag") == "1") & (F.col("MarketingOptInFlag") != "1")
           & (F.col("IsValidEmail") != "1") & (F.col("IsValidPhone") != "1"))
    return present(r.filter(bad).select("CustomerID", "ContactableFlag", "IsValidEmail", "IsValidPhone", "MarketingOptInFlag"))


def v_15_has_email(wh):
    """An email address although HasEmail says there is none."""
    r = wh.raw("customer")
    return present(r.filter((F.col("HasEmail") == "0") & _filled("Email")).select("CustomerID", "HasEmail", "Email"))


def v_year_month(wh):
    """Premium YearMonth text that is not yyyy-mm (blank is allowed)."""
    r = wh.raw("premium_transactions")
    return present(r.filter(_filled("YearMonth") & ~F.col("YearMonth").rlike(C.YEAR_MONTH_RE))
                    .select("PremiumTransactionID", "YearMonth"))


def v_16(wh):
    f = wh.gold.fact_claim
    return present(f.filter(F.col("ReportedDate") < F.col("LossDate")).select("ClaimID", "LossDate", "ReportedDate"))


def v_17(wh):
    s = wh.silver("claims")
    return present(s.filter((F.col("ClaimStatus") == "Closed") & F.col("ClosedDate").isNull())
                    .select("ClaimID", "ClaimStatus"))


def _unconverted(entity, column, kind):
    if kind == "date":
        typed = C.first_date(column, (C.ISO, C.UK))
    elif kind == "int":
        typed = C.safe_int(column)
    else:
        typed = C.safe_decimal(column, *((10, 2) if entity == "policy_risk" else (18, 2)))
    return _filled(column) & typed.isNull()


def v_18(wh):
    """Conversion failures raw -> typed: text that is there but becomes NULL at bronze."""
    return present(_union([_cells(wh, e, {c: _unconverted(e, c, kind) for c, kind in cols.items()})
                           for e, cols in TYPED_COLUMNS.items()]))


def v_19(wh):
    """Defaults applied at bronze (blank text -> 'Unknown') per column."""
    return present(_union([_count_columns(wh, e, {c: C.is_missing(c) for c in cols}, "defaulted_rows")
                           for e, cols in DEFAULTED_COLUMNS.items()]))


def v_20(wh):
    """Null rate of the typed claim dates."""
    f = wh.gold.fact_claim
    t = f.agg(F.count(F.lit(1)).alias("claims"),
              *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("LossDate", "ReportedDate", "ClosedDate")])
    return present(t.select("*", *[F.try_divide(F.col(f"null_{c}").cast("double"), F.col("claims").cast("double"))
                                   .alias(f"null_rate_{c}") for c in ("LossDate", "ReportedDate", "ClosedDate")]))


def v_21(wh):
    """Reject reasons distribution over every silver reject output (A-DIST)."""
    return present(_union([distribution(wh.rejects(e).select(F.lit(e).alias("entity"), "RejectReason"),
                                        ["entity", "RejectReason"]) for e in ENTITIES]))


def _sides(df, *roles):
    """Each row's keys as ``relation, k, dim``: one scan of a table for all relations it has a part in.
    A relation goes by its number, so millions of keys carry no name."""
    return (df.select(F.explode(F.array(*[F.struct(F.lit(r).alias("relation"), F.col(c).cast("string").alias("k"), F.lit(d).alias("dim"))
                                          for r, c, d in roles])).alias("e"))
              .select("e.*").filter(F.col("k").isNotNull()))


def v_22(wh):
    """Referential integrity fact -> dimension (J-XCHECK) in one pass: the keys
    of both sides of all relations are tagged, united and grouped once; a key
    that no dimension row has is an orphan as often as facts use it.  Counts are
    combined map-side, so a hot key is one row per task.  Silver is asked for the
    keys only."""
    s, g = wh.silver, wh.gold
    fact, dim = 0, 1
    names = ("payments.ClaimID->claims", "premiums.PolicyID->policy", "claims.PolicyID->policy", "policy.BrokerID->broker",
             "policy.AddressID->address", "reserves.ClaimID->claims",
             # the two relations the reference declares as constraints, and the coverage lookup
             "expenses.ExpenseCategory->category", "expenses.ExpenseMonth->date", "coverage.CoverageKey->coverage")
    payments, premiums, claims, broker, address, reserves, category, month, coverage = range(len(names))
    sides = _union([
        _sides(s("claims", columns=("ClaimID", "PolicyID")), (payments, "ClaimID", dim), (reserves, "ClaimID", dim), (claims, "PolicyID", fact)),
        _sides(s("claim_payments", columns=("ClaimID",)), (payments, "ClaimID", fact)),
        _sides(s("claim_reserves", columns=("ClaimID",)), (reserves, "ClaimID", fact)),
        _sides(s("premium_transactions", columns=("PolicyID",)), (premiums, "PolicyID", fact)),
        _sides(s("policy", columns=("PolicyID", "BrokerID", "AddressID")), (premiums, "PolicyID", dim), (claims, "PolicyID", dim),
               (broker, "BrokerID", fact), (address, "AddressID", fact)),
        _sides(s("broker", columns=("BrokerID",)), (broker, "BrokerID", dim)),
        _sides(s("address", columns=("AddressID",)), (address, "AddressID", dim)),
        _sides(g.expense_typed, (category, "ExpenseCategory", fact), (month, "ExpenseMonth", fact)),
        _sides(g.expense_categories, (category, "ExpenseCategory", dim)),
        _sides(g.dim_date, (month, "FullDate", dim)),
        _sides(g.coverage_keys, (coverage, "CoverageKey", fact)),
        _sides(g.dim_coverage, (coverage, "CoverageKey", dim)),
        # every relation has its row, also without keys
        wh.spark.range(1).select(F.explode(F.array(*[F.lit(r) for r in range(len(names))])).alias("relation"), F.lit(None).cast("string").alias("k"),
                                 F.lit(dim).alias("dim"))])
    keys = sides.groupBy("relation", "k").agg(F.count_if(F.col("dim") == fact).alias("uses"), F.max("dim").alias("dim"))
    orphans = keys.groupBy("relation").agg(F.coalesce(F.sum(F.when(F.col("dim") == fact, F.col("uses"))), F.lit(0)).alias("orphans"))
    return present(orphans.withColumn("relation", F.array(*[F.lit(n) for n in names])[F.col("relation")]))


def v_23(wh):
    """Positive amounts; claim not before policy start; start before end."""
    pay = wh.silver("claim_payments").agg(F.count_if(F.col("PaymentAmount") <= 0).alias("non_positive_payments"))
    prem = wh.silver("premium_transactions").agg(F.count_if(F.col("GrossPremium") <= 0).alias("non_positive_premiums"))
    res = wh.silver("claim_reserves").agg(F.count_if(F.col("ReserveAmount") <= 0).alias("non_positive_reserves"))
    pol = wh.silver("policy").select("PolicyID", "InceptionDate", "ExpiryDate")
    per_day = wh.gold.fact_claim.groupBy("PolicyID", "LossDate").agg(F.count(F.lit(1)).alias("_n"))  # pre-aggregate
    early = (per_day.join(pol, "PolicyID")
             .agg(F.coalesce(F.sum(F.when(F.col("LossDate") < F.col("InceptionDate"), F.col("_n"))), F.lit(0))
                  .alias("claims_before_inception")))
    order = pol.agg(F.count_if(F.col("ExpiryDate") < F.col("InceptionDate")).alias("policies_end_before_start"))
    return present(pay.crossJoin(prem).crossJoin(res).crossJoin(early).crossJoin(order))


def v_24(wh):
    """Pre-flight: each source table exists and is not empty, and so does each entity's bronze and silver.
    A table that is not there counts 0 rows instead of stopping the check."""
    def line(layer, name, get):
        try:
            n = get().agg(F.count(F.lit(1)).alias("rows"))
        except AnalysisException:
            n = wh.spark.range(1).select(F.lit(0).cast("bigint").alias("rows"))
        return n.select(F.lit(layer).alias("layer"), F.lit(name).alias("source"), "rows",
                        (F.col("rows") > 0).cast("int").alias("ok"))
    names = ("orders", "lineitem", "customer", "supplier", "part", "nation", "region")
    source = [line("source", n, lambda n=n: wh.table(n)) for n in names]
    counted = wh.counted()
    if counted is not None:
        loaded = counted.filter(F.col("layer").isin("bronze", "silver") & F.col("entity").isin(*ENTITIES))
        return present(_union([*source, loaded.select("layer", F.col("entity").alias("source"), "rows", (F.col("rows") > 0).cast("int").alias("ok"))]))
    wh = wh.counting()
    return present(_union([*source, *[line("bronze", e, lambda e=e: wh.bronze(e)) for e in ENTITIES],
                           *[line("silver", e, lambda e=e: wh.silver(e)) for e in ENTITIES]]))


def v_25(wh):
    """Scores within 0..100 (P-20)."""
    b = wh.bronze("policy_risk")
    bad = C.out_of_range("RiskScore") | C.out_of_range("RiskDataCompletenessScore")
    return present(b.filter(bad).select("PolicyID", "RiskType", "RiskScore", "RiskDataCompletenessScore"))


def v_26(wh):
    """Reconcile premium, claim and expense totals between silver and gold."""
    g = wh.gold

    def pair(name, s_df, s_col, g_df, g_col):
        a = s_df.agg(F.coalesce(F.sum(s_col), F.lit(0)).alias("silver_total"))
        b = g_df.agg(F.coalesce(F.sum(g_col), F.lit(0)).alias("gold_total"))
        return a.crossJoin(b).select(F.lit(name).alias("measure"), "silver_total", "gold_total",
                                     (F.col("silver_total") - F.col("gold_total")).alias("difference"))
    exp = wh.silver("operating_expenses").select(C.safe_decimal("ExpenseAmount").alias("amt"))
    return present(_union([
        pair("net_premium", wh.silver("premium_transactions"), "NetPremium", g.fact_premium_transactions, "NetPremium"),
        pair("claims_paid", wh.silver("claim_payments"), "PaymentAmount", g.fact_claim_payments, "PaymentAmount"),
        pair("operating_expenses", exp, "amt", g.expense_lines, "ExpenseAmount"),       # the fact's rows, not numbered
    ]))


AUDITS = {f"v_{i:02d}": globals()[f"v_{i:02d}"] for i in range(1, 27)}
AUDITS.update({"v_15_has_email": v_15_has_email, "v_year_month": v_year_month})
