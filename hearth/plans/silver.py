"""Silver layer: typed, deduplicated, rejects split off.

Common shape of every job:

1. normalise the key (trim, blank -> NULL);
2. rows without a key go straight to the reject output.  Classifying them
   *before* the dedupe window means blank keys never form one giant window
   partition (a hot key), and every such row is reported (the reference
   reports one per blank/NULL group, H-3);
3. keyed rows keep the newest row per key (W-LATEST: load time, then a full
   tie-break over the payload so the winner is deterministic);
4. the remaining rules classify the latest rows into good and reject.

Every job returns one ``Classified`` table of all rows with their verdict; the
good and the reject output are read from it, and a load writes it once.  Load
timestamps are parameters.

The jobs in ``ASKED`` take the columns of the good output that will be read
(``asked``); the result has all columns, but only those are determined.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions import clean as C
from hearth.operators.dedupe import latest
from hearth.operators.keys import key_expr, resolve_key
from hearth.operators.quality import BOTH, GOOD, REASON, REJECT, Classified, classified, classify, with_parsed

# Ranked key columns of each entity, matched without case, blanks and underscores.
CUSTOMER_KEYS = ["CustomerID", "PolicyholderID", "PersonID", "ClientID", "InsuredID", "InsuredPersonID", "PartyID", "ID"]
COVERAGE_ID_KEYS = ["CoverageID", "PolicyCoverageID", "CoverageRecordID", "CoverageKey", "CoverageTransactionID"]
EXPENSE_KEYS = ["ExpenseID", "OperatingExpenseID", "OpexID", "ID"]
POLICY_KEYS = ["PolicyID", "PolicyKey", "PolicyNumber", "PolicyRef", "PolicyReference"]
PREMIUM_KEYS = ["TransactionID", "PremiumTransactionID", "PremiumTransID", "PremiumTransactionKey", "PremiumID", "ID"]
PREMIUM_COMPOSITE = ["PolicyID", "TransactionDate", "TransactionType"]

# Fixed value: the "today" used for ages in the derived test data (H-10).
DEFAULT_AS_OF = date(2001, 12, 31)


def _at(now: datetime, name: str) -> Column:
    return F.lit(now).cast("timestamp").alias(name)


def _verdict(reason: str = REASON) -> Column:
    return F.when(F.col(reason).isNull(), F.lit(GOOD)).otherwise(F.lit(REJECT))


def _all_good(df: DataFrame, good: Sequence[str | Column], now: datetime, no_key: DataFrame,
              reject: Sequence[str | Column]) -> Classified:
    """Every keyed row loads; only rows without a key are rejects."""
    none = [F.lit(None).cast(t).alias(n) for n, t in no_key.select(*reject, _at(now, "RejectLoadDts")).dtypes]
    return classified(df, [*good, _at(now, "SilverLoadDts")], none, F.lit(GOOD), no_key, [*reject, _at(now, "RejectLoadDts")])


def _missing_key_rejects(df: DataFrame, keys: Sequence[str], reason: str) -> tuple[DataFrame, DataFrame]:
    """Trim keys; split rows with any missing key part off as rejects."""
    df = df.withColumns({k: C.blank_to_null(k) for k in keys})
    missing = None
    for k in keys:
        m = F.col(k).isNull()
        missing = m if missing is None else missing | m
    return df.filter(~missing), df.filter(missing).withColumn(REASON, F.lit(reason))


def _text_clean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P-01/P-02 on descriptive text columns."""
    return df.withColumns({c: C.blank_to_null(c) for c in cols})


def _reject_out(df: DataFrame, keys: Sequence[str], raw_cols: Sequence[str], now: datetime) -> list[str | Column]:
    cols = [*keys, REASON, *[F.col(c).alias(f"{c}Raw") for c in raw_cols], "BronzeLoadDts"]
    if "SourceFile" in df.columns:
        cols.append("SourceFile")
    return [*cols, _at(now, "RejectLoadDts")]


# ---------------------------------------------------------------------------
# S-03 claim_payments: seven ordered rules, typed output, complementary split
# ---------------------------------------------------------------------------
def silver_claim_payments(b: DataFrame, now: datetime) -> Classified:
    raw_cols = ["PaymentDate", "PaymentAmount", "OutstandingReserve", "IncurredAmount", "LargeLossFlag"]
    keyed, no_key = _missing_key_rejects(b, ["PaymentID"], "Missing PaymentID")
    lt = with_parsed(latest(keyed, ["PaymentID"]), {
        "_PaymentDate": C.safe_date("PaymentDate", C.UK),
        **{f"_{c}": C.safe_decimal(c) for c in ("PaymentAmount", "OutstandingReserve", "IncurredAmount")}})

    def bad(c: str) -> Column:
        return (F.coalesce(F.trim(c), F.lit("")) != "") & F.col(f"_{c}").isNull()

    rules = [
        (C.is_missing("ClaimID"), "Missing ClaimID"),
        (bad("PaymentDate"), "Invalid PaymentDate (expected UK dd/mm/yyyy)"),
        (bad("PaymentAmount"), "Invalid PaymentAmount (not numeric)"),
        (bad("OutstandingReserve"), "Invalid OutstandingReserve (not numeric)"),
        (bad("IncurredAmount"), "Invalid IncurredAmount (not numeric)"),
        (C.strict_flag_invalid("LargeLossFlag"), "Invalid LargeLossFlag (expected 0/1)"),
    ]
    cls = classify(lt, rules, "first")
    good = [
        "PaymentID", C.blank_to_null("ClaimID").alias("ClaimID"),
        F.col("_PaymentDate").alias("PaymentDate"),
        F.col("_PaymentAmount").alias("PaymentAmount"),
        *[C.blank_to_null(c).alias(c) for c in ("PaymentMethod", "PaymentStatus", "ClaimType", "ClaimSeverityBand")],
        F.col("_OutstandingReserve").alias("OutstandingReserve"),
        F.col("_IncurredAmount").alias("IncurredAmount"),
        C.strict_flag("LargeLossFlag").alias("LargeLossFlag"),
        "BronzeLoadDts", "SourceFile", _at(now, "SilverLoadDts")]
    return classified(cls, good, _reject_out(cls, ["PaymentID", "ClaimID"], raw_cols, now), _verdict(), no_key)


# ---------------------------------------------------------------------------
# S-04 claim_reserves: no dedupe, every failing reason listed, age recomputed
# ---------------------------------------------------------------------------
RESERVE_DATE_FORMATS = (C.UK, C.ISO, C.YMD_SLASH, C.DMY_DASH, "yyyyMMdd")


def silver_claim_reserves(b: DataFrame, now: datetime, as_of: date = DEFAULT_AS_OF) -> Classified:
    amounts = ("ReserveAmount", "PreviousReserve", "ReserveChange")
    raw = b.select(
        "ReserveID", "ClaimID", C.date_text_prefix("SnapshotDate").alias("_snapshot"),
        *[F.col(c).alias(f"{c}Raw") for c in ("SnapshotDate", *amounts)],
        *[C.blank_to_null(c).alias(c) for c in ("ReserveStatus", "ReserveType", "ReserveMovementType")],
        C.safe_int(C.blank_to_null("LargeReserveFlag")).alias("LargeReserveFlag"),
        C.safe_int(C.blank_to_null("LatestSnapshotFlag")).alias("LatestSnapshotFlag"),
        "BronzeLoadDts", "SourceFile")
    parsed = with_parsed(raw, {
        **{c: C.blank_to_null(c) for c in ("ReserveID", "ClaimID")},
        "SnapshotDate": C.first_date("_snapshot", RESERVE_DATE_FORMATS),
        **{c: C.money(f"{c}Raw", C.MONEY_CHARS_RESERVE) for c in amounts}})
    rules = [
        (F.col("ReserveID").isNull(), "ReserveID missing"),
        (F.col("ClaimID").isNull(), "ClaimID missing"),
        (F.col("SnapshotDate").isNull(), "SnapshotDate invalid/missing"),
        (F.col("ReserveAmount").isNull(), "ReserveAmount invalid/missing"),
        (F.col("PreviousReserve").isNull(), "PreviousReserve invalid/missing"),
        (F.col("ReserveChange").isNull(), "ReserveChange invalid/missing"),
    ]
    good = [
        "ReserveID", "ClaimID", "SnapshotDate", "ReserveAmount", "PreviousReserve", "ReserveChange",
        "ReserveStatus", "ReserveType", "ReserveMovementType", "LargeReserveFlag", "LatestSnapshotFlag",
        C.month_diff(F.col("SnapshotDate"), F.lit(as_of).cast("date")).alias("ReserveAgeMonths"),
        "BronzeLoadDts", "SourceFile", _at(now, "SilverLoadDts")]
    reject = ["ReserveID", "ClaimID", "SnapshotDateRaw", "ReserveAmountRaw", "PreviousReserveRaw",
              "ReserveChangeRaw", REASON, "BronzeLoadDts", "SourceFile", _at(now, "RejectLoadDts")]
    return classified(classify(parsed, rules, "all"), good, reject, _verdict())


# ---------------------------------------------------------------------------
# S-05 claims, S-07 customer, S-08 date: latest per key, stays text
# ---------------------------------------------------------------------------
def _latest_text(b: DataFrame, keys: Sequence[str], now: datetime, reason: str,
                 asked: Collection[str] | None = None) -> Classified:
    keyed, no_key = _missing_key_rejects(b, keys, reason)
    lt = latest(keyed, keys, asked=asked)
    text_cols = [c for c in b.columns if c not in keys and c not in ("BronzeLoadDts", "SourceFile")]
    good = _text_clean(lt, text_cols)
    return _all_good(good, good.columns, now, no_key, [*keys, REASON, "BronzeLoadDts", "SourceFile"])


def silver_claims(b: DataFrame, now: datetime, asked: Collection[str] | None = None) -> Classified:
    return _latest_text(b, ["ClaimID"], now, "Missing ClaimID", asked)


def silver_customer(b: DataFrame, now: datetime, asked: Collection[str] | None = None) -> Classified:
    key = resolve_key(b.columns, CUSTOMER_KEYS)
    return _latest_text(b, key, now, f"Missing {key[0]}", asked)


def silver_date(b: DataFrame, now: datetime) -> Classified:
    key = resolve_key(b.columns, ["DateKey", "Date_Key", "DateID", "Date"])
    return _latest_text(b, key, now, f"Missing {key[0]}")


# ---------------------------------------------------------------------------
# S-01 address: hard rules reject, soft conversion failures reject AND load NULL
# ---------------------------------------------------------------------------
ADDRESS_TEXT = ("AddressLine1", "AddressLine2", "City", "County", "PostcodeArea", "PostcodeDistrict",
                "Region", "Postcode", "Country", "PropertyType", "Tenure", "PropertySizeBand", "PropertyAgeBand")


def silver_address(b: DataFrame, now: datetime) -> Classified:
    keyed, no_key = _missing_key_rejects(b, ["AddressID"], "Missing AddressID")
    lt = latest(keyed, ["AddressID"])

    def soft_int(c: str) -> Column:
        return C.safe_int(c).isNull() & (F.coalesce(F.trim(c), F.lit("")) != "")

    hard = [(C.is_missing("CustomerID"), "Missing CustomerID")]
    soft = [(soft_int("BuildYear"), "Invalid BuildYear"),
            (soft_int("Bedrooms"), "Invalid Bedrooms"),
            (soft_int("HouseSizeSqFt"), "Invalid HouseSizeSqFt"),
            (C.money("RebuildCostEstimate").isNull(), "RebuildCostEstimate not convertible")]
    cls = classify(lt, hard + soft, "first").withColumn("_hard", C.first_reason(hard).isNotNull())
    good = [
        "AddressID", C.blank_to_null("CustomerID").alias("CustomerID"),
        *[C.blank_to_null(c).alias(c) for c in ADDRESS_TEXT],
        C.safe_int("BuildYear").alias("BuildYear"), C.safe_int("Bedrooms").alias("Bedrooms"),
        C.safe_int("HouseSizeSqFt").alias("HouseSizeSqFt"),
        C.money("RebuildCostEstimate").alias("RebuildCostEstimate"),
        "BronzeLoadDts", "SourceFile", _at(now, "SilverLoadDts")]
    raw_cols = ["BuildYear", "Bedrooms", "HouseSizeSqFt", "RebuildCostEstimate"]
    verdict = F.when(F.col("_hard"), F.lit(REJECT)).when(F.col(REASON).isNotNull(), F.lit(BOTH)).otherwise(F.lit(GOOD))
    return classified(cls, good, _reject_out(cls, ["AddressID"], raw_cols, now), verdict, no_key)


# ---------------------------------------------------------------------------
# S-02 broker
# ---------------------------------------------------------------------------
def silver_broker(b: DataFrame, now: datetime, asked: Collection[str] | None = None) -> Classified:
    keyed, no_key = _missing_key_rejects(b, ["BrokerID"], "Missing BrokerID")
    lt = latest(keyed, ["BrokerID"], asked=asked)
    good = [
        "BrokerID", *[C.blank_to_null(c).alias(c) for c in
                      ("BrokerName", "Channel", "Region", "Status", "CommissionModel", "BrokerSizeBand")],
        C.safe_int("AppointmentYear").alias("AppointmentYear"),
        C.safe_int("RelationshipTenureYears").alias("RelationshipTenureYears"),
        C.safe_decimal("CommissionRate", 18, 4).alias("CommissionRate"),
        C.safe_decimal("EstimatedAnnualGWP_GBP").alias("EstimatedAnnualGWP_GBP"),
        "BronzeLoadDts", "SourceFile"]
    return _all_good(lt, good, now, no_key, ["BrokerID", REASON, "BronzeLoadDts", "SourceFile"])


# ---------------------------------------------------------------------------
# S-06 coverage (declared grain PolicyID + CoverageType, or the reference's PolicyID)
# ---------------------------------------------------------------------------
COVERAGE_KEYS = ["PolicyID", "CoverageType"]


def silver_coverage(b: DataFrame, now: datetime, keys: Sequence[str] | None = None,
                    asked: Collection[str] | None = None) -> Classified:
    keys = list(keys) if keys else resolve_key(b.columns, COVERAGE_ID_KEYS, COVERAGE_KEYS)
    keyed, no_key = _missing_key_rejects(b, keys, f"Missing {' or '.join(keys)}")
    lt = latest(keyed, keys, asked=asked)
    good = [
        *keys, *[C.blank_to_null(c).alias(c) for c in ("ExcessBand", "CoverageTier") + (
            () if "CoverageType" in keys else ("CoverageType",))],
        C.safe_decimal("CoverageLimit").alias("CoverageLimit"),
        C.safe_decimal("Excess").alias("Excess"),
        C.flag_yn("IsIncluded").alias("IsIncluded"),
        C.strict_flag("IsIncludedFlag").alias("IsIncludedFlag"),
        C.strict_flag("HighExposureFlag").alias("HighExposureFlag"),
        "BronzeLoadDts", "SourceFile"]
    return _all_good(lt, good, now, no_key, [*keys, REASON, "BronzeLoadDts", "SourceFile"])


# ---------------------------------------------------------------------------
# S-09 operating_expenses: single-or-composite key, W-LATEST-COMP
# ---------------------------------------------------------------------------
def silver_operating_expenses(b: DataFrame, now: datetime) -> Classified:
    keys = resolve_key(b.columns, EXPENSE_KEYS, ["ExpenseMonthStart", "ExpenseCategory"])
    keyed, no_key = _missing_key_rejects(b, keys, "Missing expense key")
    lt = latest(keyed, keys).withColumn("ExpenseKey", key_expr(keys))
    text_cols = [c for c in b.columns if c not in keys and c not in ("BronzeLoadDts", "SourceFile")]
    good = _text_clean(lt, text_cols)
    return _all_good(good, good.columns, now, no_key, [*keys, REASON, "BronzeLoadDts", "SourceFile"])


# ---------------------------------------------------------------------------
# S-10 policy: row-id tie-break, two reject reasons, good = anti-join
# ---------------------------------------------------------------------------
POLICY_DATE_FORMATS = (C.UK, C.ISO, C.YMD_SLASH)


def silver_policy(b: DataFrame, now: datetime, asked: Collection[str] | None = None) -> Classified:
    key = resolve_key(b.columns, POLICY_KEYS)[0]
    b = b.withColumnRenamed(key, "PolicyID")
    keyed, no_key = _missing_key_rejects(b, ["PolicyID"], "Missing PolicyID")
    if asked is not None:
        asked = {*asked, "InceptionDate", "ExpiryDate"}           # the verdict reads them
    lt = latest(keyed, ["PolicyID"], ["BronzeLoadDts", "BronzeRowID"], asked)
    text = lt.select(
        "PolicyID", *[C.blank_to_null(c).alias(c) for c in
                      ("CustomerID", "AddressID", "BrokerID", "ProductType", "PolicyStatus", "PaymentPlan")],
        F.col("InceptionDate").alias("InceptionDateRaw"), F.col("ExpiryDate").alias("ExpiryDateRaw"),
        C.first_date("CreatedDate", POLICY_DATE_FORMATS).alias("CreatedDate"), "BronzeRowID", "BronzeLoadDts", "SourceSystem")
    typed = with_parsed(text, {c: C.first_date(f"{c}Raw", POLICY_DATE_FORMATS) for c in ("InceptionDate", "ExpiryDate")})
    # The reference keeps the latest rows that have no reject on the same key and
    # load (NOT EXISTS).  The rejects are derived from these very rows, so the
    # anti join equals the negated rule on the row itself: no second pass over the
    # source and no extra shuffle.  (``joins.anti`` is the general form.)
    cls = classify(typed, [(F.col("ExpiryDate") < F.col("InceptionDate"), "ExpiryDate before InceptionDate")])
    good = [*[c for c in typed.columns if c not in ("InceptionDateRaw", "ExpiryDateRaw")], _at(now, "SilverLoadDts")]
    rejected = _at(now, "RejectLoadDts")
    reject = ["PolicyID", REASON, "InceptionDateRaw", "ExpiryDateRaw", "BronzeRowID", "BronzeLoadDts", rejected]
    raw = ["PolicyID", REASON, F.col("InceptionDate").alias("InceptionDateRaw"), F.col("ExpiryDate").alias("ExpiryDateRaw"),
           "BronzeRowID", "BronzeLoadDts", rejected]
    return classified(cls, good, reject, _verdict(), no_key, raw)


# ---------------------------------------------------------------------------
# S-11 policy_risk (typed at bronze), S-12 premium_transactions (typed at bronze)
# ---------------------------------------------------------------------------
POLICY_RISK_KEYS = ["PolicyID", "RiskType"]


def silver_policy_risk(b: DataFrame, now: datetime, keys: Sequence[str] = POLICY_RISK_KEYS,
                       asked: Collection[str] | None = None) -> Classified:
    keyed, no_key = _missing_key_rejects(b, list(keys), f"Missing {' or '.join(keys)}")
    good = latest(keyed, list(keys), asked=asked).drop("RiskScoreRaw", "HasAlarmRaw")
    return _all_good(good, good.columns, now, no_key, [*keys, REASON, "BronzeLoadDts"])


def silver_premium_transactions(b: DataFrame, now: datetime, asked: Collection[str] | None = None) -> Classified:
    keys = resolve_key(b.columns, PREMIUM_KEYS, PREMIUM_COMPOSITE)
    keyed, no_key = _missing_key_rejects(b, keys, f"Missing {' or '.join(keys)}")
    good = latest(keyed, keys, asked=asked).drop("TransactionDateRaw", "GrossPremiumRaw", "NetPremiumRaw")
    return _all_good(good, good.columns, now, no_key,
                     [*keys, REASON, "TransactionDateRaw", "GrossPremiumRaw", "NetPremiumRaw", "BronzeLoadDts"])


SILVER = {
    "address": silver_address, "broker": silver_broker, "claim_payments": silver_claim_payments,
    "claim_reserves": silver_claim_reserves, "claims": silver_claims, "coverage": silver_coverage,
    "customer": silver_customer, "date": silver_date, "operating_expenses": silver_operating_expenses,
    "policy": silver_policy, "policy_risk": silver_policy_risk,
    "premium_transactions": silver_premium_transactions,
}

# Entities whose job takes the columns that will be read.
ASKED = ("broker", "claims", "coverage", "customer", "policy", "policy_risk", "premium_transactions")
