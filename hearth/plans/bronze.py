"""Bronze layer: stamped copies of the raw text.

Ten entities are copied as text with load metadata.  policy_risk (B-11) and
premium_transactions (B-12) are typed at this step, as in the reference.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions import clean as C
from hearth.sources.files import ensure_columns, stamp

# The source system each typed or stamped entity is marked with.
POLICY_SYSTEM = "PolicyCSV"
CALIBRATED_SYSTEM = "CalibratedCSV"


def bronze_copy(raw: DataFrame, entity: str, now: datetime) -> DataFrame:
    """B-01..B-10: clone + copy + stamp."""
    out = stamp(raw, "BronzeLoadDts", now, source_file=f"{entity}.csv")
    if entity == "policy":
        # B-10: a row id (file line) and a source system, no SourceFile
        out = (out.withColumnRenamed("SourceLine", "BronzeRowID") if "SourceLine" in out.columns
               else out.withColumn("BronzeRowID", F.lit(None).cast("bigint")))
        out = stamp(out.drop("SourceFile"), source_system=POLICY_SYSTEM)
    return out


def bronze_policy_risk(raw: DataFrame, now: datetime) -> DataFrame:
    """B-11: typed at bronze (P-02..P-04, P-09, P-09b)."""
    return raw.select(
        C.blank_to_null("PolicyID").alias("PolicyID"),
        C.default_text("RiskType").alias("RiskType"),
        C.safe_decimal("RiskScore", 10, 2).alias("RiskScore"),
        C.flag_yn("HasAlarm").alias("HasAlarm"),
        C.safe_int("PriorClaimsCount").alias("PriorClaimsCount"),
        C.default_text("RiskBand").alias("RiskBand"),
        C.flag01("HasAlarmFlag").alias("HasAlarmFlag"),
        C.default_text("ClaimsHistoryBand").alias("ClaimsHistoryBand"),
        C.safe_decimal("AlarmRiskAdjustment", 10, 2).alias("AlarmRiskAdjustment"),
        C.safe_decimal("ClaimsRiskAdjustment", 10, 2).alias("ClaimsRiskAdjustment"),
        C.safe_decimal("AdjustedRiskScore", 10, 2).alias("AdjustedRiskScore"),
        C.default_text("AdjustedRiskBand").alias("AdjustedRiskBand"),
        C.flag01("HighRiskFlag").alias("HighRiskFlag"),
        C.safe_int("RiskDataCompletenessScore").alias("RiskDataCompletenessScore"),
        F.col("RiskScore").alias("RiskScoreRaw"),
        F.col("HasAlarm").alias("HasAlarmRaw"),
        F.lit(now).cast("timestamp").alias("BronzeLoadDts"),
        F.lit(CALIBRATED_SYSTEM).alias("SourceSystem"),
    )


PREMIUM_OPTIONAL = {"TotalWrittenPremium": "string", "TotalNetWrittenPremium": "string",
                    "IPTRatio": "string", "DiscountRatio": "string", "SourceSystem": "string"}


def bronze_premium_transactions(raw: DataFrame, now: datetime) -> DataFrame:
    """B-12: add missing columns, then type (P-02..P-04, P-07, P-09, P-10)."""
    r = ensure_columns(raw, PREMIUM_OPTIONAL)
    money = lambda c: C.safe_decimal(c).alias(c)
    return r.select(
        C.blank_to_null("PremiumTransactionID").alias("PremiumTransactionID"),
        C.blank_to_null("PolicyID").alias("PolicyID"),
        C.first_date("TransactionDate", (C.ISO, C.UK)).alias("TransactionDate"),
        money("GrossPremium"), money("IPTPremiumTax"), money("AdminFee"), money("Discount"),
        money("NetPremium"),
        C.default_text("TransactionStatus").alias("TransactionStatus"),
        money("CalculatedNetPremium"), money("NetPremiumVariance"),
        C.flag01("PremiumDataQualityFlag").alias("PremiumDataQualityFlag"),
        C.default_text("PremiumBand").alias("PremiumBand"),
        C.safe_int("InstallmentNumber").alias("InstallmentNumber"),
        C.flag01("IsInstallmentPlanFlag").alias("IsInstallmentPlanFlag"),
        C.default_text("TransactionType").alias("TransactionType"),
        C.year_month("YearMonth").alias("YearMonth"),
        C.safe_int("Year").alias("Year"),
        C.safe_int("Month").alias("Month"),
        C.flag01("IsYTDFlag").alias("IsYTDFlag"),
        C.flag01("IsLast12MonthsFlag").alias("IsLast12MonthsFlag"),
        money("TotalWrittenPremium"), money("TotalNetWrittenPremium"),
        C.safe_decimal("IPTRatio", 9, 4).alias("IPTRatio"),
        C.safe_decimal("DiscountRatio", 9, 4).alias("DiscountRatio"),
        F.col("TransactionDate").alias("TransactionDateRaw"),
        F.col("GrossPremium").alias("GrossPremiumRaw"),
        F.col("NetPremium").alias("NetPremiumRaw"),
        F.lit(now).cast("timestamp").alias("BronzeLoadDts"),
        F.coalesce(C.blank_to_null("SourceSystem"), F.lit(CALIBRATED_SYSTEM)).alias("SourceSystem"),
    )


def bronze(raw: DataFrame, entity: str, now: datetime) -> DataFrame:
    if entity == "policy_risk":
        return bronze_policy_risk(raw, now)
    if entity == "premium_transactions":
        return bronze_premium_transactions(raw, now)
    return bronze_copy(raw, entity, now)
