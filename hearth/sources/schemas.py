"""Staging file layouts: every column is
nullable text, in file order.  ``load_staging`` reads the reference's twelve
CSV files with these schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from hearth.sources.files import read_raw, split_malformed, text_schema

# The staging column lists of the twelve source files, in file order.
STAGING_COLUMNS = {
    "address": ["AddressID", "CustomerID", "AddressLine1", "AddressLine2", "City", "County", "PostcodeArea",
                "PostcodeDistrict", "Region", "Postcode", "Country", "PropertyType", "Tenure", "BuildYear",
                "Bedrooms", "HouseSizeSqFt", "PropertySizeBand", "PropertyAgeBand", "RebuildCostEstimate"],
    "broker": ["BrokerID", "BrokerName", "Channel", "Region", "Status", "AppointmentYear", "RelationshipTenureYears",
               "CommissionRate", "CommissionModel", "EstimatedAnnualGWP_GBP", "BrokerSizeBand"],
    "claim_payments": ["PaymentID", "ClaimID", "PaymentDate", "PaymentAmount", "PaymentMethod", "PaymentStatus",
                       "ClaimType", "ClaimSeverityBand", "OutstandingReserve", "IncurredAmount", "LargeLossFlag"],
    "claim_reserves": ["ReserveID", "ClaimID", "SnapshotDate", "ReserveAmount", "ReserveStatus", "ReserveType",
                       "PreviousReserve", "ReserveChange", "ReserveMovementType", "LargeReserveFlag",
                       "LatestSnapshotFlag", "ReserveAgeMonths"],
    "claims": ["ClaimID", "PolicyID", "LossDate", "ReportedDate", "ClaimType", "Severity", "ClaimStatus",
               "ReportingDelayDays", "ClosedDate", "ClaimDurationDays", "ReopenedFlag", "FraudFlag", "CatEventFlag",
               "ClaimComplexity"],
    "coverage": ["PolicyID", "CoverageType", "CoverageLimit", "Excess", "IsIncluded", "ExcessBand", "IsIncludedFlag",
                 "CoverageTier", "HighExposureFlag"],
    "customer": ["CustomerID", "FirstName", "LastName", "DateOfBirth", "Gender", "Email", "Phone", "MarketingOptIn",
                 "CreatedDate", "Age", "AgeBand", "CustomerTenureMonths", "CustomerTenureYears", "TenureBand",
                 "HasEmail", "IsValidEmail", "EmailDomain", "HasPhone", "IsValidPhone", "MarketingOptInFlag",
                 "ContactableFlag", "PreferredContactMethod", "VulnerableCustomerFlag", "RecordCompletenessScore",
                 "LifeStageSegment"],
    "operating_expenses": ["ExpenseMonthStart", "ExpenseCategory", "ExpenseAmount", "Currency", "SourceSystem",
                           "ExpenseType", "CostCentre", "ImpactsExpenseRatioFlag", "InflationAdjustedAmount",
                           "ExpenseBand", "YearMonth", "Year", "Month", "PreviousMonthAmount", "MoMVariance",
                           "MoMVarianceFlag"],
    "policy": ["PolicyID", "CustomerID", "AddressID", "BrokerID", "ProductType", "InceptionDate", "ExpiryDate",
               "PolicyStatus", "PaymentPlan", "CreatedDate"],
    "policy_risk": ["PolicyID", "RiskType", "RiskScore", "HasAlarm", "PriorClaimsCount", "RiskBand", "HasAlarmFlag",
                    "ClaimsHistoryBand", "AlarmRiskAdjustment", "ClaimsRiskAdjustment", "AdjustedRiskScore",
                    "AdjustedRiskBand", "HighRiskFlag", "RiskDataCompletenessScore"],
    "premium_transactions": ["PremiumTransactionID", "PolicyID", "TransactionDate", "GrossPremium", "IPTPremiumTax",
                             "AdminFee", "Discount", "NetPremium", "TransactionStatus", "CalculatedNetPremium",
                             "NetPremiumVariance", "PremiumDataQualityFlag", "PremiumBand", "InstallmentNumber",
                             "IsInstallmentPlanFlag", "TransactionType", "YearMonth", "Year", "Month", "IsYTDFlag",
                             "IsLast12MonthsFlag", "TotalWrittenPremium", "TotalNetWrittenPremium", "IPTRatio",
                             "DiscountRatio"],
}


def staging_schema(entity: str) -> StructType:
    if entity == "date":
        from hearth.sources.calendar import STAGING_DATE_COLUMNS
        return text_schema(STAGING_DATE_COLUMNS)
    return text_schema(STAGING_COLUMNS[entity])


def load_staging(spark: SparkSession, path: str, entity: str, max_share: float | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-CSV + SRC-BADROWS for one source file (or folder of files): the good
    rows and the malformed ones, which belong in the reject output."""
    return split_malformed(read_raw(spark, path, staging_schema(entity)), max_share)
