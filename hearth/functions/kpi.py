"""KPI measures as reusable aggregate/ratio expressions.

Measures are always ratio-of-sums: numerators and denominators are summed
exactly (decimal) at the grain asked for, converted to double once, then
divided.  Division by zero gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the KPI definitions.
LOSS_RATIO_BANDS = ((0.60, "Highly profitable"), (0.80, "Healthy"), (1.00, "Reduced profitability"))
LOSS_RATIO_TOP = "Loss-making"
LOSS_RATIO_COLOURS = ((0.80, "Green"), (1.00, "Amber"))
LOSS_RATIO_COLOUR_TOP = "Red"
COMBINED_RATIO_BANDS = ((0.90, "Highly profitable"), (1.00, "Sustainable profitability"),
                        (1.10, "Marginal profitability"))
COMBINED_RATIO_TOP = "Unprofitable portfolio"
LARGE_CLAIM = 50000
HIGH_RISK_BANDS = ("High", "Very High")
# Claim cost bands (R-23); upper bounds exclusive except the last closed band.
COST_BANDS = ((5000, "£0K–£5K"), (20000, "£5K–£20K"))
COST_BAND_HIGH = "£20K–£50K"
COST_BAND_TOP = "£50K+"
# Property age bands (R-25) by build year.
AGE_BANDS = ((1945, "Pre-1945"), (1980, "1945–1979"), (2000, "1980–1999"))
AGE_BAND_TOP = "2000+"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """A-RATIO: double(num) / double(den); NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def per_thousand(num, den) -> Column:
    return F.try_divide(_c(num).cast("double") * F.lit(1000.0), _c(den).cast("double"))


def money_sum(c) -> Column:
    """Exact sum; 0 instead of NULL when nothing is there."""
    return F.coalesce(F.sum(_c(c)), F.lit(0).cast("decimal(18,2)"))


def band(value, bands, top: str, unknown: str | None = None) -> Column:
    v = _c(value)
    out = None
    for bound, label in bands:
        out = F.when(v < bound, F.lit(label)) if out is None else out.when(v < bound, F.lit(label))
    out = out.otherwise(F.lit(top))
    return F.when(v.isNull(), F.lit(unknown)).otherwise(out) if unknown is not None else out


def loss_ratio_band(lr) -> Column:
    """K-18: <60%, 60-80%, 80-100%, >100% (100% itself is 'Reduced profitability')."""
    v = _c(lr)
    return (F.when(v.isNull(), F.lit(None)).when(v < 0.60, F.lit(LOSS_RATIO_BANDS[0][1]))
             .when(v < 0.80, F.lit(LOSS_RATIO_BANDS[1][1])).when(v <= 1.00, F.lit(LOSS_RATIO_BANDS[2][1]))
             .otherwise(F.lit(LOSS_RATIO_TOP)))


def loss_ratio_colour(lr) -> Column:
    v = _c(lr)
    return (F.when(v.isNull(), F.lit(None)).when(v < 0.80, F.lit("Green")).when(v <= 1.00, F.lit("Amber"))
             .otherwise(F.lit(LOSS_RATIO_COLOUR_TOP)))


def combined_ratio_band(cr) -> Column:
    """K-19: <90%, 90-100%, 100-110%, >110%."""
    v = _c(cr)
    return (F.when(v.isNull(), F.lit(None)).when(v < 0.90, F.lit(COMBINED_RATIO_BANDS[0][1]))
             .when(v <= 1.00, F.lit(COMBINED_RATIO_BANDS[1][1])).when(v <= 1.10, F.lit(COMBINED_RATIO_BANDS[2][1]))
             .otherwise(F.lit(COMBINED_RATIO_TOP)))


def cost_band(paid) -> Column:
    """R-23 / A-BAND: per-claim cost band (over £50k = '£50K+')."""
    v = _c(paid)
    return (F.when(v < 5000, F.lit(COST_BANDS[0][1])).when(v < 20000, F.lit(COST_BANDS[1][1]))
             .when(v <= LARGE_CLAIM, F.lit(COST_BAND_HIGH)).otherwise(F.lit(COST_BAND_TOP)))


def age_band(build_year) -> Column:
    v = _c(build_year)
    return F.when(v.isNull(), F.lit("Unknown")).otherwise(band(v, AGE_BANDS, AGE_BAND_TOP))
