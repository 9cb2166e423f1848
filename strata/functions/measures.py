"""Business measures shared by the gold models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lifetime-revenue bands, highest first; a band starts strictly
# above its bound.
LTV_BANDS = ((10000, "Champion"), (5000, "Loyal"), (1000, "Promising"))
LTV_FLOOR = "At Risk"


def percent_of(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; null when the whole is zero."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole, F.lit(0)), 2)


def ltv_segment(revenue: Column) -> Column:
    """Band of a lifetime revenue; a null revenue falls to the floor."""
    matches = [F.when(revenue > bound, name) for bound, name in LTV_BANDS]
    return F.coalesce(*matches, F.lit(LTV_FLOOR))
