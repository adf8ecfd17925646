"""Money, rates and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tax rate, the bonus rate and the tier bounds of the source jobs.
TAX_RATE = "0.18"
BONUS_RATE = "0.10"
TIER_BOUNDS = {"budget": 100, "mid-range": 500, "premium": None}


def money(c: Column | str) -> Column:
    """Two exact decimals; sums of these do not depend on row order."""
    column = F.col(c) if isinstance(c, str) else c
    return column.cast("decimal(18,2)")


def tax_on(amount: Column) -> Column:
    return F.round(amount * F.lit(TAX_RATE).cast("decimal(3,2)"), 2).cast("decimal(18,2)")


def bonus_on(amount: Column) -> Column:
    return F.round(amount * F.lit(BONUS_RATE).cast("decimal(3,2)"), 2).cast("decimal(18,2)")


def price_tier(price: Column) -> Column:
    """Tier whose upper bound is the first one not below the price; NULL for none, zero or less."""
    tier = F.when(price <= 0, F.lit(None).cast("string"))
    for name, upper in TIER_BOUNDS.items():
        tier = tier.when(price.isNotNull() if upper is None else price <= upper, name)
    return tier


def salary_band(salary: Column, senior: float, mid: float) -> Column:
    return F.when(salary >= senior, "Senior").when(salary >= mid, "Mid").otherwise("Junior")
