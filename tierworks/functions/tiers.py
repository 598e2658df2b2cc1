"""Banding numbers into named tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Lower bounds and labels of the standard tiers.
INCOME_TIERS = [(250000, "High Income"), (100000, "Upper Middle"), (50000, "Middle")]
INCOME_ELSE = "Lower Middle"
CREDIT_TIERS = [(750, "Excellent"), (700, "Good"), (650, "Fair")]
CREDIT_ELSE = "Poor"


def tier(value: Column, bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the highest lower bound that ``value`` reaches; NULL gets ``otherwise``."""
    if not bounds:
        raise ValueError("tier needs at least one bound")
    falling = sorted(bounds, key=lambda b: b[0], reverse=True)
    branches = F
    for minimum, label in falling:
        branches = branches.when(value >= F.lit(minimum), F.lit(label))
    return branches.otherwise(F.lit(otherwise))


def income_tier(value: Column) -> Column:
    return tier(value, INCOME_TIERS, INCOME_ELSE)


def credit_tier(value: Column) -> Column:
    return tier(value, CREDIT_TIERS, CREDIT_ELSE)


def category_map(value: Column, groups: dict[str, Sequence[str]], otherwise: str) -> Column:
    """Group label whose member list holds ``value``."""
    branches = F
    for label, members in groups.items():
        branches = branches.when(value.isin(*members), F.lit(label))
    return branches.otherwise(F.lit(otherwise))
