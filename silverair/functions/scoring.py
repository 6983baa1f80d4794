"""Building density, bands and the weighted urbanity score."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverair.functions.text import as_column

# Fixed values of the urbanity score.
DENSITY_BOUNDS = (6, 9, 12, 14)
BUILDING_WEIGHT = Decimal("0.7")
HIGHWAY_WEIGHT = Decimal("0.3")
DEFAULT_RADIUS_M = 300
SCORE_BUCKETS = 5


def density_per_hectare(count: Column | str, radius_m: Column | int = DEFAULT_RADIUS_M) -> Column:
    """Objects per hectare in a circle of ``radius_m`` metres."""
    radius = F.lit(radius_m) if isinstance(radius_m, int) else radius_m
    return as_column(count).try_cast("double") / (F.pi() * radius * radius / F.lit(10000.0))


def band(value: Column | str, bounds: Sequence[float] = DENSITY_BOUNDS) -> Column:
    """1 below the first bound, 2 below the second, …; anything else is the top band."""
    value = as_column(value)
    steps = F.when(value < bounds[0], F.lit(1))
    for level, bound in enumerate(bounds[1:], start=2):
        steps = steps.when(value < bound, F.lit(level))
    return steps.otherwise(F.lit(len(bounds) + 1))


def weighted_score(buildings: Column | str, highways: Column | str) -> Column:
    total = F.lit(BUILDING_WEIGHT) * as_column(buildings) + F.lit(HIGHWAY_WEIGHT) * as_column(highways)
    return F.round(total).cast("int")
