"""Null-safe arithmetic, buckets, distance, rates."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles, kilometres per mile.
EARTH_RADIUS_MI = 3961
UNIT_FACTORS = {"mi": 1.0, "km": 1.60934}


def _zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def safe_add(*cols: Column) -> Column:
    return reduce(add, map(_zero_if_null, cols))


def safe_subtract(first: Column, *others: Column) -> Column:
    return reduce(lambda left, right: left - right, map(_zero_if_null, others), _zero_if_null(first))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def width_bucket(value: Column, low: Column, high: Column, buckets: Column) -> Column:
    """Bucket number; a value on a multiple of the bucket size belongs to the bucket above.

    Not the built-in of the same name: below ``low`` this one goes to zero and negative.
    """
    size = (high - low) / buckets
    on_edge = (value.try_cast("decimal(38,9)") % size.try_cast("decimal(38,9)")) == 0
    bucket = F.least(F.ceil((value - low) / size), (buckets + 1).cast("bigint"))
    return F.when(on_edge, 1).otherwise(0) + bucket


def haversine_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    if unit not in UNIT_FACTORS:
        raise ValueError(f"unit must be one of {sorted(UNIT_FACTORS)}, got {unit!r}")

    def half_chord(a: Column, b: Column) -> Column:
        return F.pow(F.sin(F.radians((b - a) / 2)), F.lit(2))

    inner = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    return F.lit(2 * EARTH_RADIUS_MI) * F.asin(F.sqrt(inner)) * F.lit(UNIT_FACTORS[unit])


def goals_per_90(goals: Column, minutes: Column) -> Column:
    return F.when(minutes > 0, F.round(_zero_if_null(goals) / (minutes / 90), 2)).otherwise(F.lit(0.0))
