"""Null-safe arithmetic, bucketing and distance."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, functions as F

from millrace.functions.columns import as_column

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
UNIT_PER_MILE = {"mi": 1, "km": 1.60934}


def _zero_for_null(fields) -> list[Column]:
    if isinstance(fields, (str, Column)):
        raise TypeError("pass the fields as one list")
    return [F.coalesce(as_column(f), F.lit(0)) for f in fields]


def safe_add(fields) -> Column:
    """Sum of the fields, NULL counting as 0."""
    return reduce(operator.add, _zero_for_null(fields))


def safe_subtract(fields) -> Column:
    """First field minus all later ones, NULL counting as 0."""
    return reduce(operator.sub, _zero_for_null(fields))


def safe_divide(numerator, denominator) -> Column:
    """Quotient, or NULL where the denominator is 0 or NULL."""
    return as_column(numerator) / F.nullif(as_column(denominator), F.lit(0))


def width_bucket(value, low, high, buckets: int) -> Column:
    """Number of the equal-width bucket: 0 below ``low``, ``buckets + 1`` from ``high`` on."""
    return F.width_bucket(as_column(value), as_column(low), as_column(high), F.lit(buckets))


def radians_of(degrees) -> Column:
    return F.radians(as_column(degrees))


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in UNIT_PER_MILE:
        raise ValueError(f"unit must be one of {sorted(UNIT_PER_MILE)}, got {unit!r}")
    lat1, lon1, lat2, lon2 = (as_column(c) for c in (lat1, lon1, lat2, lon2))

    def half_chord(a: Column, b: Column) -> Column:
        return F.pow(F.sin(F.radians((b - a) / 2)), F.lit(2))

    parallel = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    arc = F.asin(F.sqrt(half_chord(lat1, lat2) + parallel * half_chord(lon1, lon2)))
    return arc * (2 * EARTH_RADIUS_MILES) * UNIT_PER_MILE[unit]
