"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Spherical distance; the cosine is clamped so rounding never leaves acos undefined."""
    a, b, turn = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    cosine = F.cos(a) * F.cos(b) * F.cos(turn) + F.sin(a) * F.sin(b)
    clamped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
    return F.lit(EARTH_RADIUS_KM) * F.acos(clamped)
