"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km of points in degrees."""
    half = lambda a, b: F.pow(F.sin((F.radians(b) - F.radians(a)) / 2), 2)
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
