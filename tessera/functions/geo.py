"""Distances on the sphere, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the sphere's radius in metres.
RADIUS_M = 6_371_000.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; null if any coordinate is."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * RADIUS_M * F.asin(F.sqrt(F.when(a.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), a)))))


def within(lat1: Column, lon1: Column, lat2: Column, lon2: Column, metres: float) -> Column:
    return F.coalesce(haversine_m(lat1, lon1, lat2, lon2) <= metres, F.lit(False))
