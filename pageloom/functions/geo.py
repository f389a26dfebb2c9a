"""Distances and coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of 6371 km."""
    half = lambda a, b: F.pow(F.sin((F.radians(b) - F.radians(a)) / 2), 2)
    a = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * 6371.0 * F.asin(F.sqrt(a))


def wkt_point(lat: Column, lon: Column) -> Column:
    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat(F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")))


def four_places(x: Column) -> Column:
    return F.when(x.isNull(), "").otherwise(F.format_string("%.4f", x))
