"""Distances on the globe."""

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371  # fixed value


def _column(c):
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, long1, lat2, long2) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    lat1, long1, lat2, long2 = map(_column, (lat1, long1, lat2, long2))
    half_chord = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(long2 - long1) / 2), 2)
    )
    rest = 1 - half_chord  # rounding can take it below zero between antipodes
    return EARTH_RADIUS_KM * 2 * F.atan2(F.sqrt(half_chord), F.sqrt(F.when(rest < 0, 0.0).otherwise(rest)))
