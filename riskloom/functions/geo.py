"""Distance and coordinate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0


def valid_point(lat: Column, long: Column) -> Column:
    """True inside the legal ranges; null coordinates count as invalid."""
    return F.coalesce(lat.between(-90, 90) & long.between(-180, 180), F.lit(False))


def haversine_km(lat1: Column, long1: Column, lat2: Column, long2: Column) -> Column:
    """Great-circle distance in km; 0 when any coordinate is null."""
    half_lat = (F.radians(lat2) - F.radians(lat1)) / 2
    half_long = (F.radians(long2) - F.radians(long1)) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_long), 2
    )
    # rounding may lift the chord a hair above 1 for antipodes
    chord = F.least(chord, F.lit(1.0))
    arc = 2 * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))
    known = lat1.isNotNull() & long1.isNotNull() & lat2.isNotNull() & long2.isNotNull()
    return F.when(known, EARTH_RADIUS_KM * arc).otherwise(F.lit(0.0))
