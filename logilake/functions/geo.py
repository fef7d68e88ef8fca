"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null if a coordinate is."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    a = F.when(a > 1.0, 1.0).otherwise(a)  # least() would take 1.0 for a null
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def travel_minutes(km: Column, speed_kph: float = 50.0) -> Column:
    return km / F.lit(speed_kph) * 60.0


def metres_to_km(metres: Column) -> Column:
    return metres / 1000.0


def seconds_to_minutes(seconds: Column) -> Column:
    return seconds / 60.0
