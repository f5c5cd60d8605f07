"""Great-circle distance as a plain column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    phi1, phi2 = F.radians(lat1.cast("double")), F.radians(lat2.cast("double"))
    half_lat = (phi2 - phi1) / 2
    half_lon = (F.radians(lon2.cast("double")) - F.radians(lon1.cast("double"))) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_lon), 2)
    return F.asin(F.least(F.lit(1.0), F.sqrt(chord))) * (2 * EARTH_RADIUS_KM)
