"""Positions on the globe as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean radius of the Earth in miles.
EARTH_RADIUS_MILES = 3958.8


def haversine_miles(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Great-circle distance between two positions given in degrees."""
    half_lat = F.sin((F.radians(lat_b) - F.radians(lat_a)) / 2)
    half_lng = F.sin((F.radians(lng_b) - F.radians(lng_a)) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lng * half_lng
    return 2 * EARTH_RADIUS_MILES * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))
