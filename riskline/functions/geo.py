"""Great-circle distance as a JVM-side column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskline.constants import EARTH_RADIUS_KM


def haversine_km(from_lat: Column, from_lon: Column, to_lat: Column, to_lon: Column) -> Column:
    """Distance along the sphere between two points in degrees."""

    def half_chord_squared(degrees: Column) -> Column:
        half = F.sin(F.radians(degrees) / 2)
        return half * half

    along_parallel = F.cos(F.radians(from_lat)) * F.cos(F.radians(to_lat)) * half_chord_squared(to_lon - from_lon)
    half_chord = F.sqrt(half_chord_squared(to_lat - from_lat) + along_parallel)
    # rounding may lift antipodes just above 1, where asin is NaN
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(half_chord, F.lit(1.0)))
