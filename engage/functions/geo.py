"""Great-circle distance as a native expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: mean earth radius in miles.
EARTH_RADIUS_MILES = 3958.8


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in miles; NULL when a coordinate is missing or is not a number."""
    a_lat, a_lon, b_lat, b_lon = [F.radians(c.try_cast("double")) for c in (lat1, lon1, lat2, lon2)]
    half_chord = (
        F.pow(F.sin((b_lat - a_lat) / 2), F.lit(2))
        + F.cos(a_lat) * F.cos(b_lat) * F.pow(F.sin((b_lon - a_lon) / 2), F.lit(2))
    )
    # rounding can push the square a hair over 1 for antipodes
    h = F.when(half_chord > 1, F.lit(1.0)).otherwise(half_chord)
    angle = 2 * F.atan2(F.sqrt(h), F.sqrt(1 - h))
    return F.abs(angle * EARTH_RADIUS_MILES)
