"""Distance on a sphere."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The radius in miles and the kilometres in a mile decide every distance.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    north = F.sin(F.radians(lat2 - lat1) / 2)
    east = F.sin(F.radians(lon2 - lon1) / 2)
    chord = north * north + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * east * east
    miles = F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_MILES)
    return miles * KM_PER_MILE if unit == "km" else miles
