"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: equatorial radius in km.
EARTH_RADIUS_KM = 6378.137


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Distance in km between two points given in degrees, rounded to four decimals."""
    a1, a2 = F.radians(lat1), F.radians(lat2)
    dlat, dlng = a1 - a2, F.radians(lng1) - F.radians(lng2)
    h = F.pow(F.sin(dlat / 2), F.lit(2)) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(dlng / 2), F.lit(2))
    return F.round(F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h))) * 2 * EARTH_RADIUS_KM, 4)
