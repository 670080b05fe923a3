"""Great-circle distance."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._cols import ColumnOrName, col

# Fixed value: mean Earth radius in km used for haversine distances.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = math.pi * EARTH_RADIUS_KM / 180.0


def haversine_km(
    lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName
) -> Column:
    """Haversine distance in km between two points given in degrees.

    The haversine term is clamped to 1 so rounding can not push ``asin`` past
    its domain (which would give NaN for near-antipodal points).
    """
    la1, lo1, la2, lo2 = col(lat1), col(lon1), col(lat2), col(lon2)
    h = F.pow(F.sin(F.radians(la2 - la1) / 2), 2) + F.cos(F.radians(la1)) * F.cos(
        F.radians(la2)
    ) * F.pow(F.sin(F.radians(lo2 - lo1) / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
