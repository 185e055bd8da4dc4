"""Geographic scalar functions (SC1-SC3, SC28 quadrants).

``parse_point`` and the Euclidean / haversine distances are pure column
expressions.  The ellipsoidal (WGS-84) distance needs an iterative solver; it
is a vectorised Arrow ``pandas_udf`` (numpy over whole batches), the only
Python in the feature path.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from stopcast.semantics import col

# The POINT pattern of the reference, WGS-84 ellipsoid, mean
# Earth radius for haversine.
POINT_PATTERN = r"POINT\s*\(\s*(-?\d+\.?\d*)\s+(-?\d+\.?\d*)\s*\)"
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
EARTH_RADIUS_M = 6371008.8


def parse_point(s: str | Column) -> tuple[Column, Column]:
    """SC1: ``POINT(lon lat)`` text -> (lat, lon); NULL or garbage -> NULL."""
    x = col(s)
    lon = F.nullif(F.regexp_extract(x, POINT_PATTERN, 1), F.lit(""))
    lat = F.nullif(F.regexp_extract(x, POINT_PATTERN, 2), F.lit(""))
    return lat.cast("double"), lon.cast("double")


def euclid_deg(lat1, lon1, lat2, lon2) -> Column:
    """SC3: Euclidean distance in degrees."""
    return F.sqrt(F.pow(col(lat1) - col(lat2), 2) + F.pow(col(lon1) - col(lon2), 2))


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle metres on a sphere (pure-column variant of SC2)."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dp = p2 - p1
    dl = F.radians(col(lon2)) - F.radians(col(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


# Steps that every pair takes (it makes the result reproducible in SQL: all but
# nearly antipodal pairs are at machine precision long before), the change of
# the longitude difference that counts as converged, and the steps after which
# a pair that is not gets NaN.
VINCENTY_ITERS = 20
VINCENTY_TOLERANCE = 1e-11
VINCENTY_MOST = 2000


def _vincenty(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray,
              iters: int = VINCENTY_ITERS) -> np.ndarray:
    """Inverse geodesic distance on WGS-84 (Vincenty 1975), vectorised.

    Each pass computes the auxiliary quantities from the current longitude
    difference on the auxiliary sphere and then updates it; the distance
    uses the quantities of the last pass.  NaN where the passes do not
    converge (nearly antipodal pairs)."""
    a, f = WGS84_A, WGS84_F
    b = a * (1 - f)
    L = np.radians(lon2 - lon1)
    U1 = np.arctan((1 - f) * np.tan(np.radians(lat1)))
    U2 = np.arctan((1 - f) * np.tan(np.radians(lat2)))
    sinU1, cosU1, sinU2, cosU2 = np.sin(U1), np.cos(U1), np.sin(U2), np.cos(U2)
    lam = L.copy()
    with np.errstate(invalid="ignore", divide="ignore"):
        for step in range(max(iters, VINCENTY_MOST)):
            last = lam
            sl, cl = np.sin(lam), np.cos(lam)
            sin_sigma = np.sqrt((cosU2 * sl) * (cosU2 * sl) + (cosU1 * sinU2 - sinU1 * cosU2 * cl) * (cosU1 * sinU2 - sinU1 * cosU2 * cl))
            cos_sigma = sinU1 * sinU2 + cosU1 * cosU2 * cl
            sigma = np.arctan2(sin_sigma, cos_sigma)
            sin_a = np.where(sin_sigma == 0, 0.0, cosU1 * cosU2 * sl / sin_sigma)
            cos2a = 1 - sin_a * sin_a
            cos2sm = np.where(cos2a == 0, 0.0, cos_sigma - 2 * sinU1 * sinU2 / cos2a)
            C = f / 16 * cos2a * (4 + f * (4 - 3 * cos2a))
            lam = L + (1 - C) * f * sin_a * (sigma + C * sin_sigma * (cos2sm + C * cos_sigma * (-1 + 2 * cos2sm * cos2sm)))
            open_ = np.abs(lam - last) > VINCENTY_TOLERANCE
            if step + 1 >= iters and not open_.any():
                break
        u2 = cos2a * (a * a - b * b) / (b * b)
        A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
        B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
        ds = B * sin_sigma * (cos2sm + B / 4 * (cos_sigma * (-1 + 2 * cos2sm * cos2sm)
                                                - B / 6 * cos2sm * (-3 + 4 * sin_sigma * sin_sigma) * (-3 + 4 * cos2sm * cos2sm)))
        # farther than half around the auxiliary sphere: no solution of this iteration
        return np.where(open_ | (np.abs(lam) > np.pi), np.nan, b * A * (sigma - ds))


@F.pandas_udf(DoubleType())
def _geodesic_udf(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    arr = [s.to_numpy(dtype="float64", na_value=np.nan) for s in (lat1, lon1, lat2, lon2)]
    out = _vincenty(*arr)
    out[np.isnan(arr[0]) | np.isnan(arr[1]) | np.isnan(arr[2]) | np.isnan(arr[3])] = np.nan
    return pd.Series(out)


def geodesic_m(lat1, lon1, lat2, lon2) -> Column:
    """SC2: ellipsoidal metres; NULL if either latitude (or longitude) is NULL."""
    d = _geodesic_udf(col(lat1), col(lon1), col(lat2), col(lon2))
    valid = col(lat1).isNotNull() & col(lat2).isNotNull() & col(lon1).isNotNull() & col(lon2).isNotNull()
    return F.when(valid, F.nanvl(d, F.lit(None).cast("double")))


def quadrant(x: str | Column, lo: float, hi: float, n: int = 4) -> Column:
    """SC28: equal-width bin 0..n-1 of x on [lo, hi]."""
    return (F.width_bucket(col(x), F.lit(lo), F.lit(hi), F.lit(n)) - 1).cast("int")
