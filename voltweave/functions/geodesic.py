"""Ellipsoidal distance on WGS84 (inverse problem, Vincenty's series), vectorised over Arrow batches.

The iteration has no closed form, so this is a pandas UDF. It is meant for the site dimension
(one row per distinct position), not for the readings table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 semi-major axis (metres) and flattening.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563


def vincenty(lat1, lon1, lat2: float, lon2: float, iterations: int = 12) -> np.ndarray:
    """Distance in metres; a fixed iteration count keeps the result deterministic."""
    semi_minor = SEMI_MAJOR * (1 - FLATTENING)
    u1 = np.arctan((1 - FLATTENING) * np.tan(np.radians(lat1)))
    u2 = np.arctan((1 - FLATTENING) * np.tan(np.radians(lat2)))
    span = np.radians(lon2 - np.asarray(lon1, dtype=float))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = span
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(iterations):
            sin_sigma = np.hypot(c2 * np.sin(lam), c1 * s2 - s1 * c2 * np.cos(lam))
            cos_sigma = s1 * s2 + c1 * c2 * np.cos(lam)
            sigma = np.arctan2(sin_sigma, cos_sigma)
            sin_alpha = np.where(sin_sigma == 0, 0.0, c1 * c2 * np.sin(lam) / sin_sigma)
            cos2_alpha = 1 - sin_alpha**2
            cos_2m = np.where(cos2_alpha == 0, 0.0, cos_sigma - 2 * s1 * s2 / cos2_alpha)
            c = FLATTENING / 16 * cos2_alpha * (4 + FLATTENING * (4 - 3 * cos2_alpha))
            tail = cos_2m + c * cos_sigma * (2 * cos_2m**2 - 1)
            lam = span + (1 - c) * FLATTENING * sin_alpha * (sigma + c * sin_sigma * tail)
    u_sq = cos2_alpha * (SEMI_MAJOR**2 - semi_minor**2) / semi_minor**2
    a = 1 + u_sq / 16384 * (4096 + u_sq * (-768 + u_sq * (320 - 175 * u_sq)))
    b = u_sq / 1024 * (256 + u_sq * (-128 + u_sq * (74 - 47 * u_sq)))
    inner = cos_sigma * (2 * cos_2m**2 - 1) - b / 6 * cos_2m * (4 * sin_sigma**2 - 3) * (4 * cos_2m**2 - 3)
    return semi_minor * a * (sigma - b * sin_sigma * (cos_2m + b / 4 * inner))


def geodesic(lat: Column, lon: Column, ref_lat: float, ref_lon: float) -> Column:
    @F.pandas_udf("double")
    def distance(lat_batch: pd.Series, lon_batch: pd.Series) -> pd.Series:
        return pd.Series(vincenty(lat_batch.to_numpy(), lon_batch.to_numpy(), ref_lat, ref_lon))

    return F.when(lat.isNotNull() & lon.isNotNull(), distance(lat, lon))
