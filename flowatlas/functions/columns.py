"""Column expressions shared by the operators.

All of these are built-in Spark expressions, so they stay inside
whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowatlas.schemas import BAND_FAR, BAND_NEAR, BAND_REGIONAL, DISTANCE_BANDS, EARTH_RADIUS_KM


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def share(num, den) -> Column:
    """``num / den`` when ``den > 0``, else null (never a divide-by-zero)."""
    num, den = col(num), col(den)
    return F.when(den > 0, num / den)


def share_or_zero(num, den) -> Column:
    """``num / den`` when ``den > 0``, else 0."""
    num, den = col(num), col(den)
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def not_in_keep_null(c, values) -> Column:
    """``NOT c IN values`` that keeps rows where ``c`` is null."""
    return ~F.coalesce(col(c).isin(list(values)), F.lit(False))


def ne_keep_null(c, value) -> Column:
    """``c != value`` that keeps rows where ``c`` is null."""
    return ~col(c).eqNullSafe(F.lit(value))


def sum0(c) -> Column:
    """Sum that is 0 (not null) over no or only-null values."""
    return F.coalesce(F.sum(col(c)), F.lit(0.0))


def finite_or_null(c) -> Column:
    """NaN and +/-inf become null."""
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(math.inf)), F.lit(None)).otherwise(c)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km on a sphere of radius 6371.0 km."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dphi = F.radians(col(lat2) - col(lat1))
    dlmb = F.radians(col(lon2) - col(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def distance_band(km) -> Column:
    """<1000 Near, <3000 Regional, else Far (3000 itself is Far)."""
    km = col(km)
    return (F.when(km < 1000, F.lit(BAND_NEAR))
            .when(km < 3000, F.lit(BAND_REGIONAL))
            .otherwise(F.lit(BAND_FAR)))


def band_order(band) -> Column:
    """1, 2, 3 for Near, Regional, Far."""
    b = col(band)
    expr = None
    for i, name in enumerate(DISTANCE_BANDS, start=1):
        expr = (F.when(b == name, F.lit(i)) if expr is None else expr.when(b == name, F.lit(i)))
    return expr.cast(T.IntegerType())

