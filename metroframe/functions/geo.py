"""GEO-1/GEO-2: points as two double columns and great-circle distance."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius in metres (IUGG); a parameter everywhere it is used.
EARTH_RADIUS_M = 6371008.8


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point(lon, lat) -> Column:
    """A point as a struct of (lon, lat), both doubles."""
    return F.struct(_col(lon).cast("double").alias("lon"), _col(lat).cast("double").alias("lat"))


def haversine_m(lat1, lon1, lat2, lon2, radius_m: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres on a sphere; null when any input is null.

    Column names are turned into one SQL expression (parsed once in the JVM);
    Column arguments are combined with the function API.
    """
    if all(isinstance(c, str) for c in (lat1, lon1, lat2, lon2)):
        q = [f"`{c}`" for c in (lat1, lon1, lat2, lon2)]
        return F.expr(haversine_sql(*q, radius_m=radius_m))
    phi1, phi2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_dphi = (phi2 - phi1) / 2.0
    half_dlmb = (F.radians(_col(lon2)) - F.radians(_col(lon1))) / 2.0
    a = F.pow(F.sin(half_dphi), 2.0) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlmb), 2.0)
    return F.lit(2.0 * radius_m) * F.asin(F.sqrt(a))


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius_m: float = EARTH_RADIUS_M) -> str:
    """The same formula as SQL text (Spark SQL and DuckDB agree on it)."""
    return (
        f"({2.0 * radius_m!r}e0 * asin(sqrt("
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2.0e0), 2.0e0) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * "
        f"pow(sin((radians({lon2}) - radians({lon1})) / 2.0e0), 2.0e0))))"
    )


def lat_step_deg(radius_m: float, earth_radius_m: float = EARTH_RADIUS_M) -> float:
    """Latitude span (degrees) that no pair within ``radius_m`` can exceed."""
    return math.degrees(radius_m / earth_radius_m)
