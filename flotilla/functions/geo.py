"""Great-circle distance as native Column expressions (no UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius (km) used by the reference distance.
EARTH_RADIUS_KM = 6372.795477598
DEG_TO_RAD = math.pi / 180.0
# A pair counts as a trip above this distance (km, strict).
MIN_TRIP_KM = 0.1


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km between two (lat, lon) points in degrees.

    The haversine term is clamped to 1 before ``asin``: rounding can push it
    just above 1 for antipodal points, and Spark's ``asin`` then yields NaN,
    which compares greater than every number.
    """
    lat1, lon1, lat2, lon2 = (_c(v) for v in (lat1, lon1, lat2, lon2))
    rad = F.lit(DEG_TO_RAD)
    half_dlat = (lat2 - lat1) * rad / F.lit(2.0)
    half_dlon = (lon2 - lon1) * rad / F.lit(2.0)
    a = (F.pow(F.sin(half_dlat), 2)
         + F.cos(lat1 * rad) * F.cos(lat2 * rad) * F.pow(F.sin(half_dlon), 2))
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def _present(c: Column) -> Column:
    """A coordinate the reference accepts: not NULL and not 0."""
    return c.isNotNull() & (c != F.lit(0.0))


def pair_distance_km(lat1, lon1, lat2, lon2, compat: bool = False) -> Column:
    """Distance of a (start, end) pair, NULL when the pair is not measurable.

    strict (default): every coordinate present and non-zero.
    compat: a missing/zero coordinate becomes 0 (so a missing end measures
    the distance to (0, 0)); the result exists only if the start latitude and
    longitude are both non-zero -- the reference's behaviour.
    """
    lat1, lon1, lat2, lon2 = (_c(v) for v in (lat1, lon1, lat2, lon2))
    if compat:
        z = [F.coalesce(v, F.lit(0.0)) for v in (lat1, lon1, lat2, lon2)]
        ok = (z[0] != F.lit(0.0)) & (z[1] != F.lit(0.0))
        return F.when(ok, haversine_km(*z))
    ok = _present(lat1) & _present(lon1) & _present(lat2) & _present(lon2)
    return F.when(ok, haversine_km(lat1, lon1, lat2, lon2))


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """The same formula as SQL text (both Spark SQL and DuckDB accept it)."""
    rad = "(pi() / 180e0)"
    a = (f"(pow(sin(({lat2} - {lat1}) * {rad} / 2e0), 2) + cos({lat1} * {rad}) * "
         f"cos({lat2} * {rad}) * pow(sin(({lon2} - {lon1}) * {rad} / 2e0), 2))")
    return f"(2e0 * {EARTH_RADIUS_KM!r}e0 * asin(sqrt(least(1e0, {a}))))"


def pair_distance_sql(lat1: str, lon1: str, lat2: str, lon2: str, compat: bool = False) -> str:
    if compat:
        z = [f"coalesce({v}, 0e0)" for v in (lat1, lon1, lat2, lon2)]
        return (f"CASE WHEN {z[0]} <> 0e0 AND {z[1]} <> 0e0 "
                f"THEN {haversine_sql(*z)} END")
    conds = " AND ".join(f"({v} IS NOT NULL AND {v} <> 0e0)" for v in (lat1, lon1, lat2, lon2))
    return f"CASE WHEN {conds} THEN {haversine_sql(lat1, lon1, lat2, lon2)} END"
