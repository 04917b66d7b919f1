"""Great-circle distance and speed as native (codegen'd) expressions.

Expressions are built as SQL text and parsed once (``F.expr``): the same
plan as composing Column objects, but one call into the JVM instead of
dozens per expression.  Arguments are column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import q

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0088


def _rad(c: str) -> str:
    return f"({q(c)} * (pi() / 180.0D))"


def haversine_sql(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    s_lat = f"sin(({_rad(lat2)} - {_rad(lat1)}) / 2.0D)"
    s_lng = f"sin(({_rad(lng2)} - {_rad(lng1)}) / 2.0D)"
    a = f"{s_lat} * {s_lat} + cos({_rad(lat1)}) * cos({_rad(lat2)}) * {s_lng} * {s_lng}"
    return f"({2.0 * EARTH_RADIUS_KM!r}D * asin(sqrt(if({a} > 1.0D, 1.0D, {a}))))"


def haversine_km(lat1: str, lng1: str, lat2: str, lng2: str) -> Column:
    """Haversine distance in kilometres (NULL if any input is NULL)."""
    return F.expr(haversine_sql(lat1, lng1, lat2, lng2))


# The WGS 84 ellipsoid, equatorial radius in kilometres and flattening.
EQUATOR_KM, FLATTENING = 6378.137, 1 / 298.257223563


def ellipsoid_sql(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    """Lambert's formula: the angle between the reduced latitudes, corrected to first order of the flattening."""
    f = f"{FLATTENING!r}D"
    b1, b2 = (f"atan((1.0D - {f}) * tan({_rad(c)}))" for c in (lat1, lat2))
    s_lat, s_lng = f"sin(({b2} - {b1}) / 2.0D)", f"sin(({_rad(lng2)} - {_rad(lng1)}) / 2.0D)"
    a = f"({s_lat} * {s_lat} + cos({b1}) * cos({b2}) * {s_lng} * {s_lng})"
    angle = f"(2.0D * asin(sqrt(if({a} > 1.0D, 1.0D, {a}))))"
    p, q_ = f"(({b1} + {b2}) / 2.0D)", f"(({b2} - {b1}) / 2.0D)"
    # at no distance, or half around the globe, a term is 0 / 0: it counts as 0
    x = f"coalesce(({angle} - sin({angle})) * pow(sin({p}) * cos({q_}), 2) / nullif(pow(cos({angle} / 2.0D), 2), 0.0D), 0.0D)"
    y = f"coalesce(({angle} + sin({angle})) * pow(cos({p}) * sin({q_}), 2) / nullif(pow(sin({angle} / 2.0D), 2), 0.0D), 0.0D)"
    known = " AND ".join(f"{q(c)} IS NOT NULL" for c in (lat1, lng1, lat2, lng2))
    return f"CASE WHEN {known} THEN {EQUATOR_KM!r}D * ({angle} - {f} / 2.0D * ({x} + {y})) END"


def ellipsoid_km(lat1: str, lng1: str, lat2: str, lng2: str) -> Column:
    """Distance on the ellipsoid in kilometres (NULL if any input is NULL): within
    some 20 m of the geodesic in 1000 km, where ``haversine_km`` is off by up to half a percent."""
    return F.expr(ellipsoid_sql(lat1, lng1, lat2, lng2))


def nonzero_sql(*cols: str) -> str:
    return "(" + " AND ".join(f"({q(c)} IS NOT NULL AND {q(c)} != 0.0D)" for c in cols) + ")"


def nonzero_all(*cols: str) -> Column:
    """True when every value is non-NULL and non-zero (0 is the "missing"
    coordinate sentinel); never NULL."""
    return F.expr(nonzero_sql(*cols))


def distance_km(start_lat="start_lat", start_lng="start_lng", end_lat="end_lat",
                end_lng="end_lng", decimals: int = 2) -> Column:
    """Trip distance, rounded; NULL unless all four coordinates are valid."""
    guard = nonzero_sql(start_lat, start_lng, end_lat, end_lng)
    km = haversine_sql(start_lat, start_lng, end_lat, end_lng)
    return F.expr(f"CASE WHEN {guard} THEN round({km}, {int(decimals)}) END")


def speed_kmh(minutes="ride_duration_minutes", start_lat="start_lat", start_lng="start_lng",
              end_lat="end_lat", end_lng="end_lng", guard: str = "exact", decimals: int = 2) -> Column:
    """Average speed km/h = km / (minutes / 60), rounded.

    ``guard="exact"`` checks positive minutes and the *start* coordinates
    only (as the reference model does); ``guard="all"`` also requires valid
    end coordinates, so a missing end point cannot produce a speed.
    """
    if guard == "exact":
        ok = nonzero_sql(start_lat, start_lng)
    elif guard == "all":
        ok = nonzero_sql(start_lat, start_lng, end_lat, end_lng)
    else:
        raise ValueError(f"guard must be 'exact' or 'all', got {guard!r}")
    km = haversine_sql(start_lat, start_lng, end_lat, end_lng)
    m = q(minutes)
    return F.expr(f"CASE WHEN {m} > 0 AND {ok} THEN round({km} / (CAST({m} AS DOUBLE) / 60.0D), "
                  f"{int(decimals)}) END")
