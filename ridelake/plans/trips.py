"""The trip models: staged trips and stations, metrics, fact, dimension,
daily / hourly marts and the two raw-table rollups.

Each model is a function from DataFrames to a DataFrame (lazy, like a view);
callers materialise with ``ridelake.operators.sinks``.  Exchanges, by plan:
  stg_trips      one hash exchange on ride_id (partial WindowGroupLimit below it)
  stg_stations   distinct tuples (partial agg) -> station_id (partial agg)
  dim_stations   station_roles agg and stg_stations both end hash-partitioned
                 on station_id, so the left join adds no exchange (AQE may
                 turn it into a broadcast from *measured* sizes)
  agg_daily      one exchange on the five day keys (partial agg, bounded
                 median state: minutes are 1..1440)
  agg_hourly     Expand for the two distinct counts, then partial agg
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import distance_km, nonzero_all, speed_kmh
from ..functions.labels import daypart, distance_category, length_category, weekend_label
from ..functions.timefn import date_parts_sql, minutes_crossed_sql
from ..operators.dedupe import keep_latest
from ..schema import MAX_MINUTES, MIN_MINUTES

STG_TRIP_COLUMNS = [
    "ride_id", "rideable_type", "started_at", "ended_at", "ride_duration_minutes",
    "start_station_name", "start_station_id", "end_station_name", "end_station_id",
    "start_lat", "start_lng", "end_lat", "end_lng", "member_casual",
    "ride_date", "ride_hour", "day_of_week", "ride_month", "ride_year", "loaded_at",
]
METRIC_COLUMNS = [
    "ride_id", "rideable_type", "started_at", "ended_at", "ride_duration_minutes",
    "start_station_id", "end_station_id", "member_casual", "ride_date", "ride_hour",
    "day_of_week", "ride_month", "ride_year", "has_valid_coords", "distance_km",
    "time_of_day", "is_weekend", "avg_speed_kmh",
]
FACT_COLUMNS = [
    "ride_id", "rideable_type", "started_at", "ended_at", "ride_duration_minutes",
    "distance_km", "avg_speed_kmh", "start_station_id", "end_station_id", "member_casual",
    "ride_date", "ride_hour", "day_of_week", "ride_month", "ride_year", "time_of_day",
    "is_weekend", "ride_length_category", "distance_category",
]
# Deterministic tie-break for keep-latest after the version column.
LATEST_ORDER = ["-loaded_at", "-source_file", "-started_at", "-ended_at"]


def valid_trip_sql() -> str:
    m = minutes_crossed_sql("started_at", "ended_at")
    return f"(started_at < ended_at AND {m} BETWEEN {MIN_MINUTES} AND {MAX_MINUTES})"


def stg_trips(raw: DataFrame, dedupe_within_month: bool = False) -> DataFrame:
    """Valid trips, newest version per ride_id, with calendar labels.

    The validity filter runs *below* the keep-latest, so an invalid newest
    version never hides an older valid one.  ``dedupe_within_month`` is a
    caller's assertion that re-loads only duplicate within a month; it adds
    the month to the window key (smaller, partition-local windows).
    """
    valid = raw.filter(F.expr(valid_trip_sql()))
    keys = ["ride_id"]
    if dedupe_within_month:
        valid = valid.withColumn("_ym", F.expr("year(started_at) * 100 + month(started_at)"))
        keys = ["_ym", "ride_id"]
    latest = keep_latest(valid, keys, LATEST_ORDER, tie_break=_rest_desc(valid, keys))
    parts = date_parts_sql("started_at")
    return latest.select(
        *STG_TRIP_COLUMNS[:4],
        F.expr(minutes_crossed_sql("started_at", "ended_at")).alias("ride_duration_minutes"),
        *STG_TRIP_COLUMNS[5:14],
        *_exprs(parts),
        "loaded_at",
    )


def _rest_desc(df: DataFrame, keys) -> list[str]:
    named = {c.lstrip("-") for c in LATEST_ORDER}
    return ["-" + c for c in df.columns if c not in named and c not in keys]


def _role_struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def station_tuples(raw: DataFrame, empty_as_missing: bool = False, keep: tuple = ()) -> DataFrame:
    """(role, station_id, station_name, latitude, longitude, loaded_at), one row
    per role per raw row, produced in a single pass (inline of a 2-struct array);
    ``keep`` carries further columns (or Columns) in front."""
    roles = [_role_struct({"role": f"'{p}'", "station_id": f"{p}_station_id",
                           "station_name": f"{p}_station_name", "latitude": f"{p}_lat",
                           "longitude": f"{p}_lng", "loaded_at": "loaded_at"}) for p in ("start", "end")]
    out = raw.select(*keep, F.expr(f"inline(array({', '.join(roles)}))"))
    cond = "station_id IS NOT NULL AND station_name IS NOT NULL"
    if empty_as_missing:
        cond += " AND station_id != '' AND station_name != ''"
    return out.filter(F.expr(cond))


def stg_stations(raw: DataFrame, empty_as_missing: bool = False, coord_decimals: int | None = None) -> DataFrame:
    """One row per station id: name at the latest load, mean coordinates.

    Means are over *distinct* (id, name, lat, lng, loaded_at) tuples per role,
    as in the reference; the distinct runs with map-side partial aggregation,
    so a hot station id collapses to its few distinct tuples before the shuffle.
    """
    return stations_from_tuples(station_tuples(raw, empty_as_missing=empty_as_missing).distinct(), coord_decimals)


def stations_from_tuples(t: DataFrame, coord_decimals: int | None = None) -> DataFrame:
    """Station rows from distinct (role, id, name, lat, lng, loaded_at) tuples."""
    lat, lng = "avg(latitude)", "avg(longitude)"
    if coord_decimals is not None:
        lat, lng = f"round({lat}, {int(coord_decimals)})", f"round({lng}, {int(coord_decimals)})"
    return t.groupBy("station_id").agg(*_exprs({
        "station_name": "max(struct(loaded_at, station_name)).station_name",
        "latitude": lat,
        "longitude": lng,
    }))


def trip_metrics(stg: DataFrame, speed_guard: str = "exact") -> DataFrame:
    """Distance, speed, day part and weekend label for trips with minutes > 0."""
    return stg.filter(F.col("ride_duration_minutes") > 0).select(
        *METRIC_COLUMNS[:13],
        nonzero_all("start_lat", "start_lng", "end_lat", "end_lng").alias("has_valid_coords"),
        distance_km().alias("distance_km"),
        daypart("ride_hour").alias("time_of_day"),
        weekend_label("day_of_week").alias("is_weekend"),
        speed_kmh(guard=speed_guard).alias("avg_speed_kmh"),
    )


def fct_trips(metrics: DataFrame) -> DataFrame:
    """Trip fact: metrics plus length and distance categories."""
    return metrics.select(
        *FACT_COLUMNS[:17],
        length_category("ride_duration_minutes").alias("ride_length_category"),
        distance_category("distance_km").alias("distance_category"),
    )


def fct_from_raw(raw: DataFrame, speed_guard: str = "exact") -> DataFrame:
    return fct_trips(trip_metrics(stg_trips(raw), speed_guard))


def station_roles(stg: DataFrame, empty_as_missing: bool = False) -> DataFrame:
    """Each staged trip as a 'start' row (with its metrics) and an 'end' row
    (NULL metrics), from one read of the input."""
    start = _role_struct({"station_id": "start_station_id", "direction": "'start'",
                          "member_casual": "member_casual", "ride_duration_minutes": "ride_duration_minutes",
                          "ride_date": "ride_date"})
    end = _role_struct({"station_id": "end_station_id", "direction": "'end'",
                        "member_casual": "CAST(NULL AS STRING)", "ride_duration_minutes": "CAST(NULL AS BIGINT)",
                        "ride_date": "CAST(NULL AS DATE)"})
    cond = "station_id IS NOT NULL" + (" AND station_id != ''" if empty_as_missing else "")
    return stg.select(F.expr(f"inline(array({start}, {end}))")).filter(F.expr(cond))


# Only departures carry a date, a rider type and minutes, so their NULLs tell the sides apart.
STATION_SUMS = {
    "departures": "count(ride_date)",
    "arrivals": "count(1) - count(ride_date)",
    "by_member": "count_if(member_casual = 'member')",
    "by_casual": "count_if(member_casual = 'casual')",
    "minutes": "sum(ride_duration_minutes)",
    "minutes_n": "count(ride_duration_minutes)",
    "first_day": "min(ride_date)",
    "last_day": "max(ride_date)",
}


def station_stats(roles: DataFrame, *more_keys: str) -> DataFrame:
    return roles.groupBy(*more_keys, "station_id").agg(*_exprs(STATION_SUMS))


def _exprs(named: dict[str, str]) -> list[Column]:
    """SQL-text expressions, aliased (one JVM parse each)."""
    return [F.expr(e).alias(n) for n, e in named.items()]


def dim_stations(stations: DataFrame, stg: DataFrame, empty_as_missing: bool = False) -> DataFrame:
    """Station dimension: every staged station, with ride statistics (0 counts
    and NULL metrics when it has no staged rides)."""
    return dim_from_stats(stations, station_stats(station_roles(stg, empty_as_missing)))


def dim_from_stats(stations: DataFrame, stats: DataFrame) -> DataFrame:
    """Stations left-joined to their ride statistics (0 counts, NULL metrics
    for a station without staged rides)."""
    j = stations.join(stats, "station_id", "left")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("departures", "arrivals", "by_member", "by_casual")}
    # fixed values: the output names
    return j.select(
        "station_id", "station_name", "latitude", "longitude",
        n["departures"].alias("total_rides_started"),
        n["arrivals"].alias("total_rides_ended"),
        (n["departures"] + n["arrivals"]).alias("total_rides"),
        n["by_member"].alias("member_rides_started"),
        n["by_casual"].alias("casual_rides_started"),
        F.round(F.expr("try_divide(CAST(minutes AS DOUBLE), minutes_n)"), 2).alias("avg_ride_duration_minutes"),
        F.col("first_day").alias("first_ride_date"), F.col("last_day").alias("last_ride_date"),
        (F.datediff("last_day", "first_day") + 1).alias("days_active"),
    )


def sum_cents_sql(c: str) -> str:
    return f"sum(CAST(rint(`{c}` * 100.0D) AS BIGINT))"


def sum_cents(c: str) -> Column:
    """Exact sum of two-decimal values as whole cents (a long): order-
    independent, and a plain codegen'd long sum (wide-decimal sums cost
    ~2.5x more per row).  Rounding to cents is exact for 2-dp doubles."""
    return F.expr(sum_cents_sql(c))


def sum_2dp_sql(c: str) -> str:
    return f"({sum_cents_sql(c)} / 100.0D)"


def sum_2dp(c: str) -> Column:
    """Exact sum of two-decimal values, as the nearest double."""
    return F.expr(sum_2dp_sql(c))


def mean_2dp_sql(c: str) -> str:
    return f"({sum_2dp_sql(c)} / count(`{c}`))"


def mean_2dp(c: str) -> Column:
    """Mean of two-decimal values: exact sum, then one double division."""
    return F.expr(mean_2dp_sql(c))


DAILY_KEYS = ["ride_date", "day_of_week", "is_weekend", "ride_month", "ride_year"]


def daily_metrics() -> list[Column]:
    tod = "time_of_day"
    return _exprs({
        "total_rides": "count(1)",
        "member_rides": "count_if(member_casual = 'member')",
        "casual_rides": "count_if(member_casual = 'casual')",
        "electric_bike_rides": "count_if(rideable_type = 'electric_bike')",
        "classic_bike_rides": "count_if(rideable_type = 'classic_bike')",
        "avg_ride_duration": "round(avg(ride_duration_minutes), 2)",
        "median_ride_duration": "round(median(ride_duration_minutes), 2)",
        "min_ride_duration": "min(ride_duration_minutes)",
        "max_ride_duration": "max(ride_duration_minutes)",
        "avg_distance_km": f"round({mean_2dp_sql('distance_km')}, 2)",
        "total_distance_km": f"round({sum_2dp_sql('distance_km')}, 2)",
        "avg_speed_kmh": f"round({mean_2dp_sql('avg_speed_kmh')}, 2)",
        "morning_rush_rides": f"count_if({tod} = 'Morning Rush')",
        "midday_rides": f"count_if({tod} = 'Midday')",
        "evening_rush_rides": f"count_if({tod} = 'Evening Rush')",
        "evening_rides": f"count_if({tod} = 'Evening')",
        "night_rides": f"count_if({tod} = 'Night')",
    })


def agg_daily(fct: DataFrame) -> DataFrame:
    """Daily mart: 5 keys + 17 metrics, one row per ride_date.

    Single-level aggregate; the exact median keeps a value->count map per
    day (bounded by the 1..1440 minute domain).  A two-level variant (hash
    aggregate on day x minute, median read off the sorted histogram) was
    measured slower on 8.8M rows over 30 and over 3,650 dates, so it is
    not used.
    """
    return fct.groupBy(*DAILY_KEYS).agg(*daily_metrics())


def agg_hourly(fct: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """Hourly pattern mart by (ride_hour, is_weekend).

    Distinct stations are exact by default; ``approx_rsd`` switches to
    HyperLogLog++ (fixed-size state) for very large inputs.
    """
    if approx_rsd is None:
        us, ue = "count(DISTINCT start_station_id)", "count(DISTINCT end_station_id)"
    else:
        us = f"approx_count_distinct(start_station_id, {float(approx_rsd)!r}D)"
        ue = f"approx_count_distinct(end_station_id, {float(approx_rsd)!r}D)"
    return fct.groupBy("ride_hour", "is_weekend").agg(*_exprs({
        "total_rides": "count(1)",
        "member_rides": "count_if(member_casual = 'member')",
        "casual_rides": "count_if(member_casual = 'casual')",
        "avg_ride_duration": "round(avg(ride_duration_minutes), 2)",
        "avg_distance_km": f"round({mean_2dp_sql('distance_km')}, 2)",
        "unique_start_stations": us,
        "unique_end_stations": ue,
    }))


def rollup_member(raw: DataFrame) -> DataFrame:
    """Raw-table rollup: member x bike x date -> rides, mean crossed minutes.
    Over raw rows: no dedupe, no bounds (as the pre-aggregation is)."""
    return raw.groupBy(
        "member_casual", "rideable_type", F.to_date("started_at").alias("ride_date")
    ).agg(
        F.count(F.lit(1)).alias("total_rides"),
        F.expr(f"avg({minutes_crossed_sql('started_at', 'ended_at')})").alias("avg_duration"),
    )


def rollup_station_hour(raw: DataFrame) -> DataFrame:
    """Raw-table rollup: start station x hour x weekend flag -> rides."""
    from ..functions.labels import WEEKEND_DAYS
    from ..functions.timefn import iso_dow_sql
    days = ", ".join(map(str, WEEKEND_DAYS))
    return raw.groupBy(
        "start_station_id",
        F.hour("started_at").alias("hour"),
        F.expr(f"{iso_dow_sql('started_at')} IN ({days})").alias("is_weekend"),
    ).agg(F.count(F.lit(1)).alias("ride_count"))
