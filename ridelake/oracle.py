"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The views ``events``, ``lineitem``, ``orders``, ... are registered by the
checker.  Trip queries rebuild the raw trips from ``events`` with the same
rules as ``ridelake.sources.adapter``.  Rounding goes through
the shortest decimal text of a double, so ties round exactly as Spark's
``round`` / ``bround`` do.
"""

from __future__ import annotations


def exact(expr: str) -> str:
    """The DOUBLE's shortest decimal text as an exact DECIMAL: Spark rounds
    doubles from that text (``BigDecimal(Double.toString(x))``)."""
    return f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,15))"


def r(expr: str, d: int = 2) -> str:
    """Spark-compatible round(x, d) (half-up) of a DOUBLE expression, as DOUBLE."""
    return f"CAST(round({exact(expr)}, {d}) AS DOUBLE)"


def r_even(expr: str, d: int = 2) -> str:
    """Spark-compatible bround(x, d) (half-even), as DOUBLE."""
    return f"CAST(round_even({exact(expr)}, {d}) AS DOUBLE)"


def dbl(x) -> str:
    return f"CAST({x} AS DOUBLE)"


_NEW = "CASE WHEN event_id % 7 > 3 THEN ' (new)' ELSE '' END"
_SNUM = "(user_id % 50)"
_ENUM = "((user_id * 7 + event_id) % 50)"

RAW_SELECT = f"""
  SELECT
    'R' || CAST(event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END AS VARCHAR) AS ride_id,
    CASE WHEN event_id % 3 = 0 THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
    ts AS started_at,
    ts + to_seconds(CAST(floor(value * CASE WHEN event_type = 'error' THEN {dbl(600)} ELSE {dbl(60)} END) AS BIGINT)) AS ended_at,
    CASE WHEN {_SNUM} <> 0 THEN 'Station ' || CAST({_SNUM} AS VARCHAR) || {_NEW} ELSE '' END AS start_station_name,
    CASE WHEN {_SNUM} <> 0 THEN 'S' || CAST({_SNUM} AS VARCHAR) ELSE '' END AS start_station_id,
    'Station ' || CAST({_ENUM} AS VARCHAR) || {_NEW} AS end_station_name,
    'S' || CAST({_ENUM} AS VARCHAR) AS end_station_id,
    CASE WHEN {_SNUM} <> 0 THEN {dbl(40.7)} + CAST({_SNUM} AS DOUBLE) * {dbl(0.001)} ELSE {dbl(0)} END AS start_lat,
    CASE WHEN {_SNUM} <> 0 THEN {dbl(-74.08)} + CAST({_SNUM} AS DOUBLE) * {dbl(0.001)} ELSE {dbl(0)} END AS start_lng,
    {dbl(40.7)} + CAST({_ENUM} AS DOUBLE) * {dbl(0.0013)} AS end_lat,
    {dbl(-74.08)} + CAST({_ENUM} AS DOUBLE) * {dbl(0.0017)} AS end_lng,
    CASE WHEN event_type IN ('view', 'click') THEN 'member' ELSE 'casual' END AS member_casual,
    'f' || CAST(event_id % 3 AS VARCHAR) || '.csv' AS source_file,
    TIMESTAMP '2024-02-01 00:00:00' + to_hours(CAST(event_id % 7 AS BIGINT)) AS loaded_at,
    event_id
  FROM events"""

RAW_COLS = ("ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id, "
            "end_station_name, end_station_id, start_lat, start_lng, end_lat, end_lng, "
            "member_casual, source_file, loaded_at")

# Cleaner output over the dirty text variants (see adapter.raw_text_from_events):
# NaN / unparseable coordinates -> NULL, NULL text -> '', unparseable time -> NULL.
CLEAN_TYPED = f"""
  SELECT
    CASE WHEN event_id % 101 = 0 THEN '' ELSE ride_id END AS ride_id,
    rideable_type,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE started_at END AS started_at,
    ended_at, start_station_name, start_station_id, end_station_name, end_station_id,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE start_lat END AS start_lat,
    start_lng, end_lat,
    CASE WHEN event_id % 83 = 0 THEN NULL ELSE end_lng END AS end_lng,
    CASE WHEN event_id % 79 = 0 THEN '' ELSE member_casual END AS member_casual,
    source_file, loaded_at, event_id
  FROM raw"""

VALID_BOUNDS = ("started_at IS NOT NULL AND ended_at IS NOT NULL AND started_at < ended_at "
                "AND epoch_us(ended_at) - epoch_us(started_at) BETWEEN 60000000 AND 86400000000")

MINUTES = "date_diff('minute', started_at, ended_at)"

_TIE = ("loaded_at DESC NULLS LAST, source_file DESC NULLS LAST, started_at DESC NULLS LAST, "
        "ended_at DESC NULLS LAST, rideable_type DESC NULLS LAST, start_station_name DESC NULLS LAST, "
        "start_station_id DESC NULLS LAST, end_station_name DESC NULLS LAST, end_station_id DESC NULLS LAST, "
        "start_lat DESC NULLS LAST, start_lng DESC NULLS LAST, end_lat DESC NULLS LAST, "
        "end_lng DESC NULLS LAST, member_casual DESC NULLS LAST")

STG_SELECT = f"""
  SELECT ride_id, rideable_type, started_at, ended_at, {MINUTES} AS ride_duration_minutes,
    start_station_name, start_station_id, end_station_name, end_station_id,
    start_lat, start_lng, end_lat, end_lng, member_casual,
    CAST(started_at AS DATE) AS ride_date,
    CAST(hour(started_at) AS INTEGER) AS ride_hour,
    CAST(isodow(started_at) AS INTEGER) AS day_of_week,
    CAST(month(started_at) AS INTEGER) AS ride_month,
    CAST(year(started_at) AS INTEGER) AS ride_year,
    loaded_at
  FROM raw
  WHERE started_at < ended_at AND {MINUTES} BETWEEN 1 AND 1440
  QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY {_TIE}) = 1"""


def _rad(c: str) -> str:
    return f"({c} * (pi() / {dbl(180)}))"


def haversine(lat1="start_lat", lng1="start_lng", lat2="end_lat", lng2="end_lng") -> str:
    s_lat = f"sin(({_rad(lat2)} - {_rad(lat1)}) / {dbl(2)})"
    s_lng = f"sin(({_rad(lng2)} - {_rad(lng1)}) / {dbl(2)})"
    a = f"({s_lat} * {s_lat} + cos({_rad(lat1)}) * cos({_rad(lat2)}) * {s_lng} * {s_lng})"
    return f"({dbl(12742.0176)} * asin(sqrt({a})))"


def _nz(*cols) -> str:
    return " AND ".join(f"({c} IS NOT NULL AND {c} <> 0)" for c in cols)


VALID4 = _nz("start_lat", "start_lng", "end_lat", "end_lng")
DAYPART = ("CASE WHEN ride_hour BETWEEN 6 AND 9 THEN 'Morning Rush' "
           "WHEN ride_hour BETWEEN 10 AND 15 THEN 'Midday' "
           "WHEN ride_hour BETWEEN 16 AND 19 THEN 'Evening Rush' "
           "WHEN ride_hour BETWEEN 20 AND 23 THEN 'Evening' ELSE 'Night' END")
WEEKEND = "CASE WHEN day_of_week IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END"
LENGTH = ("CASE WHEN ride_duration_minutes <= 30 THEN 'Short (0-30 min)' "
          "WHEN ride_duration_minutes <= 60 THEN 'Medium (30-60 min)' "
          "WHEN ride_duration_minutes <= 120 THEN 'Long (1-2 hours)' ELSE 'Very Long (2+ hours)' END")
DISTCAT = ("CASE WHEN distance_km IS NULL THEN 'Unknown' "
           "WHEN distance_km <= 2 THEN 'Short (0-2 km)' "
           "WHEN distance_km <= 5 THEN 'Medium (2-5 km)' "
           "WHEN distance_km <= 10 THEN 'Long (5-10 km)' ELSE 'Very Long (10+ km)' END")

METRICS_SELECT = f"""
  SELECT ride_id, rideable_type, started_at, ended_at, ride_duration_minutes,
    start_station_id, end_station_id, member_casual, ride_date, ride_hour,
    day_of_week, ride_month, ride_year,
    ({VALID4}) AS has_valid_coords,
    CASE WHEN {VALID4} THEN {r(haversine())} END AS distance_km,
    {DAYPART} AS time_of_day,
    {WEEKEND} AS is_weekend,
    CASE WHEN ride_duration_minutes > 0 AND {_nz('start_lat', 'start_lng')}
      THEN {r(haversine() + ' / (CAST(ride_duration_minutes AS DOUBLE) / ' + dbl(60) + ')')} END AS avg_speed_kmh
  FROM stg WHERE ride_duration_minutes > 0"""

FCT_SELECT = f"""
  SELECT ride_id, rideable_type, started_at, ended_at, ride_duration_minutes,
    distance_km, avg_speed_kmh, start_station_id, end_station_id, member_casual,
    ride_date, ride_hour, day_of_week, ride_month, ride_year, time_of_day, is_weekend,
    {LENGTH} AS ride_length_category,
    {DISTCAT} AS distance_category
  FROM metrics"""


def _tuples(prefix: str) -> str:
    return (f"SELECT DISTINCT '{prefix}' AS role, {prefix}_station_id AS station_id, "
            f"{prefix}_station_name AS station_name, {prefix}_lat AS latitude, "
            f"{prefix}_lng AS longitude, loaded_at FROM raw "
            f"WHERE {prefix}_station_id IS NOT NULL AND {prefix}_station_name IS NOT NULL")


STATIONS_SELECT = f"""
  SELECT station_id,
    (array_agg(station_name ORDER BY loaded_at DESC, station_name DESC))[1] AS station_name,
    {r('avg(latitude)', 6)} AS latitude,
    {r('avg(longitude)', 6)} AS longitude
  FROM ({_tuples('start')} UNION ALL {_tuples('end')}) t
  GROUP BY station_id"""

# each staged trip seen from both of its stations; only the start side carries the measures
ROLES_SELECT = """
  SELECT station_id, direction,
    CASE direction WHEN 'start' THEN member_casual END AS member_casual,
    CASE direction WHEN 'start' THEN ride_duration_minutes END AS ride_duration_minutes,
    CASE direction WHEN 'start' THEN ride_date END AS ride_date
  FROM (SELECT *, CASE direction WHEN 'start' THEN start_station_id ELSE end_station_id END AS station_id
        FROM (SELECT *, unnest(['start', 'end']) AS direction FROM stg))
  WHERE station_id IS NOT NULL"""

DEPARTURES_SELECT = """
  SELECT start_station_id AS id, count(*) AS n, sum((member_casual = 'member')::INT) AS by_member,
    sum((member_casual = 'casual')::INT) AS by_casual, avg(ride_duration_minutes) AS minutes,
    min(ride_date) AS first_day, max(ride_date) AS last_day
  FROM stg GROUP BY 1"""
ARRIVALS_SELECT = "SELECT end_station_id AS id, count(*) AS n FROM stg GROUP BY 1"

# fixed values: the output names of the station dimension
DIM_SELECT = f"""
  SELECT station_id, station_name, latitude, longitude,
    ifnull(o.n, 0) AS total_rides_started, ifnull(i.n, 0) AS total_rides_ended,
    ifnull(o.n, 0) + ifnull(i.n, 0) AS total_rides,
    ifnull(o.by_member, 0)::BIGINT AS member_rides_started, ifnull(o.by_casual, 0)::BIGINT AS casual_rides_started,
    {r('o.minutes')} AS avg_ride_duration_minutes, first_day AS first_ride_date, last_day AS last_ride_date,
    (last_day - first_day + 1)::INTEGER AS days_active
  FROM stations LEFT JOIN departures o ON o.id = station_id LEFT JOIN arrivals i ON i.id = station_id"""

BODIES = {
    "raw": RAW_SELECT,
    "stg": STG_SELECT,
    "metrics": METRICS_SELECT,
    "fct": FCT_SELECT,
    "stations": STATIONS_SELECT,
    "roles": ROLES_SELECT,
    "departures": DEPARTURES_SELECT,
    "arrivals": ARRIVALS_SELECT,
    "dim": DIM_SELECT,
}
DEPS = {"raw": [], "stg": ["raw"], "metrics": ["stg"], "fct": ["metrics"], "stations": ["raw"],
        "roles": ["stg"], "departures": ["stg"], "arrivals": ["stg"],
        "dim": ["stations", "departures", "arrivals"]}


def with_ctes(*names: str, extra: dict[str, str] | None = None, raw_body: str | None = None) -> str:
    """WITH clause for the named model CTEs (plus ``extra`` ones, appended
    last, which may use any model CTE they name in ``names``).

    ``raw_body`` replaces the raw CTE by a query over ``typed`` (the cleaner's
    typed rows of the CSV text form, itself over ``raw0``, the adapter rows).
    """
    order: list[str] = []
    bodies = dict(BODIES)
    if raw_body is not None:
        bodies["raw0"] = RAW_SELECT
        bodies["typed"] = CLEAN_TYPED.replace("FROM raw", "FROM raw0")
        bodies["raw"] = raw_body
        order = ["raw0", "typed"]

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)


    for n in names:
        add(n)
    parts = [f"{n} AS ({bodies[n]}\n)" for n in order]
    parts += [f"{n} AS ({body}\n)" for n, body in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n"


def mean2(c: str) -> str:
    """Mean of 2-decimal values: exact decimal sum, double division."""
    return f"(CAST(sum(CAST({c} AS DECIMAL(20,2))) AS DOUBLE) / count({c}))"


def cnt(pred: str) -> str:
    return f"count(*) FILTER (WHERE {pred})"


DAILY_SELECT = f"""
  SELECT ride_date, day_of_week, is_weekend, ride_month, ride_year,
    count(*) AS total_rides,
    {cnt("member_casual = 'member'")} AS member_rides,
    {cnt("member_casual = 'casual'")} AS casual_rides,
    {cnt("rideable_type = 'electric_bike'")} AS electric_bike_rides,
    {cnt("rideable_type = 'classic_bike'")} AS classic_bike_rides,
    {r('avg(ride_duration_minutes)')} AS avg_ride_duration,
    {r('median(ride_duration_minutes)')} AS median_ride_duration,
    min(ride_duration_minutes) AS min_ride_duration,
    max(ride_duration_minutes) AS max_ride_duration,
    {r(mean2('distance_km'))} AS avg_distance_km,
    {r('CAST(sum(CAST(distance_km AS DECIMAL(20,2))) AS DOUBLE)')} AS total_distance_km,
    {r(mean2('avg_speed_kmh'))} AS avg_speed_kmh,
    {cnt("time_of_day = 'Morning Rush'")} AS morning_rush_rides,
    {cnt("time_of_day = 'Midday'")} AS midday_rides,
    {cnt("time_of_day = 'Evening Rush'")} AS evening_rush_rides,
    {cnt("time_of_day = 'Evening'")} AS evening_rides,
    {cnt("time_of_day = 'Night'")} AS night_rides
  FROM fct
  GROUP BY ride_date, day_of_week, is_weekend, ride_month, ride_year"""


HOURLY_SELECT = f"""
  SELECT ride_hour, is_weekend,
    count(*) AS total_rides,
    {cnt("member_casual = 'member'")} AS member_rides,
    {cnt("member_casual = 'casual'")} AS casual_rides,
    {r('avg(ride_duration_minutes)')} AS avg_ride_duration,
    {r(mean2('distance_km'))} AS avg_distance_km,
    count(DISTINCT start_station_id) AS unique_start_stations,
    count(DISTINCT end_station_id) AS unique_end_stations
  FROM fct GROUP BY ride_hour, is_weekend"""
