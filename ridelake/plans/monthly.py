"""Monthly partial aggregates behind the hourly mart and the station statistics.

Both marts are aggregations over the whole fact table.  Instead of scanning
all of it on every load, per-month partials are stored (partitioned by
``year_month``) and only the months a load touched are recomputed -- from
those fact partitions alone.  The marts are then combined from the
partials, which are small: sums and counts combine exactly, and the exact
distinct-station counts combine from per-month presence rows (a station
active in two months is still counted once).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import trips as M

MONTH = "year_month"
HOURLY = "hourly_parts"
STATION_TUPLES = "station_tuples"
HOURLY_STATIONS = "hourly_station_presence"
STATIONS = "station_parts"


def _months(fct: DataFrame, months: Sequence[int] | None) -> DataFrame:
    return fct if months is None else fct.filter(F.col(MONTH).isin(*months))


def hourly_parts(fct: DataFrame) -> DataFrame:
    return fct.groupBy(MONTH, "ride_hour", "is_weekend").agg(*M._exprs({
        "n": "count(1)",
        "member": "count_if(member_casual = 'member')",
        "casual": "count_if(member_casual = 'casual')",
        "min_sum": "sum(ride_duration_minutes)",
        "min_cnt": "count(ride_duration_minutes)",
        "d_cents": M.sum_cents_sql("distance_km"),
        "d_cnt": "count(distance_km)",
    }))


def hourly_station_presence(fct: DataFrame) -> DataFrame:
    """Distinct (month, hour, weekend, role, station) rows."""
    roles = ("inline(array(named_struct('role', 'start', 'station_id', start_station_id), "
             "named_struct('role', 'end', 'station_id', end_station_id)))")
    return (fct.select(MONTH, "ride_hour", "is_weekend", F.expr(roles))
            .filter(F.col("station_id").isNotNull()).distinct())


def station_parts(fct: DataFrame, empty_as_missing: bool = False) -> DataFrame:
    """Per (month, station) start/end statistics (fact rows = staged trips)."""
    sides = "inline(array({}, {}))".format(
        M._role_struct({"station_id": "start_station_id", "member_casual": "member_casual",
                        "ride_duration_minutes": "ride_duration_minutes", "ride_date": "ride_date"}),
        M._role_struct({"station_id": "end_station_id", "member_casual": "CAST(NULL AS STRING)",
                        "ride_duration_minutes": "CAST(NULL AS BIGINT)", "ride_date": "CAST(NULL AS DATE)"}))
    named = "station_id IS NOT NULL" + (" AND station_id != ''" if empty_as_missing else "")
    return M.station_stats(fct.select(MONTH, F.expr(sides)).filter(F.expr(named)), MONTH)


def _write(df: DataFrame, path: str, dynamic: bool) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .option("compression", "zstd").partitionBy(MONTH).parquet(path))


def refresh_parts(spark: SparkSession, fct: DataFrame, root: str, months: Sequence[int] | None = None,
                  empty_as_missing: bool = False) -> None:
    """(Re)compute the partials for ``months`` from the fact table, replacing
    exactly those month partitions; a touched month with no fact rows left
    has its partials removed.  ``months=None`` rebuilds everything."""
    from ..operators.sinks import drop_keys, path_exists
    sub = _months(fct, months)
    for name, build in ((HOURLY, hourly_parts), (HOURLY_STATIONS, hourly_station_presence),
                        (STATIONS, lambda df: station_parts(df, empty_as_missing))):
        _write(build(sub), f"{root}/{name}", dynamic=months is not None)
    if months:
        present = {r[0] for r in sub.select(MONTH).distinct().collect()}  # bounded by the calendar
        gone = [m for m in months if m not in present]
        for name in (HOURLY, HOURLY_STATIONS, STATIONS):
            if path_exists(spark, f"{root}/{name}"):
                drop_keys(spark, f"{root}/{name}", MONTH, gone)


def hourly_from_parts(spark: SparkSession, root: str) -> DataFrame:
    """The hourly mart combined from the monthly partials (same values as
    ``trips.agg_hourly`` over the whole fact table)."""
    parts = spark.read.parquet(f"{root}/{HOURLY}").groupBy("ride_hour", "is_weekend").agg(*M._exprs({
        "total_rides": "sum(n)",
        "member_rides": "sum(member)",
        "casual_rides": "sum(casual)",
        "avg_ride_duration": "round(CAST(sum(min_sum) AS DOUBLE) / sum(min_cnt), 2)",
        "avg_distance_km": "round(sum(d_cents) / 100.0D / sum(d_cnt), 2)",
    }))
    presence = spark.read.parquet(f"{root}/{HOURLY_STATIONS}").groupBy("ride_hour", "is_weekend").agg(*M._exprs({
        "unique_start_stations": "count(DISTINCT CASE WHEN role = 'start' THEN station_id END)",
        "unique_end_stations": "count(DISTINCT CASE WHEN role = 'end' THEN station_id END)",
    }))
    # a group whose station ids are all NULL has no presence row
    return parts.join(presence, ["ride_hour", "is_weekend"], "left").fillna(
        0, ["unique_start_stations", "unique_end_stations"])


def station_stats_from_parts(spark: SparkSession, root: str) -> DataFrame:
    merge = {"first_day": "min", "last_day": "max"}
    return spark.read.parquet(f"{root}/{STATIONS}").groupBy("station_id").agg(
        *M._exprs({c: f"{merge.get(c, 'sum')}({c})" for c in M.STATION_SUMS}))


def station_tuple_parts(raw: DataFrame, empty_as_missing: bool = False) -> DataFrame:
    """Distinct station tuples per month of ``started_at`` (partial distinct
    before the shuffle: a hot station collapses to its few tuples)."""
    from ..functions.timefn import year_month_sql
    return M.station_tuples(raw, empty_as_missing, keep=(F.expr(year_month_sql("started_at")).alias(MONTH),)) \
        .distinct()


def refresh_station_tuples(spark: SparkSession, raw: DataFrame, root: str, months: Sequence[int] | None = None,
                           empty_as_missing: bool = False) -> None:
    """Recompute the stored tuples of ``months`` (all when None) from the raw
    rows started in those months (the raw table is pruned by its month)."""
    sub = raw if months is None else raw.filter(F.col(MONTH).isin(*months))
    from ..operators.sinks import drop_keys
    path = f"{root}/{STATION_TUPLES}"
    if months:  # a month may have lost all its rows
        present = {r[0] for r in sub.select(MONTH).distinct().collect()}
        drop_keys(spark, path, MONTH, [m for m in months if m not in present])
    _write(station_tuple_parts(sub, empty_as_missing), path, dynamic=months is not None)


def stations_from_parts(spark: SparkSession, root: str, coord_decimals: int | None = None) -> DataFrame:
    """Staged stations from the stored tuples; the distinct runs again across
    months, so a tuple seen in two months counts once (as over raw)."""
    t = spark.read.parquet(f"{root}/{STATION_TUPLES}").drop(MONTH).distinct()
    return M.stations_from_tuples(t, coord_decimals)
