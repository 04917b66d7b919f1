"""Pre-aggregated rollups of the raw table, maintained per month.

Both rollups are stored partitioned by ``year_month`` at a grain that
re-aggregates exactly (counts and minute sums, not averages), so a load only
recomputes the months it touched -- reading just those raw partitions --
and replaces exactly those rollup partitions (dynamic overwrite).  Readers
combine the months; answering from the rollup reads a few rows per day and
station instead of every trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import WEEKEND_DAYS
from ..functions.timefn import iso_dow_sql, minutes_crossed_sql, year_month_sql
from ..operators.sinks import drop_keys, read_raw

MEMBER = "member_by_day"
STATION_HOUR = "station_hour"


def member_rollup_rows(raw: DataFrame) -> DataFrame:
    """(year_month, member, bike, date) -> rides and total crossed minutes."""
    return raw.groupBy(
        F.expr(year_month_sql("started_at")).alias("year_month"),
        "member_casual", "rideable_type", F.to_date("started_at").alias("ride_date"),
    ).agg(F.count(F.lit(1)).alias("total_rides"),
          F.expr(f"sum({minutes_crossed_sql('started_at', 'ended_at')})").alias("total_minutes"))


def station_hour_rollup_rows(raw: DataFrame) -> DataFrame:
    """(year_month, start station, hour, weekend flag) -> rides."""
    days = ", ".join(map(str, WEEKEND_DAYS))
    return raw.groupBy(
        F.expr(year_month_sql("started_at")).alias("year_month"),
        "start_station_id", F.hour("started_at").alias("hour"),
        F.expr(f"{iso_dow_sql('started_at')} IN ({days})").alias("is_weekend"),
    ).agg(F.count(F.lit(1)).alias("ride_count"))


def _write(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy("year_month").parquet(path))


def refresh_rollups(spark: SparkSession, raw_root: str, root: str,
                    months: Sequence[int] | None = None) -> None:
    """Recompute the rollups for ``months`` (all months when None); months left without rows go."""
    raw = read_raw(spark, raw_root, months=months)
    if months:
        present = {r[0] for r in raw.select("year_month").distinct().collect()}  # bounded by the calendar
        for name in (MEMBER, STATION_HOUR):
            drop_keys(spark, f"{root}/{name}", "year_month", [m for m in months if m not in present])
    _write(member_rollup_rows(raw), f"{root}/{MEMBER}")
    _write(station_hour_rollup_rows(raw), f"{root}/{STATION_HOUR}")


def months_of_files(spark: SparkSession, raw_root: str, files: Sequence[str]) -> list[int]:
    """Months that the given source files have rows in (the scan is pruned to
    these files and reads no columns)."""
    raw = read_raw(spark, raw_root).filter(F.col("source_file").isin(*files))
    return sorted(r[0] for r in raw.select("year_month").distinct().collect())


def read_member_rollup(spark: SparkSession, root: str) -> DataFrame:
    """member x bike x date -> rides, mean crossed minutes."""
    df = spark.read.parquet(f"{root}/{MEMBER}")
    return df.groupBy("member_casual", "rideable_type", "ride_date").agg(
        F.sum("total_rides").alias("total_rides"),
        (F.sum("total_minutes") / F.sum("total_rides")).alias("avg_duration"))


def read_station_hour_rollup(spark: SparkSession, root: str) -> DataFrame:
    """start station x hour x weekend flag -> rides, over all months."""
    df = spark.read.parquet(f"{root}/{STATION_HOUR}")
    return df.groupBy("start_station_id", "hour", "is_weekend").agg(F.sum("ride_count").alias("ride_count"))
