import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridelake.functions.fmt import human_quantity, human_size
from ridelake.functions.geo import distance_km, haversine_km, speed_kmh
from ridelake.functions.labels import daypart, distance_category, length_category, weekend_label
from ridelake.functions.timefn import elapsed_seconds, iso_day_of_week, minutes_crossed, year_month

from helpers import ts


def one(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_minutes_crossed_counts_boundaries(spark):
    df = spark.createDataFrame([(ts("2024-01-01 10:00:59"), ts("2024-01-01 10:02:01")),
                                (ts("2024-01-01 23:59:30"), ts("2024-01-02 00:00:10")),
                                (ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:59.999"))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert one(df, minutes_crossed("a", "b")) == [2, 1, 0]
    assert one(df, F.timestamp_diff("MINUTE", F.col("a"), F.col("b"))) == [1, 0, 0]


def test_minutes_crossed_ignores_session_zone(spark):
    df = spark.createDataFrame([(ts("2024-03-10 01:59:00"), ts("2024-03-10 03:01:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(df, minutes_crossed("a", "b")) == [62]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_iso_weekday_and_month_key(spark):
    days = [dt.datetime(2024, 1, d) for d in (5, 6, 7, 8)]  # Fri Sat Sun Mon
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz").withColumn("dow", iso_day_of_week("t"))
    assert one(df, "dow") == [5, 6, 7, 1]
    assert one(df, weekend_label("dow")) == ["Weekday", "Weekend", "Weekend", "Weekday"]
    assert one(df, year_month("t")) == [202401] * 4


def test_daypart_edges(spark):
    hours = [0, 5, 6, 9, 10, 15, 16, 19, 20, 23, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    assert one(df, daypart("h")) == ["Night", "Night", "Morning Rush", "Morning Rush", "Midday", "Midday",
                                     "Evening Rush", "Evening Rush", "Evening", "Evening", "Night"]


def test_length_and_distance_edges(spark):
    df = spark.createDataFrame([(m,) for m in (30, 31, 60, 61, 120, 121)], "m long")
    assert one(df, length_category("m")) == ["Short (0-30 min)", "Medium (30-60 min)", "Medium (30-60 min)",
                                             "Long (1-2 hours)", "Long (1-2 hours)", "Very Long (2+ hours)"]
    df = spark.createDataFrame([(k,) for k in (2.0, 2.01, 5.0, 10.0, 10.5, None)], "k double")
    assert one(df, distance_category("k")) == ["Short (0-2 km)", "Medium (2-5 km)", "Medium (2-5 km)",
                                               "Long (5-10 km)", "Very Long (10+ km)", "Unknown"]


def test_haversine_and_guards(spark):
    df = spark.createDataFrame(
        [(40.0, -74.0, 41.0, -74.0, 60), (0.0, -74.0, 41.0, -74.0, 60), (40.0, -74.0, 0.0, 0.0, 60),
         (None, -74.0, 41.0, -74.0, 60), (40.0, -74.0, 41.0, -74.0, 0)],
        "start_lat double, start_lng double, end_lat double, end_lng double, ride_duration_minutes long")
    km = one(df, haversine_km("start_lat", "start_lng", "end_lat", "end_lng"))
    assert km[0] == pytest.approx(111.195, abs=1e-3)  # one degree of latitude
    assert one(df, distance_km()) == [111.2, None, None, None, 111.2]
    exact = one(df, speed_kmh(guard="exact"))
    assert exact[0] == 111.2 and exact[1] is None and exact[2] is not None and exact[4] is None
    assert one(df, speed_kmh(guard="all"))[2] is None


def test_elapsed_seconds(spark):
    df = spark.createDataFrame([(ts("2024-01-01 10:00:00"), ts("2024-01-01 10:01:00.5"))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert one(df, elapsed_seconds("a", "b")) == [60.5]


def test_human_readable(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1000.0, 1024.0, 1536.0, 1048576.0, 5.5 * 1024 ** 4, None)],
                               "x double")
    assert one(df, human_size("x")) == ["0.00 B", "1000.00 B", "1.00 KiB", "1.50 KiB", "1.00 MiB",
                                        "5.50 TiB", None]
    df = spark.createDataFrame([(x,) for x in (12.0, 950000.0, 1234567.0, 2.5e9)], "x double")
    assert one(df, human_quantity("x")) == ["12.00", "950.00 thousand", "1.23 million", "2.50 billion"]
