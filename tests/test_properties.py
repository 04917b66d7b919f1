"""Property tests: expressions against plain-Python computations."""

import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.functions.geo import EARTH_RADIUS_KM, haversine_km
from ridelake.functions.labels import DAYPART_BUCKETS, DAYPART_ELSE, daypart
from ridelake.functions.timefn import iso_day_of_week, minutes_crossed

stamps = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2040, 1, 1))


def py_minutes_crossed(a: dt.datetime, b: dt.datetime) -> int:
    floor = lambda t: t.replace(second=0, microsecond=0)
    return int((floor(b) - floor(a)).total_seconds() // 60)


def py_haversine(lat1, lng1, lat2, lng2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    dp, dl = p2 - p1, math.radians(lng2 - lng1)
    a = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(a))


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(stamps, stamps), min_size=200, max_size=200))
def test_minutes_crossed_and_weekday_match_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = df.select("a", "b", minutes_crossed("a", "b").alias("m"), iso_day_of_week("a").alias("d")).collect()
    for r in got:
        assert r.m == py_minutes_crossed(r.a, r.b)
        assert r.d == r.a.isoweekday()


coords = st.tuples(st.floats(-89, 89), st.floats(-179, 179), st.floats(-89, 89), st.floats(-179, 179))


@settings(max_examples=1, deadline=None)
@given(st.lists(coords, min_size=200, max_size=200))
def test_haversine_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "la1 double, lo1 double, la2 double, lo2 double")
    for r in df.select("*", haversine_km("la1", "lo1", "la2", "lo2").alias("km")).collect():
        assert math.isclose(r.km, py_haversine(r.la1, r.lo1, r.la2, r.lo2), rel_tol=1e-9, abs_tol=1e-6)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.integers(0, 23), min_size=50, max_size=50))
def test_daypart_partitions_the_day(spark, hours):
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    for r in df.select("h", daypart("h").alias("p")).collect():
        want = next((label for lo, hi, label in DAYPART_BUCKETS if lo <= r.h <= hi), DAYPART_ELSE)
        assert r.p == want
