from pyspark.sql import functions as F

from ridelake.operators.dedupe import keep_latest, latest_value
from ridelake.plans import trips as M

from helpers import raw_rows, ts


def test_filter_runs_below_keep_latest(spark):
    raw = raw_rows(spark, [
        dict(ride_id="A", started_at=ts("2024-01-05 10:00:00"), ended_at=ts("2024-01-05 10:20:00"),
             loaded_at=ts("2024-02-01 00:00:00")),
        # newest version is invalid (ends before it starts): the older one must survive
        dict(ride_id="A", started_at=ts("2024-01-05 10:00:00"), ended_at=ts("2024-01-05 09:00:00"),
             loaded_at=ts("2024-02-02 00:00:00")),
    ])
    out = M.stg_trips(raw).collect()
    assert len(out) == 1 and out[0]["ride_duration_minutes"] == 20


def test_keep_latest_ties_are_deterministic(spark):
    rows = [dict(ride_id="B", started_at=ts("2024-01-05 10:00:00"), ended_at=ts("2024-01-05 10:05:00"),
                 source_file=f, loaded_at=ts("2024-02-01 00:00:00")) for f in ("a.csv", "b.csv")]
    raw = raw_rows(spark, rows)
    for _ in range(3):
        assert M.stg_trips(raw.repartition(3)).first()["ride_id"] == "B"
    picked = keep_latest(raw, ["ride_id"], ["-loaded_at", "-source_file"]).first()
    assert picked["source_file"] == "b.csv"


def test_latest_value_skips_nulls(spark):
    df = spark.createDataFrame([("S1", "old", 1), ("S1", "new", 2), ("S1", None, 3)], "k string, v string, ver int")
    assert latest_value(df, ["k"], "v", "ver").first()["v"] == "new"


def test_station_dimension_one_sided_stations(spark):
    raw = raw_rows(spark, [
        dict(ride_id="1", started_at=ts("2024-01-05 10:00:00"), ended_at=ts("2024-01-05 10:30:00"),
             start_station_id="S1", end_station_id="S2"),
        dict(ride_id="2", started_at=ts("2024-01-07 10:00:00"), ended_at=ts("2024-01-07 10:10:00"),
             start_station_id="S1", end_station_id="S2", member_casual="casual"),
        # only in an invalid trip: station exists, no staged rides
        dict(ride_id="3", started_at=ts("2024-01-05 10:00:00"), ended_at=ts("2024-01-05 10:00:00"),
             start_station_id="S9", end_station_id="S9", start_station_name="Nine", end_station_name="Nine"),
    ])
    dim = {r["station_id"]: r for r in M.dim_stations(M.stg_stations(raw), M.stg_trips(raw)).collect()}
    s1, s2, s9 = dim["S1"], dim["S2"], dim["S9"]
    assert (s1.total_rides_started, s1.member_rides_started, s1.casual_rides_started, s1.days_active) == (2, 1, 1, 3)
    assert s1.avg_ride_duration_minutes == 20.0
    assert (s2.total_rides_started, s2.total_rides_ended, s2.avg_ride_duration_minutes, s2.first_ride_date) == (0, 2, None, None)
    assert (s9.total_rides, s9.days_active) == (0, None)


def test_station_name_at_latest_load(spark):
    raw = raw_rows(spark, [
        dict(ride_id="1", started_at=ts("2024-01-05 10:00:00"), ended_at=ts("2024-01-05 10:30:00"),
             start_station_name="Old", loaded_at=ts("2024-02-01 00:00:00")),
        dict(ride_id="2", started_at=ts("2024-01-05 11:00:00"), ended_at=ts("2024-01-05 11:30:00"),
             start_station_name="New", loaded_at=ts("2024-02-03 00:00:00")),
    ])
    st = {r["station_id"]: r["station_name"] for r in M.stg_stations(raw).collect()}
    assert st["S1"] == "New"


def test_mart_properties(spark):
    from ridelake.sources.adapter import raw_trips
    from conftest import SF_SMOKE
    raw = raw_trips(spark, SF_SMOKE)
    fct = M.fct_from_raw(raw).persist()
    daily = M.agg_daily(fct)
    n = fct.count()
    assert daily.agg(F.sum("total_rides")).first()[0] == n
    parts = ["morning_rush_rides", "midday_rides", "evening_rush_rides", "evening_rides", "night_rides"]
    assert daily.select(sum(F.col(c) for c in parts).alias("s"), "total_rides").filter("s != total_rides").count() == 0
    assert fct.select("ride_id").distinct().count() == n  # dedupe: one row per key
    stg = M.stg_trips(raw)
    assert M.stg_trips(stg.withColumn("source_file", F.lit("x"))).count() == stg.count()  # idempotent
    hourly = M.agg_hourly(fct)
    assert hourly.agg(F.sum("total_rides")).first()[0] == n
    fct.unpersist()


def test_suite_runner_raises_on_failures(spark):
    import pytest
    from ridelake.operators.quality import ChecksFailed, TableChecks, raise_on_failure, suite
    df = spark.createDataFrame([("a", "member"), ("a", "x"), (None, "casual")], "k string, m string")
    res = suite([TableChecks("t", df, not_null=["k"], unique=["k"], accepted={"m": ["member", "casual"]})])
    got = {(r.column_name, r.check_name): r.failures for r in res.collect()}
    assert got == {("k", "not_null"): 1, ("m", "accepted_values"): 1, ("k", "unique"): 1}
    with pytest.raises(ChecksFailed, match="t.k not_null: 1"):
        raise_on_failure(res)
    ok = suite([TableChecks("t", df.filter("k IS NOT NULL AND m = 'member'"), not_null=["k"])])
    assert raise_on_failure(ok).count() == 1
