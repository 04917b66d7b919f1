import tempfile

from pyspark.sql import functions as F

from ridelake.operators.sinks import incr_select, write_raw, read_raw
from ridelake.plans import trips as M
from ridelake.plans.incremental import build_daily, read_daily, refresh_daily

from helpers import raw_rows, ts


def _dates(df):
    return sorted(str(r[0]) for r in df.select("ride_date").distinct().collect())


def test_incremental_selectors_null_safe(spark):
    fct = M.fct_from_raw(raw_rows(spark, [
        dict(ride_id=str(i), started_at=ts(f"2024-01-0{i} 10:00:00"), ended_at=ts(f"2024-01-0{i} 10:20:00"))
        for i in (1, 2, 3)]))
    empty = M.agg_daily(fct.limit(0))
    assert len(_dates(incr_select(fct, empty, "ride_date", "exact"))) == 3   # empty target: all rows
    assert len(_dates(incr_select(fct, empty, "ride_date", "watermark"))) == 3
    target = M.agg_daily(fct.filter(F.col("ride_date") < F.lit("2024-01-03").cast("date")))
    assert _dates(incr_select(fct, target, "ride_date", "exact")) == ["2024-01-01", "2024-01-03"]
    assert _dates(incr_select(fct, target, "ride_date", "watermark")) == ["2024-01-02", "2024-01-03"]
    assert _dates(incr_select(fct, None, "ride_date", "exact")) == ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_refresh_moves_corrected_ride_and_drops_empty_date(spark):
    work = tempfile.mkdtemp(prefix="ridelake-incr-")
    root, mart = f"{work}/raw", f"{work}/daily"
    first = raw_rows(spark, [
        dict(ride_id="A", started_at=ts("2024-01-01 10:00:00"), ended_at=ts("2024-01-01 10:20:00"),
             source_file="f1.csv", loaded_at=ts("2024-02-01 00:00:00")),
        dict(ride_id="B", started_at=ts("2024-01-02 10:00:00"), ended_at=ts("2024-01-02 10:20:00"),
             source_file="f1.csv", loaded_at=ts("2024-02-01 00:00:00")),
    ])
    write_raw(first, root)
    build_daily(read_raw(spark, root), mart)
    # correction: ride A really started on Jan 3; a late ride C arrives for Jan 2
    second = raw_rows(spark, [
        dict(ride_id="A", started_at=ts("2024-01-03 10:00:00"), ended_at=ts("2024-01-03 10:40:00"),
             source_file="f2.csv", loaded_at=ts("2024-02-02 00:00:00")),
        dict(ride_id="C", started_at=ts("2024-01-02 12:00:00"), ended_at=ts("2024-01-02 12:10:00"),
             source_file="f2.csv", loaded_at=ts("2024-02-02 00:00:00")),
    ])
    write_raw(second, root)
    raw = read_raw(spark, root)
    empty = refresh_daily(spark, raw, raw.filter(F.col("source_file") == "f2.csv"), mart)
    assert [str(d) for d in empty] == ["2024-01-01"]
    got = {str(r["ride_date"]): r["total_rides"] for r in read_daily(spark, mart).collect()}
    full = {str(r["ride_date"]): r["total_rides"] for r in M.agg_daily(M.fct_from_raw(raw)).collect()}
    assert got == full == {"2024-01-02": 2, "2024-01-03": 1}


def test_rollups_refresh_only_touched_months(spark):
    from ridelake.plans.rollups import (months_of_files, read_member_rollup, read_station_hour_rollup,
                                        refresh_rollups)
    work = tempfile.mkdtemp(prefix="ridelake-rollup-")
    raw_root, root = f"{work}/raw", f"{work}/rollups"
    write_raw(raw_rows(spark, [
        dict(ride_id="1", started_at=ts("2024-01-05 10:00:00"), ended_at=ts("2024-01-05 10:20:00"), source_file="a.csv"),
        dict(ride_id="2", started_at=ts("2024-02-05 10:00:00"), ended_at=ts("2024-02-05 10:40:00"), source_file="a.csv"),
    ]), raw_root)
    refresh_rollups(spark, raw_root, root)
    write_raw(raw_rows(spark, [
        dict(ride_id="3", started_at=ts("2024-02-05 11:00:00"), ended_at=ts("2024-02-05 11:10:00"), source_file="b.csv"),
    ]), raw_root)
    months = months_of_files(spark, raw_root, ["b.csv"])
    assert months == [202402]
    refresh_rollups(spark, raw_root, root, months=months)
    got = {(str(r.ride_date), r.total_rides, r.avg_duration) for r in read_member_rollup(spark, root).collect()}
    assert got == {("2024-01-05", 1, 20.0), ("2024-02-05", 2, 25.0)}
    full = M.rollup_station_hour(read_raw(spark, raw_root)).collect()
    assert sorted(map(tuple, read_station_hour_rollup(spark, root).collect())) == sorted(map(tuple, full))


def test_pipeline_incremental_months_equal_full_build(spark):
    import glob
    import os
    from ridelake.plans.pipeline import Warehouse, build_models
    from ridelake.operators.sinks import write_raw as wr

    def rows(spec):
        return raw_rows(spark, [dict(ride_id=r, started_at=ts(s), ended_at=ts(e), source_file=f,
                                     loaded_at=ts(v), start_station_id=st) for r, s, e, f, v, st in spec])
    first = [("A", "2024-01-31 23:50:00", "2024-02-01 00:10:00", "jan.csv", "2024-03-01 00:00:00", "S1"),
             ("B", "2024-02-10 10:00:00", "2024-02-10 10:30:00", "feb.csv", "2024-03-01 00:00:00", "S2"),
             ("C", "2024-03-05 10:00:00", "2024-03-05 10:05:00", "mar.csv", "2024-03-01 00:00:00", "S1")]
    later = [("A", "2024-02-01 08:00:00", "2024-02-01 08:40:00", "fix.csv", "2024-03-02 00:00:00", "S3"),
             ("D", "2024-02-11 09:00:00", "2024-02-11 09:20:00", "fix.csv", "2024-03-02 00:00:00", "S2")]
    w = tempfile.mkdtemp(prefix="ridelake-pipe-")
    inc, full = Warehouse(w + "/inc"), Warehouse(w + "/full")
    wr(rows(first), inc.raw)
    build_models(spark, inc, new_files=[])
    march_files = sorted(glob.glob(inc.table("fct_rides") + "/year_month=202403/*.parquet"))
    wr(rows(later), inc.raw)
    got = build_models(spark, inc, new_files=["fix.csv"])
    wr(rows(first + later), full.raw)
    want = build_models(spark, full)

    def rows_of(df):
        # float means may differ in the last bits with summation order
        norm = lambda v: round(v, 9) if isinstance(v, float) else v
        return sorted(tuple(norm(v) for v in r) for r in df.select(sorted(df.columns)).collect())

    for name in ("stg_rides", "fct_rides", "stg_stations", "dim_stations", "agg_daily_rides",
                 "agg_hourly_patterns"):
        assert rows_of(got[name]) == rows_of(want[name]), name
    assert {r.ride_id: str(r.ride_date) for r in got["fct_rides"].collect()} == \
        {"A": "2024-02-01", "B": "2024-02-10", "C": "2024-03-05", "D": "2024-02-11"}
    # January lost its only ride (moved to February); March was not rewritten
    assert not os.path.exists(inc.table("fct_rides") + "/year_month=202401")
    assert sorted(glob.glob(inc.table("fct_rides") + "/year_month=202403/*.parquet")) == march_files


def _rows_shuffled(df, group):
    """Rows that the stages of collecting ``df`` shuffle."""
    sc = df.sparkSession.sparkContext
    sc.setJobGroup(group, group)
    try:
        df.collect()
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description"):
            sc.setLocalProperty(key, None)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    tracker = sc.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return sum(sc._jsc.sc().statusStore().lastStageAttempt(s).shuffleWriteRecords() for s in stages)


def test_rows_of_touched_dates_are_not_looked_up_by_ride(spark):
    from ridelake.operators.sinks import touched_keys
    from ridelake.plans.incremental import raw_for_dates
    raw = raw_rows(spark, [
        dict(ride_id=f"{r}", started_at=ts(f"2024-01-0{d} 10:00:00"), ended_at=ts(f"2024-01-0{d} 10:20:00"), source_file=f)
        for r, d, f in [("A", 1, "f1"), ("A", 3, "f2"), ("B", 2, "f1"), ("B", 4, "f1"), ("C", 3, "f1"), ("D", 4, "f1"), ("E", 5, "f2"), ("E", 5, "f1")]])
    day = F.to_date("started_at")
    new = raw.filter("source_file = 'f2'")
    dates = touched_keys(new, raw, "ride_id", day)
    assert sorted(str(r[0]) for r in dates.collect()) == ["2024-01-01", "2024-01-03", "2024-01-05"]
    got = sorted((r.ride_id, r.started_at.day, r.source_file) for r in raw_for_dates(raw, dates).collect())
    assert got == [("A", 1, "f1"), ("A", 3, "f2"), ("C", 3, "f1"), ("E", 5, "f1"), ("E", 5, "f2")]
    one = raw.filter(day == F.lit("2024-01-02").cast("date")).select(day.alias("key"))  # a ride of it is on the 4th, too
    assert sorted((r.ride_id, r.started_at.day) for r in raw_for_dates(raw, one).collect()) == [("B", 2), ("B", 4)]


def test_rows_on_touched_dates_are_not_shuffled_to_be_found(spark):
    from ridelake.operators.sinks import touched_keys
    from ridelake.plans.incremental import raw_for_dates
    raw = raw_rows(spark, [
        dict(ride_id=f"R{i}", started_at=ts(f"2024-01-0{1 + i % 5} 10:00:00"), ended_at=ts(f"2024-01-0{1 + i % 5} 10:20:00"),
             source_file="f2" if i < 5 else "f1") for i in range(400)])
    day = F.to_date("started_at")
    assert _rows_shuffled(touched_keys(raw.filter("source_file = 'f2'"), raw, "ride_id", day), "touched") < 100
    assert _rows_shuffled(raw_for_dates(raw, raw.select(day.alias("key")).distinct()), "rides") < 600  # the ids alone


def test_a_refresh_of_every_date_reads_no_ride_ids_apart(spark, monkeypatch):
    from ridelake.plans import incremental
    work = tempfile.mkdtemp(prefix="ridelake-incr-")
    raw = raw_rows(spark, [
        dict(ride_id=r, started_at=ts(f"2024-01-0{d} 10:00:00"), ended_at=ts(f"2024-01-0{d} 10:20:00"), source_file=f)
        for r, d, f in [("A", 1, "f1"), ("A", 2, "f2"), ("B", 1, "f1"), ("C", 2, "f1"), ("D", 3, "f1")]])
    looked_up = []
    real = incremental.raw_for_dates
    monkeypatch.setattr(incremental, "raw_for_dates", lambda *a: looked_up.append(1) or real(*a))
    for part, times in ((raw.filter("ride_id != 'D'"), 0), (raw, 1)):
        mart = f"{work}/daily-{times}"
        build_daily(part.filter("source_file = 'f1'"), mart)
        assert refresh_daily(spark, part, part.filter("source_file = 'f2'"), mart) == []
        got = {str(r.ride_date): r.total_rides for r in read_daily(spark, mart).collect()}
        assert got == {str(r.ride_date): r.total_rides for r in M.agg_daily(M.fct_from_raw(part)).collect()}
        assert len(looked_up) == times
