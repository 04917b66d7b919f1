import os
import tempfile

from pyspark.sql import functions as F

from ridelake.operators.sinks import read_raw
from ridelake.plans import trips as M
from ridelake.plans.incremental import read_daily
from ridelake.schema import CSV_COLUMNS
from ridelake.streaming.ingest import start_daily, start_ingest


def _write(path, rows):
    with open(path, "w") as fh:
        fh.write(",".join(CSV_COLUMNS) + "\n")
        for r in rows:
            base = {c: "" for c in CSV_COLUMNS}
            base.update(rideable_type="classic_bike", member_casual="member", start_station_id="S1",
                        start_station_name="One", end_station_id="S2", end_station_name="Two")
            base.update(r)
            fh.write(",".join(base[c] for c in CSV_COLUMNS) + "\n")


def _trip(i, day, minutes=20, rid=None):
    return {"ride_id": rid or f"R{i}", "started_at": f"2024-01-{day:02d} 10:00:00",
            "ended_at": f"2024-01-{day:02d} 10:{minutes:02d}:00"}


def test_stream_ingest_exactly_once(spark):
    d = tempfile.mkdtemp(prefix="ridelake-stream-")
    landing = os.path.join(d, "in")
    os.makedirs(landing)
    _write(os.path.join(landing, "a.csv"), [_trip(1, 1), _trip(2, 2)])
    run = lambda: start_ingest(spark, landing, d + "/raw", d + "/_chk", loaded_at="2024-02-01 00:00:00").awaitTermination()
    run()
    assert read_raw(spark, d + "/raw").count() == 2
    run()                                             # nothing new: nothing added
    assert read_raw(spark, d + "/raw").count() == 2
    _write(os.path.join(landing, "b.csv"), [_trip(3, 3)])
    run()                                             # only the new file's rows
    raw = read_raw(spark, d + "/raw")
    assert raw.count() == 3
    assert {r.source_file: r.n for r in raw.groupBy("source_file").agg(F.count("*").alias("n")).collect()} == \
        {"a.csv": 2, "b.csv": 1}


def test_stream_daily_with_late_and_corrected_rows_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="ridelake-sdaily-")
    landing = os.path.join(d, "in")
    os.makedirs(landing)
    _write(os.path.join(landing, "a.csv"), [_trip(1, 1), _trip(2, 2), _trip(3, 3)])

    def run(ts):
        start_daily(spark, landing, d + "/raw", d + "/daily", d + "/_chk", loaded_at=ts).awaitTermination()
    run("2024-02-01 00:00:00")
    # later file: a late ride for day 1, and ride R3 corrected from day 3 to day 2
    _write(os.path.join(landing, "b.csv"), [_trip(4, 1, 30), _trip(0, 2, 45, rid="R3")])
    run("2024-02-02 00:00:00")
    got = {str(r.ride_date): (r.total_rides, r.max_ride_duration) for r in read_daily(spark, d + "/daily").collect()}
    full = {str(r.ride_date): (r.total_rides, r.max_ride_duration)
            for r in M.agg_daily(M.fct_from_raw(read_raw(spark, d + "/raw"))).collect()}
    assert got == full == {"2024-01-01": (2, 30), "2024-01-02": (2, 45)}
