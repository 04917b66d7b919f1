"""Loads under awkward inputs: name clashes, odd names, quoting, zip archives, reloads, crashes."""

import io
import os
import tempfile
import zipfile

import pytest

from ridelake.operators.medians import median_by_counts
from ridelake.operators.sinks import committed_files, ledger, load_trip_files, read_raw
from ridelake.plans import pipeline as P
from ridelake.plans.incremental import read_daily
from ridelake.plans.rollups import read_member_rollup
from ridelake.schema import CSV_COLUMNS
from ridelake.session import checkpoint_root
from ridelake.streaming.ingest import start_ingest


def record(ride, start="2024-01-05 10:00:00", end="2024-01-05 10:30:00", **other):
    row = dict.fromkeys(CSV_COLUMNS, "") | {"ride_id": ride, "rideable_type": "classic_bike", "started_at": start, "ended_at": end,
                                            "member_casual": "member", "start_station_id": "S1", "end_station_id": "S2",
                                            "start_station_name": "One", "end_station_name": "Two"}
    return row | other


def quoted(v):
    return '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\n') else v


def text(rows, columns=CSV_COLUMNS):
    return ",".join(columns) + "\n" + "".join(",".join(quoted(r[c]) for c in columns) + "\n" for r in rows)


def put(path, rows, columns=CSV_COLUMNS):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text(rows, columns))
    return path


@pytest.fixture
def d():
    return tempfile.mkdtemp(prefix="ridelake-load-")


def rides(spark, root):
    return sorted(r.ride_id for r in read_raw(spark, root).collect())


def test_same_base_name_is_never_dropped(spark, d):
    a, b = put(f"{d}/in/x1/t.csv", [record("A")]), put(f"{d}/in/x2/t.csv", [record("B")])
    with pytest.raises(ValueError, match="two files named"):
        load_trip_files(spark, [a, b], f"{d}/raw0")
    load_trip_files(spark, [a], f"{d}/raw1")
    with pytest.raises(ValueError, match="was loaded from"):
        load_trip_files(spark, [b], f"{d}/raw1")
    assert load_trip_files(spark, [a, b], f"{d}/raw", landing=f"{d}/in")["loaded"] == ["x1/t.csv", "x2/t.csv"]
    assert rides(spark, f"{d}/raw") == ["A", "B"]
    assert load_trip_files(spark, [a, b], f"{d}/raw", landing=f"{d}/in")["skipped"] == ["x1/t.csv", "x2/t.csv"]


def test_odd_file_names(spark, d):
    names = ["a b.csv", "a%20b.csv", "a+b.csv", "c%.csv", "é.csv"]
    paths = [put(f"{d}/in/{n}", [record(f"R{i}")]) for i, n in enumerate(names)]
    assert load_trip_files(spark, paths, f"{d}/raw", landing=f"{d}/in")["loaded"] == sorted(names)
    assert {(r.source_file, r.rows) for r in committed_files(spark, f"{d}/raw").collect()} == {(n, 1) for n in names}
    assert {r.source_file: r.ride_id for r in read_raw(spark, f"{d}/raw").collect()} == {n: f"R{i}" for i, n in enumerate(names)}
    load_trip_files(spark, paths, f"{d}/raw", landing=f"{d}/in", skip_committed=False)
    assert len(rides(spark, f"{d}/raw")) == 5


def test_reload_drops_rows_the_file_no_longer_has(spark, d):
    path = put(f"{d}/t.csv", [record("A"), record("B"), record("C", "2024-02-05 10:00:00", "2024-02-05 10:30:00")])
    wh = P.Warehouse(f"{d}/wh")
    P.run_pipeline(spark, [path], wh.root, loaded_at="2024-03-01 00:00:00")
    put(path, [record("A", "2024-03-05 10:00:00", "2024-03-05 10:30:00"), record("C", "2024-02-06 10:00:00", "2024-02-06 10:30:00")])
    P.run_pipeline(spark, [path], wh.root, loaded_at="2024-03-02 00:00:00", reload=True)
    assert rides(spark, wh.raw) == ["A", "C"]
    assert sorted(str(r.ride_date) for r in read_daily(spark, wh.table("agg_daily_rides")).collect()) == ["2024-02-06", "2024-03-05"]
    assert sorted(str(r.ride_date) for r in read_member_rollup(spark, wh.table("rollups")).collect()) == ["2024-02-06", "2024-03-05"]
    for name in ("stg_rides", "fct_rides"):
        assert sorted(r.year_month for r in spark.read.parquet(wh.table(name)).collect()) == [202402, 202403]


def test_crashed_reload_is_made_up_for(spark, d, monkeypatch):
    from ridelake.operators import sinks
    path = put(f"{d}/t.csv", [record("A"), record("B", "2024-02-05 10:00:00", "2024-02-05 10:30:00")])
    wh = P.Warehouse(f"{d}/wh")
    P.run_pipeline(spark, [path], wh.root, loaded_at="2024-03-01 00:00:00")
    put(path, [record("A")])
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_raw", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_trip_files(spark, [path], wh.raw, skip_committed=False)
    assert committed_files(spark, wh.raw).count() == 0 and ledger(spark, wh.raw).count() == 1
    P.run_pipeline(spark, [path], wh.root, loaded_at="2024-03-02 00:00:00")
    assert rides(spark, wh.raw) == ["A"]
    assert [r.ride_id for r in spark.read.parquet(wh.table("fct_rides")).collect()] == ["A"]


@pytest.mark.parametrize("step", ["write_by_month", "refresh_rollups", "hourly_from_parts"])
def test_build_that_died_is_made_up_for(spark, d, step, monkeypatch):
    jan = put(f"{d}/jan.csv", [record("A"), record("B", "2024-01-20 10:00:00", "2024-01-20 10:10:00")])
    feb = put(f"{d}/feb.csv", [record("A", "2024-02-05 10:00:00", "2024-02-05 10:30:00"), record("C", "2024-02-07 08:00:00", "2024-02-07 08:30:00")])
    mar = put(f"{d}/mar.csv", [record("D", "2024-03-05 10:00:00", "2024-03-05 10:30:00")])
    wh = P.Warehouse(f"{d}/wh")
    P.run_pipeline(spark, [jan], wh.root, loaded_at="2024-03-01 00:00:00")
    load_trip_files(spark, [jan, feb], wh.raw, loaded_at="2024-03-02 00:00:00")  # no build follows
    with monkeypatch.context() as m:
        m.setattr(P, step, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            P.build_models(spark, wh)
    P.run_pipeline(spark, [jan, feb, mar], wh.root, loaded_at="2024-03-03 00:00:00")
    got = sorted((r.ride_id, str(r.ride_date)) for r in spark.read.parquet(wh.table("fct_rides")).collect())
    assert got == [("A", "2024-02-05"), ("B", "2024-01-20"), ("C", "2024-02-07"), ("D", "2024-03-05")]
    daily = {str(r.ride_date): r.total_rides for r in read_daily(spark, wh.table("agg_daily_rides")).collect()}
    assert daily == {"2024-01-20": 1, "2024-02-05": 1, "2024-02-07": 1, "2024-03-05": 1}
    assert P.unconsumed(spark, wh).count() == 0
    assert spark.read.parquet(wh.table("agg_hourly_patterns")).agg({"total_rides": "sum"}).first()[0] == 4


NAME = 'Main "A", East\nside'


def test_quotes_and_line_breaks(spark, d):
    rows = [record("A", start_station_name='Main "A", East', start_station_id="S7"), record("B", start_station_name=NAME, start_station_id="S8")]
    path = put(f"{d}/t.csv", rows)
    rep = load_trip_files(spark, [path], f"{d}/raw")
    got = {r.ride_id: (r.start_station_name, r.start_station_id) for r in read_raw(spark, f"{d}/raw").collect()}
    assert got == {"A": ('Main "A", East', "S7")}
    assert rep["rows"]["dropped_malformed"] == 2 and rep["rows"]["dropped_missing"] == 0
    load_trip_files(spark, [path], f"{d}/raw2", multiline=True)
    got = {r.ride_id: (r.start_station_name, r.start_station_id) for r in read_raw(spark, f"{d}/raw2").collect()}
    assert got == {"A": ('Main "A", East', "S7"), "B": (NAME, "S8")}


def test_zip_archives_load_like_files(spark, d):
    os.makedirs(f"{d}/in")
    for name, body in (("a.zip", text([record("A", start_station_name=NAME)], list(reversed(CSV_COLUMNS)))), ("bad.zip", "x,y\n1,2\n")):
        with zipfile.ZipFile(f"{d}/in/{name}", "w") as z:
            z.writestr("__MACOSX/._t.csv", "junk")
            z.writestr("t.csv", body)
    with open(f"{d}/in/broken.zip", "wb") as fh:
        fh.write(b"not a zip")
    put(f"{d}/in/c.csv", [record("C")])
    paths = [f"{d}/in/{n}" for n in ("a.zip", "bad.zip", "broken.zip", "c.csv")]
    rep = load_trip_files(spark, paths, f"{d}/raw", landing=f"{d}/in")
    assert rep["loaded"] == ["a.zip", "c.csv"] and sorted(os.path.basename(p) for p in rep["rejected"]) == ["bad.zip", "broken.zip"]
    assert {r.ride_id: r.start_station_name for r in read_raw(spark, f"{d}/raw").collect()} == {"A": NAME, "C": "One"}


def test_bad_files_do_not_stop_the_rest(spark, d):
    good = put(f"{d}/good.csv", [record("A")])
    short = put(f"{d}/short.csv", [record("B")], CSV_COLUMNS[:5])
    rep = load_trip_files(spark, [good, short, f"{d}/missing.csv"], f"{d}/raw")
    assert rep["loaded"] == ["good.csv"] and sorted(rep["rejected"]) == sorted([short, f"{d}/missing.csv"])
    assert load_trip_files(spark, [], f"{d}/raw")["loaded"] == []


def test_stream_accepts_reordered_headers_and_shares_the_ledger(spark, d):
    put(f"{d}/in/a b.csv", [record("A")])
    b = put(f"{d}/in/b.csv", [record("B")], list(reversed(CSV_COLUMNS)))
    start_ingest(spark, f"{d}/in", f"{d}/raw", f"{d}/_chk").awaitTermination()
    assert rides(spark, f"{d}/raw") == ["A", "B"]
    assert load_trip_files(spark, [b], f"{d}/raw", landing=f"{d}/in")["skipped"] == ["b.csv"]


def test_shared_folder_is_required_off_local():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        checkpoint_root(Session())


def test_incremental_scans_are_pruned(spark, d):
    from ridelake.plans import incremental as inc
    from ridelake.plans import trips as M
    path = put(f"{d}/t.csv", [record("A"), record("B", "2024-02-05 10:00:00", "2024-02-05 10:30:00")])
    wh = P.Warehouse(f"{d}/wh")
    P.run_pipeline(spark, [path], wh.root)
    raw = read_raw(spark, wh.raw)
    plan = inc.rides_in_months(raw, [202402])._jdf.queryExecution().executedPlan().toString()
    assert "year_month" in plan.split("PartitionFilters: [")[-1] or plan.count("PartitionFilters: [isnotnull(year_month") == 1
    fct = spark.read.parquet(wh.table("fct_rides"))
    plan = M.agg_daily(fct.filter("year_month IN (202402)"))._jdf.queryExecution().executedPlan().toString()
    assert "202402" in plan[plan.index("PartitionFilters"):]


def test_median_by_counts(spark):
    import random
    import statistics
    rng = random.Random(1)
    rows = [(g, rng.choice([rng.uniform(-5, 5), 1.0, None])) for g in ("a", "b", None) for _ in range(401)] + [("c", 7.0), ("d", 1.0), ("d", 4.0), ("e", None)]
    got = {r.g: r.m for r in median_by_counts(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", "m").collect()}
    want = {g: statistics.median([v for k, v in rows if k == g and v is not None]) for g in ("a", "b", None, "c", "d")}
    assert got == pytest.approx(want)


def test_text_helper_round_trip():
    import csv
    rows = list(csv.reader(io.StringIO(text([record("A", start_station_name=NAME)]))))
    assert rows[1][CSV_COLUMNS.index("start_station_name")] == NAME
