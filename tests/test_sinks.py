import os
import tempfile

from pyspark.sql import functions as F

from ridelake.operators.sinks import (between_dates, ensure_raw_table, read_raw, touched_keys,
                                      upsert_generic, write_raw)
from ridelake.plans import trips as M
from ridelake.schema import CSV_COLUMNS
from ridelake.sources.files import group_by_header, read_csv_by_name

from helpers import raw_rows, ts


def test_ensure_raw_table_creates_empty_declared_schema(spark):
    root = tempfile.mkdtemp(prefix="ridelake-ens-") + "/raw"
    df = ensure_raw_table(spark, root)
    assert df.count() == 0 and {"ride_id", "loaded_at", "year_month", "source_file"} <= set(df.columns)
    write_raw(raw_rows(spark, [dict(ride_id="1", started_at=ts("2024-01-05 10:00:00"),
                                    ended_at=ts("2024-01-05 10:30:00"))]), root)
    assert ensure_raw_table(spark, root).count() == 1  # existing table left alone


def test_between_dates_prunes_month_partitions(spark):
    root = tempfile.mkdtemp(prefix="ridelake-btw-") + "/raw"
    write_raw(raw_rows(spark, [
        dict(ride_id=str(m), started_at=ts(f"2024-0{m}-05 10:00:00"), ended_at=ts(f"2024-0{m}-05 10:30:00"))
        for m in (1, 2, 3)]), root)
    df = between_dates(read_raw(spark, root), "2024-02-01", "2024-03-01")
    assert [r[0] for r in df.select("ride_id").collect()] == ["2"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan


def test_touched_keys_with_partition_assertion(spark):
    raw = raw_rows(spark, [
        dict(ride_id="A", started_at=ts("2024-01-01 10:00:00"), ended_at=ts("2024-01-01 10:20:00")),
        dict(ride_id="A", started_at=ts("2024-01-03 10:00:00"), ended_at=ts("2024-01-03 10:20:00"),
             source_file="new.csv"),
        dict(ride_id="B", started_at=ts("2024-01-02 10:00:00"), ended_at=ts("2024-01-02 10:20:00")),
    ]).withColumn("year_month", F.lit(202401))
    new = raw.filter(F.col("source_file") == "new.csv")
    for prune in (None, "year_month"):
        keys = sorted(str(r[0]) for r in touched_keys(new, raw, "ride_id", F.to_date("started_at"), prune).collect())
        assert keys == ["2024-01-01", "2024-01-03"]


def test_dedupe_within_month_same_result_when_asserted(spark):
    raw = raw_rows(spark, [
        dict(ride_id="A", started_at=ts("2024-01-01 10:00:00"), ended_at=ts("2024-01-01 10:20:00"),
             loaded_at=ts("2024-02-01 00:00:00")),
        dict(ride_id="A", started_at=ts("2024-01-01 10:00:00"), ended_at=ts("2024-01-01 10:40:00"),
             loaded_at=ts("2024-02-02 00:00:00")),
    ])
    a = M.stg_trips(raw).collect()
    b = M.stg_trips(raw, dedupe_within_month=True).collect()
    assert a == b and a[0]["ride_duration_minutes"] == 40


def test_upsert_generic_replaces_matching_keys(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(tuple(r) for r in upsert_generic(tgt, new, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "C")]


def test_header_groups_and_bom(spark):
    d = tempfile.mkdtemp(prefix="ridelake-hdr-")
    row = {c: "" for c in CSV_COLUMNS}
    row.update(ride_id="R1", rideable_type="classic_bike", started_at="2024-01-05 10:00:00",
               ended_at="2024-01-05 10:10:00", member_casual="casual")
    with open(os.path.join(d, "a.csv"), "w", encoding="utf-8") as fh:
        fh.write("﻿" + ",".join(CSV_COLUMNS) + "\n" + ",".join(row[c] for c in CSV_COLUMNS) + "\n")
    cols = list(reversed(CSV_COLUMNS))
    with open(os.path.join(d, "b.csv"), "w") as fh:
        fh.write(",".join(cols) + "\n" + ",".join(row[c] for c in cols) + "\n")
    paths = [os.path.join(d, n) for n in ("a.csv", "b.csv")]
    assert len(group_by_header(spark, paths)) == 2
    text, rejected = read_csv_by_name(spark, paths)
    got = sorted((r["source_file"], r["ride_id"], r["member_casual"]) for r in text.collect())
    assert rejected == [] and got == [("a.csv", "R1", "casual"), ("b.csv", "R1", "casual")]


def test_ledger_commits_file_with_no_valid_rows(spark):
    from ridelake.operators.sinks import committed_files, load_trip_files
    d = tempfile.mkdtemp(prefix="ridelake-ledger-")
    row = {c: "" for c in CSV_COLUMNS}
    row.update(ride_id="R1", rideable_type="classic_bike", started_at="2024-01-05 10:00:00",
               ended_at="2024-01-05 10:00:30", member_casual="casual")  # 30 s: rejected
    path = os.path.join(d, "short.csv")
    with open(path, "w") as fh:
        fh.write(",".join(CSV_COLUMNS) + "\n" + ",".join(row[c] for c in CSV_COLUMNS) + "\n")
    root = d + "/raw"
    ensure_raw_table(spark, root)
    assert load_trip_files(spark, [path], root)["loaded"] == ["short.csv"]
    assert [(r.source_file, r.rows) for r in committed_files(spark, root).collect()] == [("short.csv", 0)]
    assert load_trip_files(spark, [path], root)["skipped"] == ["short.csv"]


def test_crash_before_ledger_commit_then_rerun_is_exactly_once(spark):
    from ridelake.operators.clean import clean_trips
    from ridelake.operators.sinks import committed_files, load_trip_files
    from ridelake.sources.files import read_csv_by_name
    d = tempfile.mkdtemp(prefix="ridelake-crash-")
    rows = []
    for i in range(5):
        r = {c: "" for c in CSV_COLUMNS}
        r.update(ride_id=f"R{i}", rideable_type="classic_bike", started_at=f"2024-01-0{i + 1} 10:00:00",
                 ended_at=f"2024-01-0{i + 1} 10:30:00", member_casual="member")
        rows.append(",".join(r[c] for c in CSV_COLUMNS))
    path = os.path.join(d, "jan.csv")
    with open(path, "w") as fh:
        fh.write(",".join(CSV_COLUMNS) + "\n" + "\n".join(rows) + "\n")
    root = d + "/raw"
    # a first attempt wrote the file's leaves, then died before the ledger row
    text, _ = read_csv_by_name(spark, [path])
    write_raw(clean_trips(text.withColumn("loaded_at", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))), root)
    assert committed_files(spark, root).count() == 0
    # the rerun is not skipped (no ledger row) and rewrites the same leaves
    rep = load_trip_files(spark, [path], root, loaded_at="2024-02-01 01:00:00")
    assert rep["loaded"] == ["jan.csv"]
    raw = read_raw(spark, root)
    assert raw.count() == 5 and raw.select("ride_id").distinct().count() == 5
    assert [(r.source_file, r.rows) for r in committed_files(spark, root).collect()] == [("jan.csv", 5)]


def test_command_line_load_run_report(spark, capsys):
    from ridelake.__main__ import main
    d = tempfile.mkdtemp(prefix="ridelake-cli-")
    os.makedirs(os.path.join(d, "in"))
    r = {c: "" for c in CSV_COLUMNS}
    r.update(ride_id="R1", rideable_type="classic_bike", started_at="2024-01-05 10:00:00",
             ended_at="2024-01-05 10:30:00", member_casual="member", start_station_id="S1",
             start_station_name="One", end_station_id="S2", end_station_name="Two")
    with open(os.path.join(d, "in", "a.csv"), "w") as fh:
        fh.write(",".join(CSV_COLUMNS) + "\n" + ",".join(r[c] for c in CSV_COLUMNS) + "\n")
    wh = os.path.join(d, "wh")
    assert main(["run", "--warehouse", wh, "--dir", os.path.join(d, "in")]) == 0
    assert main(["load", "--warehouse", wh, "--dir", os.path.join(d, "in")]) == 0
    out = capsys.readouterr().out
    assert '"loaded": ["a.csv"]' in out and '"skipped": ["a.csv"]' in out
    assert main(["report", "--warehouse", wh]) == 0
    assert spark.read.parquet(os.path.join(wh, "fct_rides")).count() == 1


def test_load_reports_observed_drop_counts(spark):
    from ridelake.operators.sinks import load_trip_files
    d = tempfile.mkdtemp(prefix="ridelake-obs-")
    base = {c: "" for c in CSV_COLUMNS}
    base.update(rideable_type="classic_bike", member_casual="member")
    rows = [dict(base, ride_id="ok", started_at="2024-01-05 10:00:00", ended_at="2024-01-05 10:30:00"),
            dict(base, ride_id="bad", started_at="garbage", ended_at="2024-01-05 10:30:00"),
            dict(base, ride_id="rev", started_at="2024-01-05 11:00:00", ended_at="2024-01-05 10:30:00"),
            dict(base, ride_id="short", started_at="2024-01-05 10:00:00", ended_at="2024-01-05 10:00:10")]
    path = os.path.join(d, "mix.csv")
    with open(path, "w") as fh:
        fh.write(",".join(CSV_COLUMNS) + "\n" + "\n".join(",".join(r[c] for c in CSV_COLUMNS) for r in rows) + "\n")
    rep = load_trip_files(spark, [path], d + "/raw")
    assert rep["rows"] == {"input_rows": 4, "dropped_malformed": 0, "dropped_missing": 1, "dropped_order": 1, "dropped_bounds": 1,
                           "kept_rows": 1}
    assert [r.ride_id for r in read_raw(spark, d + "/raw").collect()] == ["ok"]


def test_path_exists_without_jvm_handle(spark):
    from ridelake.operators.sinks import path_exists

    class NoJvm:  # a session exposing only the DataFrame API
        def __init__(self, s):
            self.read = s.read
    d = tempfile.mkdtemp(prefix="ridelake-exists-")
    spark.range(3).write.parquet(d + "/t")
    assert path_exists(NoJvm(spark), d + "/t")
    assert not path_exists(NoJvm(spark), d + "/missing")
    assert path_exists(spark, d + "/t") and not path_exists(spark, d + "/missing")
