"""The version index: filters, moved rides, and what loads and builds read."""

import gzip
import re
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from ridelake.operators import sinks, versions
from ridelake.operators.sinks import load_trip_files, read_raw
from ridelake.plans import pipeline as P
from ridelake.schema import CSV_COLUMNS
from ridelake.sources import files


@pytest.fixture()
def d():
    path = tempfile.mkdtemp(prefix="ridelake-versions-")
    yield path
    shutil.rmtree(path, ignore_errors=True)


def record(ride, start, minutes=20, member="member"):
    day, clock = start.split(" ")
    end = f"{int(clock[:2]):02d}:{int(clock[3:5]) + minutes:02d}:00"
    return ",".join([ride, "classic_bike", start, f"{day} {end}", "One", "S1", "Two", "S2", "40.7", "-74.0", "40.71", "-74.01", member])


def put(path, records, header=CSV_COLUMNS, opener=open):
    with opener(path, "wt") as f:
        f.write("\n".join([",".join(header), *records]) + "\n")
    return path


def month_file(d, month, rides, name=None):
    return put(f"{d}/{name or month}.csv", [record(r, f"2024-{month:02d}-{1 + i % 28:02d} 10:00:00") for i, r in enumerate(rides)])


def plans_since(spark, n):
    store = spark._jsparkSession.sharedState().statusStore()
    return [p for i, p in enumerate(executed(store)) if i >= n]


def executed(store):
    runs = store.executionsList()
    return [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]


def raw_scans(plans, root):
    """PartitionFilters of every scan of the raw rows in the plans."""
    out = []
    for plan in plans:
        for node in re.split(r"\n\n\(\d+\) ", plan):
            if node.startswith("Scan parquet") and re.search(rf"InMemoryFileIndex \[[a-z]+:/*{root}\]", node):
                out.append((re.search(r"PartitionFilters: \[(.*)\]", node) or [None, ""])[1])
    return out


def test_an_increment_reads_only_files_and_months_it_touches(spark, d):
    wh = P.Warehouse(f"{d}/wh")
    first = [month_file(d, m, [f"m{m}-{i}" for i in range(40)]) for m in range(1, 8)]
    P.run_pipeline(spark, first, wh.root, loaded_at="2024-09-01 00:00:00")
    late = put(f"{d}/late.csv", [record("m3-5", "2024-06-02 10:00:00"), record("m3-6", "2024-03-09 10:00:00"), record("new", "2024-06-03 10:00:00")])
    before = len(executed(spark._jsparkSession.sharedState().statusStore()))
    P.run_pipeline(spark, [late], wh.root, loaded_at="2024-09-02 00:00:00")
    scans = raw_scans(plans_since(spark, before), wh.raw)
    scans = [f for f in scans if f]  # checks over whole models are asked for by run_pipeline, see below
    months = {int(m) for f in scans for m in re.findall(r"\b2024\d\d\b", f)}
    assert len(scans) >= 5 and months == {202403, 202406}
    assert all("year_month" in f or "dynamicpruning" in f for f in scans)
    # all but the declared checks of the raw table (one scan) are pruned
    before = len(executed(spark._jsparkSession.sharedState().statusStore()))
    load_trip_files(spark, [put(f"{d}/more.csv", [record("m2-1", "2024-02-20 09:00:00")])], wh.raw, loaded_at="2024-09-03 00:00:00")
    P.build_models(spark, wh)
    scans = raw_scans(plans_since(spark, before), wh.raw)
    assert scans and all("year_month" in f or "dynamicpruning" in f for f in scans), scans


def rows(df):
    return sorted(map(str, df.collect()))


def same_models(spark, a, b):
    for name in ("stg_rides", "fct_rides", "dim_stations", "agg_hourly_patterns", "agg_daily_rides"):
        left, right = (spark.read.parquet(w.table(name)) for w in (a, b))
        assert rows(left) == rows(right.select(*left.columns)), name


def test_increments_equal_a_full_build_when_rides_move(spark, d, monkeypatch):
    monkeypatch.setattr(versions, "MAX_SETS", 2)  # filters are made one on the way
    loads = [[month_file(d, m, [f"r{i}" for i in range(m, 30, 3)], f"a{m}") for m in (1, 2, 3)],
             [put(f"{d}/b.csv", [record("r4", "2024-03-11 08:00:00"), record("r5", "2024-01-11 08:00:00", member="casual"), record("x", "2024-05-01 08:00:00")])],
             [put(f"{d}/c.csv", [record("r4", "2024-04-01 08:00:00"), record("x", "2024-05-02 08:00:00")])],
             [put(f"{d}/d.csv", [record("r4", "2024-01-02 08:00:00")])], [put(f"{d}/e.csv", [record("q", "2024-01-02 08:00:00")])]]
    inc, full = P.Warehouse(f"{d}/inc"), P.Warehouse(f"{d}/full")
    for k, paths in enumerate(loads):
        P.run_pipeline(spark, paths, inc.root, loaded_at=f"2024-09-0{k + 1} 00:00:00")
        load_trip_files(spark, paths, full.raw, loaded_at=f"2024-09-0{k + 1} 00:00:00")
    P.build_models(spark, full, full=True)
    same_models(spark, inc, full)
    assert versions.indexed(spark, inc.raw)
    moved = versions.read_moved(spark, inc.raw).where("ride_id = 'r4'").distinct()
    assert {r.year_month for r in moved.collect()} == {202401, 202403, 202404}
    sets = versions.read_filters(spark, inc.raw).groupBy("year_month").agg(F.count_distinct("batch").alias("n")).collect()
    assert max(r.n for r in sets) <= 2
    # a reload that takes rides away, by the moved rides alone
    put(f"{d}/b.csv", [record("x", "2024-05-01 08:00:00")])
    P.run_pipeline(spark, [f"{d}/b.csv"], inc.root, loaded_at="2024-09-08 00:00:00", reload=True)
    load_trip_files(spark, [f"{d}/b.csv"], full.raw, loaded_at="2024-09-08 00:00:00", skip_committed=False)
    P.build_models(spark, full, full=True)
    same_models(spark, inc, full)


def test_filters_miss_no_ride_and_name_few_others(spark):
    ids = spark.range(3000).select(F.concat(F.lit("r"), "id").alias("ride_id"), (F.col("id") % 3 + 202401).cast("int").alias("year_month"))
    sets = versions.filter_rows(ids, {202401: 1000, 202402: 1000, 202403: 1000}, "b")
    sizes = sorted({r.blocks for r in versions.filter_sets(sets)})
    assert sizes == [1]
    own = versions.may_hold(ids, sets, sizes).join(ids, ["ride_id", "year_month"], "left_semi")
    assert own.count() == 3000
    others = spark.range(3000, 9000).select(F.concat(F.lit("r"), "id").alias("ride_id"))
    assert versions.may_hold(others, sets, sizes).count() <= 5
    large = versions.filter_rows(ids, {202401: 1000, 202402: 5000, 202403: 100000}, "c")  # months of different sizes
    sizes = sorted({r.blocks for r in versions.filter_sets(large)})
    assert sizes == [1, 8, 128]
    assert versions.may_hold(ids, large, sizes).join(ids, ["ride_id", "year_month"], "left_semi").count() == 3000


def test_tables_without_the_index_are_scanned_until_it_is_made(spark, d):
    root = f"{d}/raw"
    load_trip_files(spark, [month_file(d, 1, ["a", "b"])], root)
    assert versions.indexed(spark, root)
    shutil.rmtree(f"{root}/_members")  # as lost by a crash between two steps of a rewrite
    assert not versions.indexed(spark, root)
    versions.index_table(spark, root)
    assert versions.indexed(spark, root)
    shutil.rmtree(f"{root}/_members")
    load_trip_files(spark, [put(f"{d}/f.csv", [record("a", "2024-02-01 10:00:00")])], root)
    assert not versions.indexed(spark, root)  # not covered, so builds scan
    wh = P.Warehouse(f"{d}/none")
    sinks.write_raw(read_raw(spark, root), wh.raw)
    assert not versions.indexed(spark, wh.raw)


def test_a_file_broken_behind_its_header_is_rejected_whole(spark, d):
    good = month_file(d, 1, ["a", "b"])
    bad = put(f"{d}/bad.csv.gz", [record(f"z{i}", "2024-02-01 10:00:00") for i in range(5000)], opener=gzip.open)
    with open(bad, "rb") as f:
        content = f.read()
    with open(bad, "wb") as f:
        f.write(content[:len(content) // 2])
    fine = put(f"{d}/fine.csv.gz", [record("c", "2024-02-01 10:00:00")], opener=gzip.open)
    out = load_trip_files(spark, [good, bad, fine], f"{d}/raw")
    assert out["loaded"] == ["1.csv", "fine.csv.gz"] and out["rejected"] == [bad]
    assert out["reasons"] == {bad: "unreadable behind its header"} and out["rows"]["kept_rows"] == 3
    assert {r.ride_id for r in read_raw(spark, f"{d}/raw").collect()} == {"a", "b", "c"}
    put(bad, [record("z", "2024-02-01 10:00:00")], opener=gzip.open)  # mended: loads like any other
    assert load_trip_files(spark, [good, bad, fine], f"{d}/raw")["loaded"] == ["bad.csv.gz"]


def test_headers_come_from_tasks(spark, d, monkeypatch):
    long = put(f"{d}/long name%20+é.csv", [record(f"r{i}", "2024-01-01 10:00:00") for i in range(3000)])
    other = put(f"{d}/other.csv", [], header=["﻿a", '"b"', " c"])
    empty = put(f"{d}/empty.csv", [], header=[])
    open(empty, "w").close()
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")  # many splits of the long file
        got = files.headers(spark, [long, other, empty, f"{d}/absent.csv"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert got == {long: tuple(CSV_COLUMNS), other: ("a", "b", "c"), empty: (), f"{d}/absent.csv": ()}
    out = load_trip_files(spark, [long, other, empty, f"{d}/absent.csv"], f"{d}/raw")
    assert out["rows"]["input_rows"] == 3000 and len(out["rejected"]) == 3
    assert out["reasons"][other].startswith("missing columns: ride_id") and out["reasons"][empty] == "no header can be read"


def test_zipped_csv_is_written_and_read_in_pieces(spark, d, monkeypatch):
    monkeypatch.setattr(files, "ZIP_PIECE", 7)
    text = spark.createDataFrame([(f"r{i}", 'say "hi", twice', None) for i in range(50)], "ride_id string, member_casual string, end_lat string")
    files.register_zipped_csv(spark)
    for _ in range(2):  # a repeated write replaces its archives
        text.repartition(3).write.format("zipped_csv").mode("append").save(f"{d}/zips")
    back = files.read_zipped_csv(spark, f"{d}/zips", landing=d)
    assert sorted(r.ride_id for r in back.collect()) == sorted(f"r{i}" for i in range(50))
    assert back.select("member_casual", "end_lat", "started_at", "_malformed").distinct().collect() == [('say "hi", twice', None, None, False)]
    assert {r[0] for r in back.select("source_file").distinct().collect()} == {f"zips/part-0000{i}.zip" for i in range(3)}
    open(f"{d}/zips/broken.zip", "wb").write(b"PK nothing")
    bad = files.rejected_archives(spark, [f"{d}/zips/broken.zip", f"{d}/zips/part-00000.zip"])
    assert bad == {f"{d}/zips/broken.zip": "no zip archive",
                   f"{d}/zips/part-00000.zip": "missing columns: rideable_type, started_at, ended_at"}


def test_filters_shuffle_ids_not_bitmaps(spark, monkeypatch):
    """What making filters moves follows the ids, however many tasks read them."""
    ids = spark.range(0, 50000, 1, 16).select(F.concat(F.lit("r"), "id").alias("ride_id"), (F.col("id") % 1 + 202401).cast("int").alias("year_month"))
    sets = versions.filter_rows(ids, {202401: 50000}, "b")
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") > plan.index("Generate"), plan  # below it
    monkeypatch.setattr(versions, "TASK_BLOCKS", 1)
    monkeypatch.setattr(versions, "FILE_BLOCKS", 3)
    parts = versions.filter_rows(ids, {202401: 50000}, "b")
    assert parts.rdd.getNumPartitions() == -(-64 // 3)
    assert rows(parts) == rows(sets) and sets.count() == 64
    moved = spark.createDataFrame([("r1", 202401), ("r2", 202402)], "ride_id string, year_month int")
    assert rows(versions.may_hold(moved, sets, [64], besides=True)) == ["Row(ride_id='r2', year_month=202401)"]


def test_a_load_asks_no_filter_of_its_only_month(spark, d, monkeypatch):
    load_trip_files(spark, [month_file(d, 1, ["a", "b"])], f"{d}/raw")
    monkeypatch.setattr(versions, "may_hold", None)  # not called
    load_trip_files(spark, [month_file(d, 1, ["b", "c"], "more")], f"{d}/raw")
    assert versions.indexed(spark, f"{d}/raw") and versions.read_moved(spark, f"{d}/raw").count() == 0


def test_headers_leave_the_rest_of_a_file_unread(spark, d):
    long = put(f"{d}/long.csv", [record(f"r{i}", "2024-01-01 10:00:00") for i in range(200_000)])
    sc = spark.sparkContext
    sc.setJobGroup("headers", "headers")
    try:
        assert files.headers(spark, [long]) == {long: tuple(CSV_COLUMNS)}
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description"):
            sc.setLocalProperty(key, None)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    tracker = sc.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("headers") for s in tracker.getJobInfo(job).stageIds]
    read = sum(sc._jsc.sc().statusStore().lastStageAttempt(s).inputRecords() for s in stages)
    assert 1 <= read < 1000, read


def test_filters_sort_ids_once_not_per_probe(spark):
    ids = spark.range(3000).selectExpr("concat('r', id) AS ride_id", "202401 AS year_month")
    sets = versions.filter_rows(ids, {202401: 3000}, "b")
    per_probe = ids.withColumn("blocks", F.lit(4)).withColumn("block", versions._block(F.col("blocks"))).select(
        "block", F.explode(F.array(*[versions._probe(i) for i in range(versions.PROBES)])).alias("bit"))
    want = per_probe.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    assert sorted((r.block, bytes(r.bitmap)) for r in sets.collect()) == sorted((r.block, bytes(r.bitmap)) for r in want.collect())
    plan = sets._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan.split("bitmap_construct_agg")[-1], plan  # no row per probe below the bitmaps
