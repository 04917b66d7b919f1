"""Mergeable sketches, the rollup lattice, bucketed tables, checked writes, compaction, ellipsoid distance."""

import shutil
import statistics
import tempfile
import uuid

import pytest
from helpers import raw_rows, ts
from pyspark.sql import functions as F

from ridelake.functions.geo import ellipsoid_km, haversine_km
from ridelake.operators import compact
from ridelake.operators.dedupe import keep_latest, upsert_bucketed, write_bucketed
from ridelake.operators.quality import read_checked, read_quarantine, write_checked
from ridelake.operators.sinks import read_raw, write_raw
from ridelake.plans import sketches
from ridelake.plans.lattice import KEYS, LEVELS, lattice_of, rollup_lattice
from ridelake.plans.rollups import member_rollup_rows


@pytest.fixture()
def d():
    path = tempfile.mkdtemp(prefix="ridelake-spans-")
    yield path
    shutil.rmtree(path, ignore_errors=True)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def fact(spark, n):
    rows = spark.range(n)
    return rows.select(
        (F.col("id") % 3 + 202401).cast("int").alias("year_month"), (F.col("id") % 2).cast("int").alias("ride_hour"), F.lit("Weekday").alias("is_weekend"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("S"), F.col("id") % 9000)).alias("start_station_id"), F.lit("").alias("end_station_id"),
        F.expr("date_add(date'2024-01-01', cast(id % 80 as int))").alias("ride_date"), F.pmod(F.xxhash64("id"), F.lit(1440)).alias("ride_duration_minutes"))


def test_sketches_merge_over_months_within_their_error(spark, d):
    fct = fact(spark, 60000)
    sketches.refresh_sketches(spark, fct, d)
    exact = {r.ride_hour: r.n for r in fct.groupBy("ride_hour").agg(F.count_distinct("start_station_id").alias("n")).collect()}
    for r in sketches.hourly_stations(spark, d).collect():
        assert r.unique_start_stations == pytest.approx(exact[r.ride_hour], rel=0.06) and r.unique_end_stations == 1
    asked = (0.1, 0.5, 0.9)
    whole = sketches.duration_quantiles(spark, d, F.lit("all"), asked)
    got = whole.first()
    minutes = sorted(r[0] for r in fct.select("ride_duration_minutes").collect())
    for p in asked:
        rank = sum(m <= got[f"q{round(p * 100)}"] for m in minutes) / len(minutes)
        assert rank == pytest.approx(p, abs=0.02)
    assert got.n == 60000 and abs(got.q50 - statistics.median(minutes)) < 30
    checked = sketches.within_rank(fct.withColumn("span", F.lit("all")), "ride_duration_minutes", whole.drop("n"), asked, 0.02, "span")
    assert [tuple(r) for r in checked.collect()] == [("all", 60000, True)]
    wrong = whole.drop("n").withColumn("q50", F.lit(3).cast("long"))
    assert not sketches.within_rank(fct.withColumn("span", F.lit("all")), "ride_duration_minutes", wrong, asked, 0.02, "span").first().within


def test_sketches_of_touched_months_only(spark, d):
    fct = fact(spark, 3000)
    sketches.refresh_sketches(spark, fct, d)
    changed = fct.where("year_month <> 202402").unionByName(fct.where("year_month = 202401").withColumn("start_station_id", F.lit("new")))
    sketches.refresh_sketches(spark, changed, d, months=[202401, 202402])
    rows = spark.read.parquet(f"{d}/{sketches.STATIONS}")
    assert {r[0] for r in rows.select("year_month").distinct().collect()} == {202401, 202403}
    want = changed.agg(F.count_distinct("start_station_id")).first()[0]
    got = rows.agg(F.hll_sketch_estimate(F.hll_union_agg("starts"))).first()[0]
    assert got == pytest.approx(want, rel=0.05)


def test_lattice_levels_equal_their_own_aggregation(spark):
    rows = raw_rows(spark, [dict(ride_id=f"r{i}", started_at=ts(f"2024-01-0{1 + i % 4} 10:00:00"), ended_at=ts(f"2024-01-0{1 + i % 4} 10:{10 + i % 40}:00"),
                                 member_casual=("member", "casual")[i % 3 > 0], rideable_type=("classic_bike", "electric_bike")[i % 5 > 1]) for i in range(60)])
    got = rollup_lattice(rows).collect()
    assert len({r.level for r in got}) == len(LEVELS) == 8
    for level in LEVELS:
        number = sum(1 << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS) if k not in level)
        want = rows.groupBy(*[F.to_date("started_at").alias(k) if k == "ride_date" else k for k in level]).agg(
            F.count(F.lit(1)).alias("n"), F.avg(F.expr("(unix_timestamp(ended_at) - unix_timestamp(started_at)) / 60")).alias("avg"))
        want = sorted((*[str(r[k]) for k in level], r.n, round(r.avg, 9)) for r in want.collect())
        assert sorted((*[str(r[k]) for k in level], r.total_rides, round(r.avg_duration, 9)) for r in got if r.level == number) == want
    assert plan(rollup_lattice(rows)).count("Scan ") == 1
    few = lattice_of(member_rollup_rows(rows), [["ride_date"], []])
    assert few.count() == 5
    with pytest.raises(ValueError):
        lattice_of(member_rollup_rows(rows), [["weather"]])


def test_keep_latest_and_upsert_over_buckets_need_no_exchange(spark, d):
    names = [f"t{uuid.uuid4().hex[:10]}" for _ in range(2)]
    rows = spark.range(4000).select(F.concat(F.lit("r"), F.col("id") % 1500).alias("ride_id"), F.col("id").alias("version"), F.lit("x").alias("v"))
    try:
        old = write_bucketed(rows, names[0], f"{d}/old", "ride_id", 6, ["version"])
        new = write_bucketed(rows.where("version < 100").withColumn("v", F.lit("y")), names[1], f"{d}/new", "ride_id", 6)
        latest = keep_latest(old, ["ride_id"], ["-version"])
        assert "Exchange" not in plan(latest) and latest.count() == 1500
        merged = upsert_bucketed(latest, new, "ride_id")
        assert "Exchange" not in plan(merged)
        assert {r.v: r["count"] for r in merged.groupBy("v").count().collect()} == {"x": 1400, "y": 100}
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_checked_write_counts_and_quarantines_in_one_pass(spark, d):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "a"), (3, None), (None, "z")], "id long, kind string")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = write_checked(df.mapInArrow(count, df.schema), f"{d}/t", ["id", "kind"], {"kind": ["a", "b"]}, "t")
    assert sorted(tuple(r) for r in rows.collect()) == [("t", "id", "not_null", 2), ("t", "kind", "accepted_values", 1), ("t", "kind", "not_null", 1)]
    assert seen.value == 5
    assert sorted(map(str, read_checked(df, f"{d}/t").collect())) == ["Row(id=1, kind='a')", "Row(id=2, kind='b')"]
    assert read_quarantine(df, f"{d}/t").count() == 3
    rows = write_checked(df.limit(0), f"{d}/none", ["id"], {}, "none")
    assert [r.failures for r in rows.collect()] == [0] and read_checked(df, f"{d}/none").count() == 0


def test_compaction_survives_a_crash_between_its_moves(spark, d, monkeypatch):
    root = f"{d}/raw"
    rows = raw_rows(spark, [dict(ride_id=f"r{i}", started_at=ts(f"2024-0{1 + i % 3}-05 10:00:00"), ended_at=ts(f"2024-0{1 + i % 3}-05 10:30:00"),
                                 source_file=f"f {i % 2}=x.csv") for i in range(120)])
    for _ in range(2):
        write_raw(rows.repartition(5), root, mode="append")
    want = sorted(map(str, read_raw(spark, root).collect()))
    moved = []

    def dies(spark, root):
        if moved:  # called by compact() at its start, then to move
            raise RuntimeError("lost driver")
        moved.append(1)

    with monkeypatch.context() as m:
        m.setattr(compact, "recover", dies)
        with pytest.raises(RuntimeError):
            compact.compact(spark, root)
    assert sorted(map(str, read_raw(spark, root).collect())) == want  # nothing moved yet
    run = compact._folders(spark, f"{root}/{compact.PACKED_DIR}")[0]
    leaf = compact._folders(spark, compact._folders(spark, run.toString())[0].toString())[0]
    place = compact._fs(spark, f"{root}/{leaf.getParent().getName()}/{leaf.getName()}")
    place[1].delete(place[0], True)  # as if it died between the two steps of one move
    compact.recover(spark, root)
    assert sorted(map(str, read_raw(spark, root).collect())) == want
    files = compact.leaf_files(spark, root).collect()
    assert len(files) == 6 and all(r.files == 1 for r in files)
    assert compact.compact(spark, root) == 0
    assert compact._folders(spark, f"{root}/{compact.PACKED_DIR}") == []


def test_ellipsoid_distance(spark):
    rows = [("cornwall", 50.066389, -5.714722, 58.643889, -3.07, 969.954), ("same", 40.7, -74.0, 40.7, -74.0, 0.0),
            ("equator", 0.0, 0.0, 0.0, 1.0, 111.319), ("meridian", 0.0, 10.0, 1.0, 10.0, 110.574), ("null", None, 0.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "n string, a double, b double, c double, d double, km double")
    for r in df.select("*", ellipsoid_km("a", "b", "c", "d").alias("got"), haversine_km("a", "b", "c", "d").alias("sphere")).collect():
        if r.km is None:
            assert r.got is None
        else:
            assert r.got == pytest.approx(r.km, rel=3e-5, abs=0.001)
            assert r.sphere == pytest.approx(r.km, rel=0.006)
    far = spark.sql("SELECT 0D a, 0D b, 0D c, 180D d")
    assert far.select(ellipsoid_km("a", "b", "c", "d")).first()[0] > 19000
