"""Registered queries over stored partials, streams by event time, zipped and broken files."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..functions.geo import EQUATOR_KM, FLATTENING
from ..session import scratch_dir
from ..sources.adapter import raw_trips
from . import trips as M
from .registry import _RAW_ONE_BATCH, BATCH1, _raw_cols, _stage, _text, register


def _stored_fct(spark, sf, label: str):
    from .incremental import write_by_month
    root = scratch_dir(spark, label)
    fct = M.fct_from_raw(raw_trips(spark, sf))
    write_by_month(fct, f"{root}/fct", full=True)
    return root, spark.read.parquet(f"{root}/fct")


# ---- E8, E4: sketches that merge ---------------------------------------------

@register("distinct_sketch", O.with_ctes("fct") + """
  SELECT ride_hour, is_weekend, count(DISTINCT start_station_id) AS unique_start_stations,
    count(DISTINCT end_station_id) AS unique_end_stations
  FROM fct GROUP BY ride_hour, is_weekend""")
def q_distinct_sketch(spark, sf):
    """Distinct stations per hour from HyperLogLog sketches stored per month
    and merged (exact at these cardinalities), after a refresh of one month."""
    from .sketches import hourly_stations, refresh_sketches
    root, fct = _stored_fct(spark, sf, "distinct-sketch")
    refresh_sketches(spark, fct, root)
    refresh_sketches(spark, fct, root, months=[202401])
    return hourly_stations(spark, root)


@register("median_sketch", O.with_ctes("fct") + """
  SELECT CAST(date_trunc('week', ride_date) AS DATE) AS span, count(ride_duration_minutes) AS n, true AS within
  FROM fct GROUP BY 1""")
def q_median_sketch(spark, sf):
    """Quartiles and 95 % of ride minutes per week from KLL sketches stored
    per day and merged; each estimate's rank is checked against the rides
    (within 2 %)."""
    from .sketches import duration_quantiles, refresh_sketches, within_rank
    root, fct = _stored_fct(spark, sf, "median-sketch")
    refresh_sketches(spark, fct, root)
    asked = (0.25, 0.5, 0.75, 0.95)
    week = F.date_trunc("week", "ride_date").cast("date")
    found = duration_quantiles(spark, root, week, asked)
    return within_rank(fct.select(week.alias("span"), "ride_duration_minutes"), "ride_duration_minutes", found.drop("n"), asked, 0.02, "span")


# ---- L8: one rollup lattice ----------------------------------------------------

@register("rollup_lattice", O.with_ctes("raw") + f"""
  SELECT member_casual, rideable_type, CAST(started_at AS DATE) AS ride_date,
    CAST(GROUPING(member_casual, rideable_type, CAST(started_at AS DATE)) AS INTEGER) AS level,
    count(*) AS total_rides, CAST(sum({O.MINUTES}) AS DOUBLE) / count(*) AS avg_duration
  FROM raw GROUP BY CUBE (member_casual, rideable_type, CAST(started_at AS DATE))""")
def q_rollup_lattice(spark, sf):
    """Every level of member x bike x date, coarser ones from the finest."""
    from .lattice import rollup_lattice
    return rollup_lattice(raw_trips(spark, sf))


# ---- H12: distance on the ellipsoid ----------------------------------------------

def _lambert() -> str:
    rad = {c: f"radians({c})" for c in ("start_lat", "start_lng", "end_lat", "end_lng")}
    f = O.dbl(repr(FLATTENING))
    return f"""
  b AS (SELECT ride_id, source_file, {rad['end_lng']} - {rad['start_lng']} AS dl,
      atan((1 - {f}) * tan({rad['start_lat']})) AS b1, atan((1 - {f}) * tan({rad['end_lat']})) AS b2 FROM raw),
  s AS (SELECT *, (b1 + b2) / 2 AS p, (b2 - b1) / 2 AS q,
      2 * asin(sqrt(least(1, pow(sin((b2 - b1) / 2), 2) + cos(b1) * cos(b2) * pow(sin(dl / 2), 2)))) AS a FROM b),
  km AS (SELECT ride_id, source_file, CASE WHEN a = 0 THEN CAST(0 AS DOUBLE) ELSE {O.dbl(EQUATOR_KM)} * (a - {f} / 2 * (
      (a - sin(a)) * pow(sin(p) * cos(q), 2) / pow(cos(a / 2), 2)
      + (a + sin(a)) * pow(cos(p) * sin(q), 2) / pow(sin(a / 2), 2))) END AS km FROM s)"""


@register("geo_distance_ellipsoid", O.with_ctes("raw").rstrip() + "," + _lambert() + f"""
  SELECT ride_id, source_file, {O.r('km', 6)} AS ellipsoid_km FROM km""")
def q_geo_distance_ellipsoid(spark, sf):
    from ..functions.geo import ellipsoid_km
    return raw_trips(spark, sf).select(
        "ride_id", "source_file", F.round(ellipsoid_km("start_lat", "start_lng", "end_lat", "end_lng"), 6).alias("ellipsoid_km"))


# ---- I2: hourly counts by event time --------------------------------------------

_PARTS = "CASE WHEN event_id % 97 = 0 THEN 4 WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END"


@register("stream_hourly", f"""
  WITH e AS (SELECT ts, event_type, date_trunc('hour', ts) AS h, {_PARTS} AS part FROM events),
  w AS (SELECT max(ts) FILTER (WHERE part < 4) - INTERVAL 2 HOUR AS w3, max(ts) - INTERVAL 2 HOUR AS w4 FROM e),
  x AS (SELECT e.*, w4, part = 4 AND h + INTERVAL 1 HOUR <= w3 AS late FROM e, w)
  SELECT CAST(h AS TIMESTAMP) AS hour_start, count(*) FILTER (WHERE NOT late) AS rides,
    count(*) FILTER (WHERE NOT late AND event_type IN ('view', 'click')) AS member_rides, count(*) FILTER (WHERE late) AS late_rows
  FROM x WHERE h + INTERVAL 1 HOUR <= w4 GROUP BY h HAVING count(*) FILTER (WHERE NOT late) > 0""")
def q_stream_hourly(spark, sf):
    """Hours final by a watermark of two hours: rows arrive in date order in
    three loads, then late ones; the stream restarts from its checkpoint
    after each."""
    from ..operators.sinks import read_raw, write_raw
    from ..sources.adapter import raw_trips_from_events, read_table
    from ..streaming.hourly import late_rows, start_hourly
    work = scratch_dir(spark, "stream-hourly")
    rows = raw_trips_from_events(read_table(spark, sf, "events"), keep=("event_id", "ts")).withColumn("part", F.expr(_PARTS))
    for part in (1, 2, 3, 4):
        write_raw(rows.where(F.col("part") == part), f"{work}/raw", mode="append")
        start_hourly(spark, f"{work}/raw", f"{work}/hours", f"{work}/_chk").awaitTermination()
    return late_rows(spark.read.parquet(f"{work}/hours"), read_raw(spark, f"{work}/raw"))


# ---- A4, A2: zipped files, files broken behind their header ----------------------

_ONE_BATCH = O.with_ctes("raw", raw_body=_RAW_ONE_BATCH)
ARCHIVE_ROWS = 250_000  # of an archive, which one task writes and one reads


def _put(spark, path: str, content: bytes) -> str:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(content))
    out.close()
    return path


@register("zip_scan", _ONE_BATCH + f"SELECT {O.RAW_COLS} FROM raw")
def q_zip_scan(spark, sf):
    """The trip text as zipped CSV archives (written by tasks, some per source
    file, more of them the more rows it has): two folders loaded as a batch, the third by the stream, a broken
    archive rejected."""
    from ..operators.sinks import load_trip_files, read_raw
    from ..schema import CSV_COLUMNS
    from ..sources.files import list_files, register_zipped_csv
    from ..streaming.ingest import start_ingest
    work = scratch_dir(spark, "zip-scan")
    register_zipped_csv(spark)
    text = _text(spark, sf)
    for name in ("f0", "f1", "f2"):
        rows = text.where(F.col("source_file") == f"{name}.csv").select(*CSV_COLUMNS)
        several = max(3, -(-rows.count() // ARCHIVE_ROWS))
        rows.repartition(several).write.format("zipped_csv").mode("append").save(f"{work}/in/{name}.csv")
    broken = _put(spark, f"{work}/in/f0.csv/broken.zip", b"PK no archive")
    paths = [r[0] for name in ("f0", "f1") for r in list_files(spark, f"{work}/in/{name}.csv", "*.zip").select("path").collect()]
    report = load_trip_files(spark, paths, f"{work}/raw", loaded_at=BATCH1, landing=f"{work}/in")
    assert [p.rsplit("/", 1)[-1] for p in report["rejected"]] == [broken.rsplit("/", 1)[-1]] and len(report["loaded"]) == len(paths) - 1 >= 6, report
    start_ingest(spark, f"{work}/in/f2.csv", f"{work}/raw", f"{work}/_chk", loaded_at=BATCH1, names_below=f"{work}/in").awaitTermination()
    raw = read_raw(spark, f"{work}/raw")
    return _raw_cols(raw.withColumn("source_file", F.element_at(F.split("source_file", "/"), 1)))


@register("dir_scan_broken", _ONE_BATCH + "SELECT source_file, count(*) AS rows_loaded FROM raw GROUP BY source_file")
def q_dir_scan_broken(spark, sf):
    """A folder load in which one gzipped file breaks behind its header: it is
    rejected whole, the others load."""
    import gzip
    import random

    from ..operators.sinks import load_trip_files, read_raw
    from ..schema import CSV_COLUMNS
    work, paths = _stage(spark, sf, "dir-broken")
    rng = random.Random(1)
    lines = [",".join(CSV_COLUMNS)] + [",".join(str(rng.random()) for _ in CSV_COLUMNS) for _ in range(2000)]
    content = gzip.compress("\n".join(lines).encode())
    bad = _put(spark, f"{work}/in/bad.csv.gz", content[:len(content) // 2])
    report = load_trip_files(spark, [*paths, bad], f"{work}/raw", loaded_at=BATCH1)
    assert report["rejected"] == [bad] and report["reasons"][bad] == "unreadable behind its header", report
    return read_raw(spark, f"{work}/raw").groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_loaded"))


# ---- B11, C23, G4 -----------------------------------------------------------------

@register("ensure_raw", O.with_ctes("raw", raw_body=f"SELECT * FROM typed WHERE {O.VALID_BOUNDS}") + f"SELECT {O.RAW_COLS} FROM raw")
def q_ensure_raw(spark, sf):
    """The raw table created empty, filled, and left as it is by a second call."""
    from ..operators.clean import clean_trips
    from ..operators.sinks import ensure_raw_table, write_raw
    root = scratch_dir(spark, "ensure-raw") + "/raw"
    assert ensure_raw_table(spark, root).count() == 0
    write_raw(clean_trips(_text(spark, sf)), root, mode="append")
    return _raw_cols(ensure_raw_table(spark, root))


@register("required_columns", """
  SELECT DISTINCT 'f' || CAST(event_id % 3 AS VARCHAR) || '.csv' AS name,
    CASE event_id % 3 WHEN 1 THEN 'missing columns: rideable_type, member_casual' WHEN 2 THEN 'missing columns: ended_at' END AS reason
  FROM events""")
def q_required_columns(spark, sf):
    """Files refused for want of required columns, named in the declared order; f0 loads."""
    from ..operators.sinks import load_trip_files
    from ..schema import CSV_COLUMNS
    lack = {"f1.csv": ("member_casual", "rideable_type"), "f2.csv": ("ended_at",)}
    work, paths = _stage(spark, sf, "required", header_order={n: [c for c in CSV_COLUMNS if c not in cs] for n, cs in lack.items()})
    report = load_trip_files(spark, paths, f"{work}/raw", loaded_at=BATCH1)
    rows = [(p.rsplit("/", 1)[-1], report["reasons"].get(p)) for p in paths]
    return spark.createDataFrame(rows, "name string, reason string")


@register("name_difference", """
  SELECT DISTINCT 'f' || CAST(event_id % 3 AS VARCHAR) || '.csv' AS name FROM events WHERE event_id % 3 > 0""")
def q_name_difference(spark, sf):
    """Names in the landing folder that no load has committed."""
    from ..operators.sinks import committed_files, load_trip_files, pending
    from ..sources.files import list_files
    work, paths = _stage(spark, sf, "names")
    load_trip_files(spark, paths[:1], f"{work}/raw", loaded_at=BATCH1)
    return pending(list_files(spark, f"{work}/in").select("name"), committed_files(spark, f"{work}/raw"))


# ---- F1, D1, D4: co-located storage -----------------------------------------------

@register("dedupe_bucketed", O.with_ctes("stg") + "SELECT * FROM stg")
def q_dedupe_bucketed(spark, sf):
    """Staged trips from raw trips stored in buckets of ride_id: the keep-latest needs no exchange."""
    import uuid

    from ..operators.dedupe import write_bucketed
    name = f"raw_bucketed_{uuid.uuid4().hex[:12]}"
    stored = write_bucketed(raw_trips(spark, sf), name, scratch_dir(spark, "bucketed"), "ride_id", 16, ["loaded_at"])
    return M.stg_trips(stored)


# ---- K1, K3: checks made while writing ----------------------------------------------

@register("dq_observed", O.with_ctes("raw", extra={"typed": O.CLEAN_TYPED}) + """
  SELECT 'typed' AS table_name, 'started_at' AS column_name, 'not_null' AS check_name, count(*) AS failures,
    (SELECT count(*) FROM typed WHERE started_at IS NULL OR member_casual NOT IN ('member', 'casual')) AS quarantined,
    (SELECT count(*) FROM typed) AS total
  FROM typed WHERE started_at IS NULL
  UNION ALL SELECT 'typed', 'member_casual', 'accepted_values', count(*),
    (SELECT count(*) FROM typed WHERE started_at IS NULL OR member_casual NOT IN ('member', 'casual')), (SELECT count(*) FROM typed)
  FROM typed WHERE member_casual NOT IN ('member', 'casual')""")
def q_dq_observed(spark, sf):
    """Checks of the typed load counted while it is written, failing rows in quarantine."""
    from ..operators.clean import clean_strings, clean_types
    from ..operators.quality import read_checked, read_quarantine, write_checked
    from ..schema import MEMBER_VALUES
    typed = clean_types(clean_strings(_text(spark, sf)))
    path = scratch_dir(spark, "checked")
    checks = write_checked(typed, path, ["started_at"], {"member_casual": MEMBER_VALUES}, "typed")
    bad = read_quarantine(typed, path).agg(F.count(F.lit(1)).alias("quarantined"))
    good = read_checked(typed, path).agg(F.count(F.lit(1)).alias("_good"))
    sizes = bad.join(good, F.lit(True)).select("quarantined", (F.col("quarantined") + F.col("_good")).alias("total"))
    return checks.join(sizes, F.lit(True))


# ---- B3, A9: compaction ----------------------------------------------------------------

@register("compact_months", O.with_ctes("raw") + f"SELECT {O.RAW_COLS} FROM raw")
def q_compact_months(spark, sf):
    """Raw rows unchanged by packing the files of many small appends, one file per leaf."""
    from ..operators.compact import compact, leaf_files
    from ..operators.sinks import read_raw, write_raw
    root = scratch_dir(spark, "compact") + "/raw"
    rows = raw_trips(spark, sf)
    for k in range(4):
        write_raw(rows.where(F.pmod(F.xxhash64("ride_id", "loaded_at"), F.lit(4)) == k).repartition(4), root, mode="append")
    most = F.max("files").alias("most")
    before = leaf_files(spark, root).agg(most).first().most
    compact(spark, root)
    assert before >= 4 and leaf_files(spark, root).agg(most).first().most == 1, before
    return _raw_cols(read_raw(spark, root))
