"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import oracle as O
from ..session import configure
from ..sources.adapter import raw_trips
from . import trips as M

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


# ---- L2-L7 trip models -----------------------------------------------------

@register("stg_trips", O.with_ctes("stg") + "SELECT * FROM stg")
def q_stg_trips(spark, sf):
    return M.stg_trips(raw_trips(spark, sf))


@register("trip_metrics", O.with_ctes("metrics") + "SELECT * FROM metrics")
def q_trip_metrics(spark, sf):
    return M.trip_metrics(M.stg_trips(raw_trips(spark, sf)))


@register("fct_trips", O.with_ctes("fct") + "SELECT * FROM fct")
def q_fct_trips(spark, sf):
    return M.fct_from_raw(raw_trips(spark, sf))


@register("agg_daily", O.with_ctes("fct") + O.DAILY_SELECT)
def q_agg_daily(spark, sf):
    return M.agg_daily(M.fct_from_raw(raw_trips(spark, sf)))


def _fct(spark, sf):
    return M.fct_from_raw(raw_trips(spark, sf))


def _stg(spark, sf):
    return M.stg_trips(raw_trips(spark, sf))


def _stations(spark, sf):
    # coordinates compared at 1e-6 degrees (~0.1 m): float means differ in
    # the last bits between engines with summation order
    return M.stg_stations(raw_trips(spark, sf), coord_decimals=6)


def _dim(spark, sf):
    raw = raw_trips(spark, sf)
    return M.dim_stations(M.stg_stations(raw, coord_decimals=6), M.stg_trips(raw))


@register("stg_stations", O.with_ctes("stations") + "SELECT * FROM stations")
def q_stg_stations(spark, sf):
    return _stations(spark, sf)


@register("station_roles", O.with_ctes("roles") + "SELECT * FROM roles")
def q_station_roles(spark, sf):
    return M.station_roles(_stg(spark, sf))


@register("dim_stations", O.with_ctes("dim") + "SELECT * FROM dim")
def q_dim_stations(spark, sf):
    return _dim(spark, sf)


@register("agg_hourly", O.with_ctes("fct") + O.HOURLY_SELECT)
def q_agg_hourly(spark, sf):
    return M.agg_hourly(_fct(spark, sf))


@register("ordered_hourly", O.with_ctes("fct") + O.HOURLY_SELECT + "\n  ORDER BY is_weekend, ride_hour")
def q_ordered_hourly(spark, sf):
    return M.agg_hourly(_fct(spark, sf)).orderBy("is_weekend", "ride_hour")


@register("distinct_approx", O.with_ctes("fct") + O.HOURLY_SELECT)
def q_distinct_approx(spark, sf):
    """Hourly mart with HyperLogLog++ distinct counts (fixed-size state).
    At 1% relative error HLL++ counts small sets exactly (its sparse form),
    and a group has at most ~50 stations, so the exact SQL is the oracle."""
    return M.agg_hourly(_fct(spark, sf), approx_rsd=0.01)


@register("rollup_member", O.with_ctes("raw") + f"""
  SELECT member_casual, rideable_type, CAST(started_at AS DATE) AS ride_date,
    count(*) AS total_rides, avg({O.MINUTES}) AS avg_duration
  FROM raw GROUP BY member_casual, rideable_type, CAST(started_at AS DATE)""")
def q_rollup_member(spark, sf):
    return M.rollup_member(raw_trips(spark, sf))


@register("rollup_station_hour", O.with_ctes("raw") + """
  SELECT start_station_id, CAST(hour(started_at) AS INTEGER) AS hour,
    isodow(started_at) IN (6, 7) AS is_weekend, count(*) AS ride_count
  FROM raw GROUP BY 1, 2, 3""")
def q_rollup_station_hour(spark, sf):
    return M.rollup_station_hour(raw_trips(spark, sf))


# ---- H: scalar functions over every raw trip --------------------------------

@register("minutes_crossed", O.with_ctes("raw") + f"""
  SELECT ride_id, started_at, ended_at, {O.MINUTES} AS minutes_crossed,
    date_sub('minute', started_at, ended_at) AS minutes_elapsed
  FROM raw""")
def q_minutes_crossed(spark, sf):
    from ..functions.timefn import minutes_crossed
    from pyspark.sql import functions as F
    return raw_trips(spark, sf).select(
        "ride_id", "started_at", "ended_at",
        minutes_crossed("started_at", "ended_at").alias("minutes_crossed"),
        F.timestamp_diff("MINUTE", F.col("started_at"), F.col("ended_at")).alias("minutes_elapsed"))


@register("date_parts", O.with_ctes("raw") + """
  SELECT ride_id, started_at, CAST(started_at AS DATE) AS ride_date,
    CAST(hour(started_at) AS INTEGER) AS ride_hour,
    CAST(isodow(started_at) AS INTEGER) AS day_of_week,
    CAST(month(started_at) AS INTEGER) AS ride_month,
    CAST(year(started_at) AS INTEGER) AS ride_year,
    CAST(year(started_at) * 100 + month(started_at) AS INTEGER) AS year_month
  FROM raw""")
def q_date_parts(spark, sf):
    from ..functions.timefn import date_parts, year_month
    return raw_trips(spark, sf).select(
        "ride_id", "started_at", *[e.alias(n) for n, e in date_parts("started_at").items()],
        year_month("started_at").alias("year_month"))


@register("geo_distance_km", O.with_ctes("raw") + f"""
  SELECT ride_id, start_station_id, end_station_id,
    CASE WHEN {O.VALID4} THEN {O.r(O.haversine())} END AS distance_km,
    {O.r(O.haversine(), 6)} AS haversine_km
  FROM raw""")
def q_geo_distance(spark, sf):
    from pyspark.sql import functions as F
    from ..functions.geo import distance_km, haversine_km
    return raw_trips(spark, sf).select(
        "ride_id", "start_station_id", "end_station_id", distance_km().alias("distance_km"),
        F.round(haversine_km("start_lat", "start_lng", "end_lat", "end_lng"), 6).alias("haversine_km"))


@register("round_modes", f"""
  SELECT event_id, value,
    {O.r("value / CAST(8 AS DOUBLE)")} AS half_up,
    {O.r_even("value / CAST(8 AS DOUBLE)")} AS half_even
  FROM events""")
def q_round_modes(spark, sf):
    from pyspark.sql import functions as F
    from ..functions.fmt import round_half_even, round_half_up
    from ..sources.adapter import read_table
    x = F.col("value") / F.lit(8.0)
    return read_table(spark, sf, "events").select(
        "event_id", "value", round_half_up(x, 2).alias("half_up"), round_half_even(x, 2).alias("half_even"))


@register("bucket_daypart", O.with_ctes("stg") + f"""
  SELECT ride_id, ride_hour, {O.DAYPART} AS time_of_day FROM stg""")
def q_bucket_daypart(spark, sf):
    from ..functions.labels import daypart
    return _stg(spark, sf).select("ride_id", "ride_hour", daypart("ride_hour").alias("time_of_day"))


@register("bucket_weekend", O.with_ctes("stg") + f"""
  SELECT ride_id, day_of_week, {O.WEEKEND} AS is_weekend FROM stg""")
def q_bucket_weekend(spark, sf):
    from ..functions.labels import weekend_label
    return _stg(spark, sf).select("ride_id", "day_of_week", weekend_label("day_of_week").alias("is_weekend"))


@register("bucket_length", O.with_ctes("stg") + f"""
  SELECT ride_id, ride_duration_minutes, {O.LENGTH} AS ride_length_category FROM stg""")
def q_bucket_length(spark, sf):
    from ..functions.labels import length_category
    return _stg(spark, sf).select("ride_id", "ride_duration_minutes",
                                  length_category("ride_duration_minutes").alias("ride_length_category"))


@register("bucket_distance", O.with_ctes("metrics") + f"""
  SELECT ride_id, distance_km, {O.DISTCAT} AS distance_category FROM metrics""")
def q_bucket_distance(spark, sf):
    from ..functions.labels import distance_category
    return M.trip_metrics(_stg(spark, sf)).select(
        "ride_id", "distance_km", distance_category("distance_km").alias("distance_category"))


def _readable_sql(x: str, base: int, units: list[str]) -> str:
    def fmt(v):
        return f"CAST(CAST(round({O.exact(v)}, 2) AS DECIMAL(38,2)) AS VARCHAR)"
    whens = []
    for i in range(len(units) - 1, 0, -1):
        p = f"CAST({float(base) ** i!r} AS DOUBLE)"
        suffix = f" || ' {units[i]}'" if units[i] else ""
        whens.append(f"WHEN abs({x}) >= {p} THEN {fmt(f'({x}) / {p}')}{suffix}")
    tail = f" || ' {units[0]}'" if units[0] else ""
    return f"CASE WHEN ({x}) IS NULL THEN NULL {' '.join(whens)} ELSE {fmt(x)}{tail} END"


@register("human_size", None)
def q_human_size(spark, sf):
    from pyspark.sql import functions as F
    from ..functions.fmt import human_size
    from ..sources.adapter import read_table
    x = F.col("l_extendedprice") * F.pow(F.lit(1024.0), F.col("l_linenumber") - 1)
    return (read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", x.alias("size_bytes"))
            .withColumn("readable_size", human_size("size_bytes")))


@register("human_quantity", None)
def q_human_quantity(spark, sf):
    from pyspark.sql import functions as F
    from ..functions.fmt import human_quantity
    from ..sources.adapter import read_table
    x = F.col("l_orderkey").cast("double") * F.pow(F.lit(1000.0), F.col("l_linenumber") % 5)
    return (read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", x.alias("quantity"))
            .withColumn("readable_quantity", human_quantity("quantity")))


def _fmt_oracles():
    from ..functions.fmt import QUANTITY_BASE, QUANTITY_UNITS, SIZE_BASE, SIZE_UNITS
    xs = "l_extendedprice * power(CAST(1024 AS DOUBLE), l_linenumber - 1)"
    ORACLES["human_size"] = (f"SELECT l_orderkey, l_linenumber, {xs} AS size_bytes, "
                             f"{_readable_sql(xs, SIZE_BASE, SIZE_UNITS)} AS readable_size FROM lineitem")
    xq = "CAST(l_orderkey AS DOUBLE) * power(CAST(1000 AS DOUBLE), l_linenumber % 5)"
    ORACLES["human_quantity"] = (f"SELECT l_orderkey, l_linenumber, {xq} AS quantity, "
                                 f"{_readable_sql(xq, QUANTITY_BASE, QUANTITY_UNITS)} AS readable_quantity "
                                 f"FROM lineitem")


_fmt_oracles()


# ---- C: cleaning over the CSV-text form of every trip ----------------------

def _text(spark, sf):
    from ..sources.adapter import raw_text_from_events, read_table
    return raw_text_from_events(read_table(spark, sf, "events"))


_CLEAN_CTES = {"typed": O.CLEAN_TYPED}
_STRING_OUT = ("ride_id, rideable_type, start_station_name, start_station_id, end_station_name, "
               "end_station_id, member_casual, source_file")


@register("clean_strings", O.with_ctes("raw", extra=_CLEAN_CTES) + f"SELECT {_STRING_OUT} FROM typed")
def q_clean_strings(spark, sf):
    from ..operators.clean import clean_strings
    from ..schema import STRING_COLUMNS
    return clean_strings(_text(spark, sf)).select(*STRING_COLUMNS)


@register("clean_types", O.with_ctes("raw", extra=_CLEAN_CTES) + """
  SELECT ride_id, started_at, ended_at, start_lat, start_lng, end_lat, end_lng FROM typed""")
def q_clean_types(spark, sf):
    from ..operators.clean import clean_strings, clean_types
    return clean_types(clean_strings(_text(spark, sf))).select(
        "ride_id", "started_at", "ended_at", "start_lat", "start_lng", "end_lat", "end_lng")


@register("clean_required", O.with_ctes("raw", extra=_CLEAN_CTES) + """
  SELECT ride_id, rideable_type, started_at, ended_at, member_casual FROM typed
  WHERE started_at IS NOT NULL AND ended_at IS NOT NULL""")
def q_clean_required(spark, sf):
    from ..operators.clean import clean_required, clean_strings, clean_types
    return clean_required(clean_types(clean_strings(_text(spark, sf)))).select(
        "ride_id", "rideable_type", "started_at", "ended_at", "member_casual")


@register("clean_bounds", O.with_ctes("raw", extra=_CLEAN_CTES) + f"""
  SELECT ride_id, started_at, ended_at FROM typed WHERE {O.VALID_BOUNDS}""")
def q_clean_bounds(spark, sf):
    from ..operators.clean import clean_bounds, clean_strings, clean_types
    return clean_bounds(clean_types(clean_strings(_text(spark, sf)))).select("ride_id", "started_at", "ended_at")


@register("clean_trips", O.with_ctes("raw", extra=_CLEAN_CTES) + f"""
  SELECT {O.RAW_COLS} FROM typed WHERE {O.VALID_BOUNDS}""")
def q_clean_trips(spark, sf):
    from ..operators.clean import clean_trips
    from ..schema import RAW_COLUMNS
    return clean_trips(_text(spark, sf)).select(*RAW_COLUMNS)


@register("clean_trips_strict", O.with_ctes("raw", extra=_CLEAN_CTES) + f"""
  SELECT {O.RAW_COLS} FROM typed WHERE {O.VALID_BOUNDS} AND ride_id <> '' AND rideable_type <> ''
    AND member_casual <> ''""")
def q_clean_trips_strict(spark, sf):
    """Cleaner with empty text treated as missing (the documented intent)."""
    from ..operators.clean import clean_trips
    from ..schema import RAW_COLUMNS
    return clean_trips(_text(spark, sf), empty_as_missing=True).select(*RAW_COLUMNS)


@register("clean_drop_report", O.with_ctes("raw", extra=_CLEAN_CTES) + """
  SELECT count(*) AS input_rows,
    count(*) FILTER (WHERE started_at IS NULL OR ended_at IS NULL) AS dropped_missing,
    count(*) FILTER (WHERE started_at IS NOT NULL AND ended_at IS NOT NULL
                     AND NOT (started_at < ended_at)) AS dropped_order,
    count(*) FILTER (WHERE started_at IS NOT NULL AND ended_at IS NOT NULL AND started_at < ended_at
                     AND NOT (epoch_us(ended_at) - epoch_us(started_at) BETWEEN 60000000 AND 86400000000))
      AS dropped_bounds,
    count(*) FILTER (WHERE started_at IS NOT NULL AND ended_at IS NOT NULL AND started_at < ended_at
                     AND epoch_us(ended_at) - epoch_us(started_at) BETWEEN 60000000 AND 86400000000)
      AS kept_rows
  FROM typed""")
def q_clean_drop_report(spark, sf):
    from ..operators.clean import drop_report
    return drop_report(_text(spark, sf))


@register("col_defaults", O.with_ctes("raw", extra=_CLEAN_CTES) + """
  SELECT ride_id, coalesce(start_lat, CAST(0 AS DOUBLE)) AS start_lat,
    coalesce(end_lng, CAST(0 AS DOUBLE)) AS end_lng, source_file,
    CAST('' AS VARCHAR) AS note
  FROM typed""")
def q_col_defaults(spark, sf):
    """Insert defaults: NULL coordinates -> 0, a missing column -> its default."""
    from ..operators.clean import clean_strings, clean_types, with_defaults
    typed = clean_types(clean_strings(_text(spark, sf)))
    return with_defaults(typed, {"start_lat": 0.0, "end_lng": 0.0, "note": ""}).select(
        "ride_id", "start_lat", "end_lng", "source_file", "note")


@register("quality_report", O.with_ctes("raw", extra=_CLEAN_CTES) + f"""
  SELECT count(*) AS total_rows, min(started_at) AS min_started_at, max(started_at) AS max_started_at,
    count(*) FILTER (WHERE ride_id = '') AS empty_ride_id,
    count(*) FILTER (WHERE started_at IS NULL OR started_at = TIMESTAMP '1970-01-01 00:00:00')
      AS default_started_at,
    count(*) FILTER (WHERE start_station_id = '') AS empty_start_station,
    count(*) FILTER (WHERE end_station_id = '') AS empty_end_station
  FROM typed""")
def q_quality_report(spark, sf):
    """Load report over the typed rows (before the validity filters)."""
    from ..operators.clean import clean_strings, clean_types
    from ..operators.quality import quality_report
    return quality_report(clean_types(clean_strings(_text(spark, sf))))


@register("file_summary", O.with_ctes("raw", extra=_CLEAN_CTES) + f"""
  SELECT source_file, count(*) AS row_count, min(loaded_at) AS first_load
  FROM typed WHERE {O.VALID_BOUNDS} AND source_file <> '' GROUP BY source_file""")
def q_file_summary(spark, sf):
    from ..operators.clean import clean_trips
    from ..operators.quality import file_summary
    return file_summary(clean_trips(_text(spark, sf)))


@register("smoke_summary", O.with_ctes("raw") + """
  SELECT count(*) AS total_rides, min(started_at) AS earliest_ride, max(started_at) AS latest_ride,
    count(DISTINCT member_casual) AS user_types, count(DISTINCT rideable_type) AS bike_types
  FROM raw""")
def q_smoke_summary(spark, sf):
    from ..operators.quality import smoke_summary
    return smoke_summary(raw_trips(spark, sf))


# ---- generic operators on the TPC-H-style tables ---------------------------

_LI_TIE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus"]


@register("dedupe_latest", """
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, """ + ", ".join(f"{c} DESC NULLS LAST" for c in _LI_TIE) + ") = 1")
def q_dedupe_latest(spark, sf):
    """Keep-latest on a native table: newest shipdate per (order, line)."""
    from ..operators.dedupe import keep_latest
    from ..sources.adapter import read_table
    li = read_table(spark, sf, "lineitem")
    return keep_latest(li, ["l_orderkey", "l_linenumber"], ["-l_shipdate"],
                       tie_break=["-" + c for c in _LI_TIE])


@register("latest_value", """
  SELECT o_custkey, max({'v': o_orderdate, 'x': o_orderstatus}).x AS latest_status
  FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY o_custkey""")
def q_latest_value(spark, sf):
    """Value at the latest version: each customer's status at its last order."""
    from ..operators.dedupe import latest_value
    from ..sources.adapter import read_table
    return latest_value(read_table(spark, sf, "orders"), ["o_custkey"], "o_orderstatus", "o_orderdate",
                        alias="latest_status")


@register("cond_count", """
  SELECT l_returnflag, count(*) AS total,
    count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines,
    count(*) FILTER (WHERE l_discount > CAST(0.05 AS DOUBLE)) AS discounted,
    count(*) FILTER (WHERE l_quantity >= 25 AND l_linestatus = 'F') AS big_final
  FROM lineitem GROUP BY l_returnflag""")
def q_cond_count(spark, sf):
    from pyspark.sql import functions as F
    from ..sources.adapter import read_table
    li = read_table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        F.count_if(F.col("l_discount") > F.lit(0.05)).alias("discounted"),
        F.count_if((F.col("l_quantity") >= 25) & (F.col("l_linestatus") == "F")).alias("big_final"))


@register("agg_basic", f"""
  SELECT l_returnflag, l_linestatus, count(*) AS n,
    {O.r('avg(l_quantity)')} AS avg_qty,
    {O.r('CAST(sum(CAST(l_extendedprice AS DECIMAL(20,2))) AS DOUBLE)')} AS sum_price,
    min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
    min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_agg_basic(spark, sf):
    from pyspark.sql import functions as F
    from ..sources.adapter import read_table
    li = read_table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("l_quantity"), 2).alias("avg_qty"),
        F.round(M.sum_2dp("l_extendedprice"), 2).alias("sum_price"),
        F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))


@register("agg_median", f"""
  SELECT l_returnflag, l_linestatus, {O.r('median(l_quantity)')} AS median_qty,
    {O.r('median(l_extendedprice)')} AS median_price
  FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_agg_median(spark, sf):
    """Exact (interpolating) median of few groups with many distinct values:
    by counts per value, so no task holds a group's values."""
    from pyspark.sql import functions as F
    from ..operators.medians import median_by_counts
    from ..sources.adapter import read_table
    li = read_table(spark, sf, "lineitem")
    keys = ["l_returnflag", "l_linestatus"]
    qty, price = (median_by_counts(li, keys, c, a) for c, a in (("l_quantity", "median_qty"), ("l_extendedprice", "median_price")))
    return qty.join(price, keys).select(*keys, F.round("median_qty", 2).alias("median_qty"),
                                        F.round("median_price", 2).alias("median_price"))


@register("cond_agg", f"""
  SELECT l_linestatus,
    {O.r('avg(l_quantity) FILTER (WHERE l_returnflag = ' + "'R'" + ')')} AS avg_qty_returned,
    min(l_shipdate) FILTER (WHERE l_returnflag = 'R') AS first_returned,
    max(l_shipdate) FILTER (WHERE l_returnflag = 'R') AS last_returned,
    max(l_extendedprice) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'F') AS max_price_nf
  FROM lineitem GROUP BY l_linestatus""")
def q_cond_agg(spark, sf):
    """Conditional mean / min / max: NULL for a group where no row qualifies."""
    from pyspark.sql import functions as F
    from ..sources.adapter import read_table
    li = read_table(spark, sf, "lineitem")
    ret = F.col("l_returnflag") == "R"
    nf = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    return li.groupBy("l_linestatus").agg(
        F.round(F.avg(F.when(ret, F.col("l_quantity"))), 2).alias("avg_qty_returned"),
        F.min(F.when(ret, F.col("l_shipdate"))).alias("first_returned"),
        F.max(F.when(ret, F.col("l_shipdate"))).alias("last_returned"),
        F.max(F.when(nf, F.col("l_extendedprice"))).alias("max_price_nf"))


@register("distinct_exact", """
  SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers
  FROM lineitem GROUP BY l_returnflag""")
def q_distinct_exact(spark, sf):
    from pyspark.sql import functions as F
    from ..sources.adapter import read_table
    li = read_table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"),
                                          F.count_distinct("l_suppkey").alias("suppliers"))


@register("document_label_stats", """
  WITH st AS (
    SELECT doc_id, count(*) AS n_labels, sum(quality) AS n_good FROM labels GROUP BY doc_id)
  SELECT d.doc_id, d.source, coalesce(st.n_labels, 0) AS n_labels, st.n_good::BIGINT AS n_good
  FROM documents d LEFT JOIN st ON d.doc_id = st.doc_id""")
def q_document_label_stats(spark, sf):
    """Left join of a dimension to aggregated facts: unmatched rows keep 0
    counts and NULL metrics (the station-dimension join, on native tables;
    only some documents have labels)."""
    from pyspark.sql import functions as F
    from ..sources.adapter import read_table
    st = read_table(spark, sf, "labels").groupBy(F.col("doc_id").alias("_id")).agg(
        F.count(F.lit(1)).alias("n_labels"), F.sum("quality").alias("n_good"))
    d = read_table(spark, sf, "documents").select("doc_id", "source")
    j = d.join(st, d.doc_id == st["_id"], "left")
    return j.select("doc_id", "source", F.coalesce("n_labels", F.lit(0)).alias("n_labels"), "n_good")


# ---- A/B: files, loads, sinks ------------------------------------------------
# Inputs are staged from ``events`` as named CSV files (f0.csv, f1.csv, f2.csv
# -- the adapter's source files) in a fresh folder under the session's shared
# checkpoint root; each query returns what it reads back.

BATCH1 = "2024-03-01 00:00:00"
BATCH2 = "2024-03-02 00:00:00"


def _stage(spark, sf, label: str, header_order=None, extra_files: dict | None = None, change: dict | None = None):
    from pyspark.sql import functions as F
    from ..schema import CSV_COLUMNS
    from ..session import scratch_dir
    from ..sources.files import write_named_csv
    work = scratch_dir(spark, label)
    text = _text(spark, sf).select(*CSV_COLUMNS, "source_file").withColumns(change or {})
    paths = write_named_csv(text, f"{work}/in", header_order=header_order)
    for name, (src, cols) in (extra_files or {}).items():
        paths += write_named_csv(text.filter(F.col("source_file") == src)
                                 .withColumn("source_file", F.lit(name)),
                                 f"{work}/in", header_order={name: cols})
    return work, sorted(paths)


def _batch_loaded_at(new_files=("f2.csv",)) -> str:
    names = ", ".join(f"'{n}'" for n in new_files)
    return (f"CASE WHEN source_file IN ({names}) THEN TIMESTAMP '{BATCH2}' "
            f"ELSE TIMESTAMP '{BATCH1}' END")


_RAW_BATCHES = f"SELECT * REPLACE ({_batch_loaded_at()} AS loaded_at) FROM typed WHERE {O.VALID_BOUNDS}"
_RAW_ONE_BATCH = f"SELECT * REPLACE (TIMESTAMP '{BATCH1}' AS loaded_at) FROM typed WHERE {O.VALID_BOUNDS}"


def _raw_cols(df):
    from ..schema import RAW_COLUMNS
    return df.select(*RAW_COLUMNS)


@register("csv_scan", O.with_ctes("raw", raw_body=f"""
  SELECT * REPLACE (TIMESTAMP '{BATCH1}' AS loaded_at,
                    CASE WHEN source_file = 'f2.csv' THEN NULL ELSE end_lat END AS end_lat,
                    'The "' || end_station_name || '", East' AS end_station_name)
  FROM typed WHERE {O.VALID_BOUNDS}""") + f"SELECT {O.RAW_COLS} FROM raw")
def q_csv_scan(spark, sf):
    """CSV bound by header name: f1.csv has its columns reversed, f2.csv lacks
    end_lat, and a file without member_casual is rejected, not misread; names
    hold quotes and commas."""
    from pyspark.sql import functions as F
    from ..operators.clean import clean_trips
    from ..schema import CSV_COLUMNS
    from ..sources.files import read_csv_by_name
    no_member = [c for c in CSV_COLUMNS if c != "member_casual"]
    _, paths = _stage(spark, sf, "csv-scan", header_order={
        "f1.csv": list(reversed(CSV_COLUMNS)),
        "f2.csv": [c for c in CSV_COLUMNS if c != "end_lat"],
    }, extra_files={"nomember.csv": ("f0.csv", no_member)}, change={
        "end_station_name": F.concat(F.lit('The "'), F.col("end_station_name"), F.lit('", East'))})
    text, rejected = read_csv_by_name(spark, paths)
    assert [p.rsplit("/", 1)[-1] for p in rejected] == ["nomember.csv"], rejected
    return _raw_cols(clean_trips(text.withColumn("loaded_at", F.lit(BATCH1).cast("timestamp_ntz"))))


@register("dir_scan", O.with_ctes("raw") + "SELECT source_file, count(*) AS rows_read FROM raw GROUP BY source_file")
def q_dir_scan(spark, sf):
    """Directory listing by glob (a notes.txt file is skipped), rows per file."""
    from pyspark.sql import functions as F
    from ..schema import CSV_COLUMNS
    from ..sources.files import list_files, read_csv_by_name
    work, _ = _stage(spark, sf, "dir-scan", extra_files={"notes.txt": ("f0.csv", CSV_COLUMNS[:3])})
    listing = list_files(spark, f"{work}/in", "*.csv")
    paths = [r[0] for r in listing.select("path").collect()]  # file names only
    text, _ = read_csv_by_name(spark, paths)
    return text.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_read"))


@register("raw_append", O.with_ctes("raw", raw_body=f"SELECT * FROM typed WHERE {O.VALID_BOUNDS}")
          + f"SELECT {O.RAW_COLS} FROM raw")
def q_raw_append(spark, sf):
    """Append cleaned rows file by file into the month x file raw table."""
    from pyspark.sql import functions as F
    from ..operators.clean import clean_trips
    from ..operators.sinks import read_raw, write_raw
    from ..session import scratch_dir
    root = scratch_dir(spark, "raw-append") + "/raw"
    rows = clean_trips(_text(spark, sf))
    for f in ("f0.csv", "f1.csv", "f2.csv"):
        write_raw(rows.filter(F.col("source_file") == f), root, mode="append")
    return _raw_cols(read_raw(spark, root))


@register("month_partition", O.with_ctes("raw", raw_body=f"SELECT * FROM typed WHERE {O.VALID_BOUNDS}") + """
  SELECT CAST(year(started_at) * 100 + month(started_at) AS INTEGER) AS year_month, source_file,
    count(*) AS row_count, min(started_at) AS first_start, max(started_at) AS last_start
  FROM raw GROUP BY 1, 2""")
def q_month_partition(spark, sf):
    """Rows per (year_month, source_file) leaf, read back from the written
    table (year_month comes back from the folder names)."""
    from pyspark.sql import functions as F
    from ..operators.clean import clean_trips
    from ..operators.sinks import read_raw, write_raw
    from ..session import scratch_dir
    root = scratch_dir(spark, "month-partition") + "/raw"
    write_raw(clean_trips(_text(spark, sf)), root)
    raw = read_raw(spark, root)
    return raw.groupBy(F.col("year_month").cast("int").alias("year_month"), "source_file").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("started_at").alias("first_start"),
        F.max("started_at").alias("last_start"))


@register("file_ledger", O.with_ctes("raw", raw_body=_RAW_BATCHES) + f"SELECT {O.RAW_COLS} FROM raw")
def q_file_ledger(spark, sf):
    """Exactly-once loads: f0+f1, then f0+f1+f2 (replays skipped by the
    ledger), then f2 forced again (idempotent leaf rewrite)."""
    from ..operators.sinks import load_trip_files, read_raw
    work, paths = _stage(spark, sf, "file-ledger")
    root = f"{work}/raw"
    first = [p for p in paths if not p.endswith("f2.csv")]
    r1 = load_trip_files(spark, first, root, loaded_at=BATCH1)
    r2 = load_trip_files(spark, paths, root, loaded_at=BATCH2)
    assert r2["skipped"] == ["f0.csv", "f1.csv"] and r2["loaded"] == ["f2.csv"], (r1, r2)
    load_trip_files(spark, [p for p in paths if p.endswith("f2.csv")], root, loaded_at=BATCH2,
                    skip_committed=False)
    return _raw_cols(read_raw(spark, root))


@register("mart_rebuild", O.with_ctes("fct") + "SELECT * FROM fct")
def q_mart_rebuild(spark, sf):
    """Full-rebuild fact table (clustered by date, sorted like the
    reference), written twice: the second overwrite replaces the first."""
    from ..operators.sinks import write_table
    from ..session import scratch_dir
    path = scratch_dir(spark, "mart-rebuild") + "/fct"
    fct = _fct(spark, sf)
    from .pipeline import FACT_ORDER
    for _ in range(2):
        write_table(fct, path, cluster_by=FACT_ORDER, sort_by=FACT_ORDER)
    return spark.read.parquet(path)


def _daily_sql(where: str = "", ctes=("fct",), raw_body=None, extra=None) -> str:
    body = O.DAILY_SELECT
    if where:
        body = body.replace("  FROM fct\n", f"  FROM fct WHERE {where}\n")
    return O.with_ctes(*ctes, raw_body=raw_body, extra=extra) + body


_TARGET = {"tgt": "SELECT ride_date FROM fct WHERE ride_date < DATE '2024-01-20'"}


@register("incr_select_exact", _daily_sql("ride_date IS DISTINCT FROM (SELECT max(ride_date) FROM tgt)",
                                          extra=_TARGET))
def q_incr_select_exact(spark, sf):
    """Incremental selector, reference semantics: recompute every date except
    the target's newest (target = the mart as built before 2024-01-20)."""
    from pyspark.sql import functions as F
    from ..operators.sinks import incr_select
    fct = _fct(spark, sf)
    target = M.agg_daily(fct.filter(F.col("ride_date") < F.lit("2024-01-20").cast("date")))
    return M.agg_daily(incr_select(fct, target, "ride_date", "exact"))


@register("incr_select_watermark", _daily_sql("ride_date >= (SELECT max(ride_date) FROM tgt)", extra=_TARGET))
def q_incr_select_watermark(spark, sf):
    from pyspark.sql import functions as F
    from ..operators.sinks import incr_select
    fct = _fct(spark, sf)
    target = M.agg_daily(fct.filter(F.col("ride_date") < F.lit("2024-01-20").cast("date")))
    return M.agg_daily(incr_select(fct, target, "ride_date", "watermark"))


_NEW_ROWS = "hour(loaded_at) = 6 AND started_at >= TIMESTAMP '2024-01-25 00:00:00'"


@register("incr_select_touched", _daily_sql(
    "ride_date IN (SELECT CAST(started_at AS DATE) FROM raw WHERE " + _NEW_ROWS +
    " UNION SELECT CAST(started_at AS DATE) FROM raw WHERE ride_id IN (SELECT ride_id FROM raw WHERE "
    + _NEW_ROWS + "))"))
def q_incr_select_touched(spark, sf):
    """Touched mode: dates of the new rows (the newest load after 01-25) and
    of earlier versions of the same rides, recomputed from all raw rows."""
    from pyspark.sql import functions as F
    from ..operators.sinks import touched_keys
    from .incremental import daily_for_dates
    raw = raw_trips(spark, sf)
    new = raw.filter((F.hour("loaded_at") == 6)
                     & (F.col("started_at") >= F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")))
    return daily_for_dates(raw, touched_keys(new, raw, "ride_id", F.to_date("started_at")))


@register("incr_daily", _daily_sql(ctes=("fct",), raw_body=_RAW_BATCHES))
def q_incr_daily(spark, sf):
    """Daily mart kept by delete+insert on ride_date: built from f0+f1, then
    refreshed for the dates f2 touches; equals a full rebuild."""
    from ..operators.sinks import load_trip_files, read_raw
    from .incremental import build_daily, read_daily, refresh_from_raw_table
    work, paths = _stage(spark, sf, "incr-daily")
    root, mart = f"{work}/raw", f"{work}/daily"
    load_trip_files(spark, [p for p in paths if not p.endswith("f2.csv")], root, loaded_at=BATCH1)
    build_daily(read_raw(spark, root), mart)
    load_trip_files(spark, paths, root, loaded_at=BATCH2)
    refresh_from_raw_table(spark, root, mart, ["f2.csv"])
    return read_daily(spark, mart)


@register("pipeline_recovery", _daily_sql(ctes=("fct",), raw_body=_RAW_BATCHES))
def q_pipeline_recovery(spark, sf):
    """Loads that no build followed are made up for: load and build f0; load
    f1 only; a build that died after the staged table; run again with f2."""
    from ..operators.sinks import load_trip_files, read_raw
    from .incremental import read_daily, refresh_months, touched_months
    from .pipeline import STG_ORDER, Warehouse, run_pipeline
    work, paths = _stage(spark, sf, "pipeline-recovery")
    wh = Warehouse(f"{work}/wh")
    run_pipeline(spark, paths[:1], wh.root, loaded_at=BATCH1)
    load_trip_files(spark, paths[:2], wh.raw, loaded_at=BATCH1)
    raw = read_raw(spark, wh.raw)
    months = touched_months(raw, raw.filter("source_file = 'f1.csv'"))
    refresh_months(spark, raw, months, wh.table("stg_rides"), M.stg_trips, STG_ORDER)
    run_pipeline(spark, paths, wh.root, loaded_at=BATCH2)
    return read_daily(spark, wh.table("agg_daily_rides"))


_MOVED = "source_file = 'f2.csv' AND hour(started_at) < 6"
_GONE = "source_file = 'f2.csv' AND hour(started_at) >= 18"


@register("reload_changed_file", _daily_sql(ctes=("fct",), raw_body=f"""
  SELECT * REPLACE ({_batch_loaded_at()} AS loaded_at,
    CASE WHEN {_MOVED} THEN started_at + INTERVAL 40 DAY ELSE started_at END AS started_at,
    CASE WHEN {_MOVED} THEN ended_at + INTERVAL 40 DAY ELSE ended_at END AS ended_at)
  FROM typed WHERE {O.VALID_BOUNDS} AND NOT coalesce({_GONE}, false)"""))
def q_reload_changed_file(spark, sf):
    """A file loaded again with rows moved to other months and rows removed:
    its old rows leave the raw table and every model."""
    from pyspark.sql import functions as F
    from ..schema import CSV_COLUMNS
    from ..sources.adapter import TS_TEXT_FORMAT
    from ..sources.files import write_named_csv
    from .incremental import read_daily
    from .pipeline import Warehouse, run_pipeline
    work, paths = _stage(spark, sf, "reload")
    wh = Warehouse(f"{work}/wh")
    run_pipeline(spark, paths, wh.root, loaded_at=BATCH1)
    text = _text(spark, sf).select(*CSV_COLUMNS, "source_file").filter("source_file = 'f2.csv'")
    start = F.expr("try_cast(started_at AS TIMESTAMP_NTZ)")
    moved = {c: F.when(F.hour(start) < 6, F.date_format(F.expr(f"try_cast({c} AS TIMESTAMP_NTZ) + INTERVAL 40 DAYS"), TS_TEXT_FORMAT))
             .otherwise(F.col(c)) for c in ("started_at", "ended_at")}
    text = text.filter(~F.coalesce(F.hour(start) >= 18, F.lit(False))).withColumns(moved)
    changed = write_named_csv(text, f"{work}/again")
    run_pipeline(spark, changed, wh.root, loaded_at=BATCH2, reload=True)
    return read_daily(spark, wh.table("agg_daily_rides"))


# ---- I: streaming --------------------------------------------------------------

@register("stream_then_batch", O.with_ctes("raw", raw_body=_RAW_ONE_BATCH) + f"SELECT {O.RAW_COLS} FROM raw")
def q_stream_then_batch(spark, sf):
    """A batch load of a folder that a stream has ingested loads nothing twice."""
    from ..operators.sinks import load_trip_files, read_raw
    from ..streaming.ingest import start_ingest
    work, paths = _stage(spark, sf, "stream-batch")
    start_ingest(spark, f"{work}/in", f"{work}/raw", f"{work}/_chk", loaded_at=BATCH1).awaitTermination()
    report = load_trip_files(spark, paths, f"{work}/raw", loaded_at=BATCH2, landing=f"{work}/in")
    assert report["loaded"] == [] and len(report["skipped"]) == 3, report
    return _raw_cols(read_raw(spark, f"{work}/raw"))


@register("stream_ingest", O.with_ctes("raw", raw_body=_RAW_ONE_BATCH) + f"SELECT {O.RAW_COLS} FROM raw")
def q_stream_ingest(spark, sf):
    """Exactly-once streaming ingestion: one file per micro-batch; a second
    run on the same checkpoint adds nothing."""
    from ..operators.sinks import read_raw
    from ..streaming.ingest import start_ingest
    work, _ = _stage(spark, sf, "stream-ingest")
    for _ in range(2):
        q = start_ingest(spark, f"{work}/in", f"{work}/raw", f"{work}/_chk", loaded_at=BATCH1,
                         max_files_per_trigger=1)
        q.awaitTermination()
    return _raw_cols(read_raw(spark, f"{work}/raw"))


@register("stream_daily", _daily_sql(ctes=("fct",), raw_body=_RAW_ONE_BATCH))
def q_stream_daily(spark, sf):
    """Daily mart maintained from arriving files (touched dates per batch)."""
    from ..streaming.ingest import start_daily
    from .incremental import read_daily
    work, _ = _stage(spark, sf, "stream-daily")
    q = start_daily(spark, f"{work}/in", f"{work}/raw", f"{work}/daily", f"{work}/_chk",
                    loaded_at=BATCH1, max_files_per_trigger=1)
    q.awaitTermination()
    return read_daily(spark, f"{work}/daily")


# ---- K: data quality ------------------------------------------------------------

@register("dq_not_null", O.with_ctes("raw", extra=_CLEAN_CTES) + """
  SELECT ride_id, source_file, ended_at FROM typed WHERE started_at IS NULL""")
def q_dq_not_null(spark, sf):
    """Failing rows of not_null(started_at) on the typed load."""
    from ..operators.clean import clean_strings, clean_types
    from ..operators.quality import not_null_failures
    typed = clean_types(clean_strings(_text(spark, sf)))
    return not_null_failures(typed, "started_at").select("ride_id", "source_file", "ended_at")


@register("dq_unique", O.with_ctes("raw") + """
  SELECT ride_id, count(*) AS n_records FROM raw WHERE ride_id IS NOT NULL
  GROUP BY ride_id HAVING count(*) > 1""")
def q_dq_unique(spark, sf):
    """Failing values of unique(ride_id) on the raw trips (re-loaded rides)."""
    from ..operators.quality import unique_failures
    return unique_failures(raw_trips(spark, sf), "ride_id")


@register("dq_accepted", O.with_ctes("raw", extra=_CLEAN_CTES) + """
  SELECT ride_id, member_casual FROM typed
  WHERE member_casual IS NOT NULL AND member_casual NOT IN ('member', 'casual')""")
def q_dq_accepted(spark, sf):
    """Failing rows of accepted_values(member_casual, [member, casual])."""
    from ..operators.clean import clean_strings, clean_types
    from ..operators.quality import accepted_failures
    from ..schema import MEMBER_VALUES
    typed = clean_types(clean_strings(_text(spark, sf)))
    return accepted_failures(typed, "member_casual", MEMBER_VALUES).select("ride_id", "member_casual")


# The declared checks of the trip models (defined once, in plans.pipeline).
from .pipeline import CHECKS  # noqa: E402

DQ_SPEC = [(table, nn, uq, acc) for table, (nn, uq, acc) in CHECKS.items()]
_DQ_CTE = {"raw_rides": "raw", "stg_rides": "stg", "stg_stations": "stations", "fct_rides": "fct",
           "dim_stations": "dim", "agg_daily_rides": "daily", "agg_hourly_patterns": "hourly"}


def _dq_union_sql() -> str:
    parts = []
    for table, nn, uq, acc in DQ_SPEC:
        cte = _DQ_CTE[table]
        for c in nn:
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {cte}")
        for c, vals in acc.items():
            lst = ", ".join(f"'{v}'" for v in vals)
            parts.append(f"SELECT '{table}', '{c}', 'accepted_values', "
                         f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({lst})) FROM {cte}")
        for c in uq:
            parts.append(f"SELECT '{table}', '{c}', 'unique', count(*) FROM "
                         f"(SELECT {c} FROM {cte} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) u")
    return "\nUNION ALL\n".join(parts)


def _dq_suite_sql() -> str:
    extra = {"daily": O.DAILY_SELECT, "hourly": O.HOURLY_SELECT}
    return O.with_ctes("fct", "dim", extra=extra) + _dq_union_sql()


@register("dq_suite", _dq_suite_sql())
def q_dq_suite(spark, sf):
    """Every declared check of every model, over the written tables: one row
    per check with its failure count (not_null + accepted fold into one
    aggregate per table)."""
    from ..operators.quality import TableChecks, suite
    from ..operators.sinks import write_raw
    from ..session import scratch_dir
    from .pipeline import Warehouse, build_models
    wh = Warehouse(scratch_dir(spark, "dq-suite"))
    write_raw(raw_trips(spark, sf), wh.raw)
    frames = build_models(spark, wh)
    return suite(TableChecks(t, frames[t], nn, uq, acc) for t, nn, uq, acc in DQ_SPEC)


@register("table_counts", O.with_ctes("fct", "dim", extra={"daily": O.DAILY_SELECT, "hourly": O.HOURLY_SELECT})
          + """
  SELECT 'fct_rides' AS table_name, count(*) AS row_count FROM fct
  UNION ALL SELECT 'dim_stations', count(*) FROM dim
  UNION ALL SELECT 'agg_daily_rides', count(*) FROM daily
  UNION ALL SELECT 'agg_hourly_patterns', count(*) FROM hourly""")
def q_table_counts(spark, sf):
    """Labelled row counts of the four marts (one union of four aggregates)."""
    from ..operators.reports import labelled_counts
    raw = raw_trips(spark, sf)
    stg = M.stg_trips(raw)
    fct = M.fct_trips(M.trip_metrics(stg))
    return labelled_counts({
        "fct_rides": fct, "dim_stations": M.dim_stations(M.stg_stations(raw), stg),
        "agg_daily_rides": M.agg_daily(fct), "agg_hourly_patterns": M.agg_hourly(fct)})


@register("slow_topk", """
  SELECT substring(props, 1, 100) AS query_preview, event_id, user_id, value
  FROM events
  WHERE ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 1 DAY AND event_type = 'error'
    AND props NOT LIKE '%system.%' AND value > 100
  ORDER BY value DESC, event_id LIMIT 10""")
def q_slow_topk(spark, sf):
    """Top 10 slowest 'error' entries of the last day before 2024-01-30 in the
    event log (value as the duration), excluding texts like '%system.%'."""
    from ..operators.reports import slow_topk
    from ..sources.adapter import read_table
    return slow_topk(read_table(spark, sf, "events"), ts="ts", duration="value", text="props",
                     key="event_id", as_of="2024-01-30 00:00:00", min_duration=100,
                     kind_col="event_type", kind="error", extra=["user_id"])


# ---- L10: the whole run ---------------------------------------------------------

_MARTS_CTES = {"daily": O.DAILY_SELECT, "hourly": O.HOURLY_SELECT}


@register("pipeline_run", O.with_ctes("fct", "dim", raw_body=_RAW_BATCHES, extra=_MARTS_CTES) + """
  SELECT 'fct_rides' AS table_name, count(*) AS row_count FROM fct
  UNION ALL SELECT 'dim_stations', count(*) FROM dim
  UNION ALL SELECT 'agg_daily_rides', count(*) FROM daily
  UNION ALL SELECT 'agg_hourly_patterns', count(*) FROM hourly
  UNION ALL SELECT 'rollup_member', count(*) FROM (SELECT DISTINCT member_casual, rideable_type, CAST(started_at AS DATE) FROM raw)
  UNION ALL SELECT 'rollup_station_hour', count(*) FROM (SELECT DISTINCT start_station_id, hour(started_at), isodow(started_at) IN (6, 7) FROM raw)
  UNION ALL SELECT 'failed_checks', count(*) FROM (""" + _dq_union_sql() + """) c WHERE failures > 0""")
def q_pipeline_run(spark, sf):
    """Load f0+f1, run everything; load f2, run again; report mart row
    counts read back from the written tables plus the failed-check count."""
    from pyspark.sql import functions as F
    from ..operators.quality import failed
    from ..operators.reports import labelled_counts
    from .pipeline import Warehouse, run_pipeline
    from .rollups import read_member_rollup, read_station_hour_rollup
    work, paths = _stage(spark, sf, "pipeline")
    run_pipeline(spark, [p for p in paths if not p.endswith("f2.csv")], f"{work}/wh", loaded_at=BATCH1)
    _, checks = run_pipeline(spark, paths, f"{work}/wh", loaded_at=BATCH2)
    wh = Warehouse(f"{work}/wh")
    counts = labelled_counts({n: spark.read.parquet(wh.table(n)) for n in
                              ("fct_rides", "dim_stations", "agg_daily_rides", "agg_hourly_patterns")})
    rollups = labelled_counts({"rollup_member": read_member_rollup(spark, wh.table("rollups")),
                               "rollup_station_hour": read_station_hour_rollup(spark, wh.table("rollups"))})
    counts = counts.unionByName(rollups)
    # missing member_casual text becomes '' and fails accepted_values (raw, staged)
    nfail = failed(checks).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.unionByName(nfail.select(F.lit("failed_checks").alias("table_name"), "row_count"))


@register("data_summary", O.with_ctes("fct", "dim") + f"""
  SELECT 'Raw Rides' AS metric, {{q_raw}} AS value FROM (SELECT count(*) AS n FROM raw)
  UNION ALL SELECT 'Transformed Rides', {{q_n}} FROM (SELECT count(*) AS n FROM fct)
  UNION ALL SELECT 'Unique Stations', {{q_n}} FROM (SELECT count(*) AS n FROM dim)""")
def q_data_summary(spark, sf):
    """Labelled counts rendered with thousand / million units."""
    from pyspark.sql import functions as F
    from ..functions.fmt import human_quantity
    from ..operators.reports import labelled_counts
    raw = raw_trips(spark, sf)
    stg = M.stg_trips(raw)
    counts = labelled_counts({"Raw Rides": raw, "Transformed Rides": M.fct_trips(M.trip_metrics(stg)),
                              "Unique Stations": M.dim_stations(M.stg_stations(raw), stg)})
    return counts.select(F.col("table_name").alias("metric"), human_quantity("row_count").alias("value"))


def _data_summary_oracle():
    from ..functions.fmt import QUANTITY_BASE, QUANTITY_UNITS
    q = _readable_sql("CAST(n AS DOUBLE)", QUANTITY_BASE, QUANTITY_UNITS)
    ORACLES["data_summary"] = ORACLES["data_summary"].replace("{q_raw}", q).replace("{q_n}", q)


_data_summary_oracle()


@register("sql_view_hourly", O.with_ctes("fct") + O.HOURLY_SELECT)
def q_sql_view_hourly(spark, sf):
    """The hourly mart written in Spark SQL over a temporary view of the
    fact model (views are lazy: the SQL plans through the same models)."""
    from .pipeline import register_views
    register_views({"fct_rides_view": _fct(spark, sf)})
    return spark.sql("""
      SELECT ride_hour, is_weekend,
        count(*) AS total_rides,
        count_if(member_casual = 'member') AS member_rides,
        count_if(member_casual = 'casual') AS casual_rides,
        round(avg(ride_duration_minutes), 2) AS avg_ride_duration,
        round(sum(CAST(rint(distance_km * 100D) AS BIGINT)) / 100D / count(distance_km), 2) AS avg_distance_km,
        count(DISTINCT start_station_id) AS unique_start_stations,
        count(DISTINCT end_station_id) AS unique_end_stations
      FROM fct_rides_view
      GROUP BY ride_hour, is_weekend""")


@register("file_report", O.with_ctes("raw", raw_body=f"SELECT * FROM typed WHERE {O.VALID_BOUNDS}") + """
  SELECT CAST(year(started_at) * 100 + month(started_at) AS INTEGER) AS year_month, source_file,
    count(*) AS total_rows, 0::BIGINT AS files_off, 0::BIGINT AS bytes_off, true AS ratio_ok
  FROM raw GROUP BY 1, 2""")
def q_file_report(spark, sf):
    """Files / rows / bytes per leaf of the written raw table (from Parquet
    file metadata); sizes vary by writer, so files and bytes are compared
    with the folder listing."""
    from pyspark.sql import functions as F
    from ..operators.clean import clean_trips
    from ..operators.reports import file_report
    from ..operators.sinks import read_raw, write_raw
    from ..session import scratch_dir
    from ..sources.files import list_files
    root = scratch_dir(spark, "file-report") + "/raw"
    write_raw(clean_trips(_text(spark, sf)), root)
    rep = file_report(read_raw(spark, root), ["year_month", "source_file"])
    seen = list_files(spark, root, "*.parquet", recursive=True).select(
        F.regexp_extract("path", "year_month=([0-9]+)", 1).cast("int").alias("_m"),
        F.regexp_extract("path", "source_file=([^/]+)", 1).alias("_f"), "length")
    seen = seen.groupBy("_m", "_f").agg(F.count(F.lit(1)).alias("_files"), F.sum("length").alias("_bytes"))
    rep = rep.join(seen, (rep["year_month"] == seen["_m"]) & (rep["source_file"] == seen["_f"]), "left")
    return rep.select(F.col("year_month").cast("int").alias("year_month"), "source_file", "total_rows",
                      (F.col("files_count") - F.col("_files")).alias("files_off"), (F.col("bytes_on_disk") - F.col("_bytes")).alias("bytes_off"),
                      (F.abs(F.col("bytes_per_row") * F.col("total_rows") - F.col("_bytes")) <= F.col("total_rows") * 0.01).alias("ratio_ok"))


@register("file_select", """
  SELECT DISTINCT 'f' || CAST(event_id % 3 AS VARCHAR) || '.csv' AS name FROM events
  WHERE 'f' || CAST(event_id % 3 AS VARCHAR) || '.csv' >= 'f1.csv'""")
def q_file_select(spark, sf):
    """File selection on a staged landing folder: names starting 'f' and
    ending '.csv', from 'f1.csv' on (a start name that is absent selects
    nothing); the notes file and the other suffixes are skipped."""
    from ..schema import CSV_COLUMNS
    from ..sources.files import list_files, select_files
    work, _ = _stage(spark, sf, "file-select", extra_files={"notes.txt": ("f0.csv", CSV_COLUMNS[:3])})
    listing = list_files(spark, f"{work}/in", pattern=None)
    assert select_files(listing, "f", ".csv", start_from="f9.csv").count() == 0
    return select_files(listing, "f", ".csv", start_from="f1.csv").select("name")


@register("file_limit", """
  SELECT DISTINCT 'f' || CAST(event_id % 3 AS VARCHAR) || '.csv' AS name FROM events
  WHERE event_id % 3 < 2""")
def q_file_limit(spark, sf):
    """The first two files of the landing folder, by name."""
    from ..sources.files import list_files, select_files
    work, _ = _stage(spark, sf, "file-limit")
    return select_files(list_files(spark, f"{work}/in"), "f", ".csv", limit=2).select("name")


_NATIVE_DQ = [
    ("orders", ["o_orderkey", "o_custkey", "o_orderdate"], ["o_orderkey"], {"o_orderstatus": ["O", "F"]}),
    ("lineitem", ["l_orderkey", "l_shipdate"], ["l_orderkey"], {"l_returnflag": ["A", "N", "R"]}),
]


def _native_dq_sql() -> str:
    parts = []
    for table, nn, uq, acc in _NATIVE_DQ:
        for c in nn:
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {table}")
        for c, vals in acc.items():
            lst = ", ".join(f"'{v}'" for v in vals)
            parts.append(f"SELECT '{table}', '{c}', 'accepted_values', "
                         f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({lst})) FROM {table}")
        for c in uq:
            parts.append(f"SELECT '{table}', '{c}', 'unique', count(*) FROM "
                         f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) u")
    return "\nUNION ALL\n".join(parts)


@register("dq_native", _native_dq_sql())
def q_dq_native(spark, sf):
    """The same check suite on native tables: orders (status 'P' is outside
    the accepted list on purpose) and lineitem (order keys repeat per line)."""
    from ..operators.quality import TableChecks, suite
    from ..sources.adapter import read_table
    return suite(TableChecks(t, read_table(spark, sf, t), nn, uq, acc) for t, nn, uq, acc in _NATIVE_DQ)


def _incremental_rollups(spark, sf, label):
    from ..operators.sinks import load_trip_files
    from .rollups import months_of_files, refresh_rollups
    work, paths = _stage(spark, sf, label)
    raw_root, root = f"{work}/raw", f"{work}/rollups"
    load_trip_files(spark, [p for p in paths if not p.endswith("f2.csv")], raw_root, loaded_at=BATCH1)
    refresh_rollups(spark, raw_root, root)
    load_trip_files(spark, paths, raw_root, loaded_at=BATCH2)
    refresh_rollups(spark, raw_root, root, months=months_of_files(spark, raw_root, ["f2.csv"]))
    return root


_CLEAN_RAW = f"SELECT * FROM typed WHERE {O.VALID_BOUNDS}"


@register("rollup_member_incremental", O.with_ctes("raw", raw_body=_CLEAN_RAW) + f"""
  SELECT member_casual, rideable_type, CAST(started_at AS DATE) AS ride_date,
    count(*) AS total_rides, avg({O.MINUTES}) AS avg_duration
  FROM raw GROUP BY member_casual, rideable_type, CAST(started_at AS DATE)""")
def q_rollup_member_incremental(spark, sf):
    """Member x bike x date rollup kept per month: built from f0+f1, then the
    months f2 touches are recomputed; read back it equals a full recompute."""
    from .rollups import read_member_rollup
    return read_member_rollup(spark, _incremental_rollups(spark, sf, "rollup-member"))


@register("rollup_station_hour_incremental", O.with_ctes("raw", raw_body=_CLEAN_RAW) + """
  SELECT start_station_id, CAST(hour(started_at) AS INTEGER) AS hour,
    isodow(started_at) IN (6, 7) AS is_weekend, count(*) AS ride_count
  FROM raw GROUP BY 1, 2, 3""")
def q_rollup_station_hour_incremental(spark, sf):
    from .rollups import read_station_hour_rollup
    return read_station_hour_rollup(spark, _incremental_rollups(spark, sf, "rollup-station"))


# further queries, registered by import
from . import registry_spans  # noqa: E402, F401
