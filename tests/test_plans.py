"""Plan assertions: the physical plans we rely on for scale."""

from ridelake.plans import trips as M
from ridelake.sources.adapter import raw_trips

from conftest import SF_SMOKE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest_uses_partial_group_limit(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(M.stg_trips(raw_trips(spark, SF_SMOKE)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("WindowGroupLimit") >= 2, p          # partial below + final above the exchange
    assert p.count("Exchange hashpartitioning(ride_id") == 1, p


def test_scan_prunes_columns_and_pushes_filters(spark):
    from pyspark.sql import functions as F
    ev = spark.read.parquet(f"{SF_SMOKE}/events.parquet").filter(F.col("user_id") > 10).select("event_id")
    p = plan(ev)
    assert "PushedFilters: [IsNotNull(user_id), GreaterThan(user_id,10)]" in p, p
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in p, p


def test_daily_mart_single_exchange_after_dedupe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(M.agg_daily(M.fct_from_raw(raw_trips(spark, SF_SMOKE))))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange hashpartitioning") == 2, p  # ride_id, then the day keys
    assert "BroadcastExchange" not in p


def test_no_python_in_models(spark):
    raw = raw_trips(spark, SF_SMOKE)
    stg = M.stg_trips(raw)
    for df in (M.agg_hourly(M.fct_trips(M.trip_metrics(stg))), M.dim_stations(M.stg_stations(raw), stg)):
        p = plan(df)
        assert "Python" not in p and "ArrowEval" not in p and "BatchEval" not in p


def test_broadcast_only_from_measured_sizes(spark):
    from ridelake.session import configure
    configure(spark)
    raw = raw_trips(spark, SF_SMOKE)
    dim = M.dim_stations(M.stg_stations(raw), M.stg_trips(raw))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        static = plan(dim)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastExchange" not in static and "SortMergeJoin" in static, static
    stations = M.stg_stations(raw).select("station_id", "latitude")
    named = raw.join(stations, raw["start_station_id"] == stations["station_id"])  # fresh plan, AQE on
    named.collect()
    final = named._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final, final  # measured: the stations are tiny
    dim = M.dim_stations(M.stg_stations(raw), M.stg_trips(raw))
    dim.collect()
    final = dim._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # both sides come grouped by station: the join adds no exchange
    assert final.count("Exchange hashpartitioning(station_id") <= 3 and "BroadcastExchange" not in final.split("SortMergeJoin")[0], final


def test_calendar_keyed_joins_never_shuffle_the_big_side(spark):
    from pyspark.sql import functions as F
    from ridelake.operators.sinks import touched_keys
    from ridelake.plans.incremental import daily_for_dates
    from ridelake.session import configure
    configure(spark)
    raw = raw_trips(spark, SF_SMOKE)
    df = daily_for_dates(raw, touched_keys(raw.filter(F.hour("loaded_at") == 6), raw, "ride_id",
                                           F.to_date("started_at")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Exchange hashpartitioning(cast(started_at" not in p, p
    assert p.count("BroadcastHashJoin") >= 2, p    # raw and fact joined to the touched dates
