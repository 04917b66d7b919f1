"""Benchmark the headline trip queries.

Loads the raw trip table once (from ``events`` through the adapter, written
month x file partitioned like a real load), then times each model reading
that table.  Prints ONE JSON line:
  {"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ridelake.operators.sinks import load_trip_files, read_raw, write_raw  # noqa: E402
from ridelake.operators.versions import index_table  # noqa: E402
from ridelake.plans.pipeline import Warehouse, build_models  # noqa: E402
from ridelake.plans import trips as M  # noqa: E402
from ridelake.plans.rollups import read_member_rollup, refresh_rollups  # noqa: E402
from ridelake.schema import CSV_COLUMNS  # noqa: E402
from ridelake.session import build_session, scratch_dir  # noqa: E402
from ridelake.sources.adapter import raw_trips  # noqa: E402
from ridelake.sources.files import write_named_csv  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int = 3) -> float:
    best = float("inf")
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="ridelake-bench", **{
        "spark.sql.shuffle.partitions": str(max(8, cpus * 2)),
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    work = scratch_dir(spark, "bench")
    wh = Warehouse(f"{work}/wh")
    raw_root, rollup_path = wh.raw, f"{work}/rollups"

    # warm-up (JIT, codegen caches) on the same plans, not timed
    warm = f"{work}/warm"
    write_raw(raw_trips(spark, sf_dir), warm)
    for df in (M.agg_daily(M.fct_from_raw(read_raw(spark, warm))),
               M.dim_stations(M.stg_stations(read_raw(spark, warm)), M.stg_trips(read_raw(spark, warm))),
               M.agg_hourly(M.fct_from_raw(read_raw(spark, warm)))):
        run(df)

    q: dict[str, float] = {}
    q["load_raw"] = timed(lambda: write_raw(raw_trips(spark, sf_dir), raw_root))
    raw = read_raw(spark, raw_root)
    raw_rows = raw.count()

    q["stg_trips"] = timed(lambda: run(M.stg_trips(raw)))
    q["stg_stations"] = timed(lambda: run(M.stg_stations(raw)))
    q["fct_trips"] = timed(lambda: run(M.fct_from_raw(raw)))
    q["dim_stations"] = timed(lambda: run(M.dim_stations(M.stg_stations(raw), M.stg_trips(raw))))
    q["agg_daily"] = timed(lambda: run(M.agg_daily(M.fct_from_raw(raw))))
    q["agg_hourly"] = timed(lambda: run(M.agg_hourly(M.fct_from_raw(raw))))

    # full model build as the pipeline runs it: every model written once
    # (staged trips, stations, fact, dimension, daily, hourly), each read back
    q["pipeline"] = timed(lambda: build_models(spark, wh), repeat=1)

    # a year: the trips of the month repeated over twelve months.  The full
    # build, then one more file (its rows are a fifth of the trips of the last
    # days, half of them corrections of earlier rides): load and build
    year = Warehouse(f"{work}/year")
    shifted = raw_trips(spark, sf_dir).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(11))))
    moved = {c: F.expr(f"CAST(CAST({c} AS TIMESTAMP) + make_interval(0, k) AS TIMESTAMP_NTZ)") for c in ("started_at", "ended_at")}
    write_raw(shifted.withColumns({**moved, "ride_id": F.expr("concat(ride_id, '-', k)")}).drop("k"), year.raw)
    year_rows = read_raw(spark, year.raw).count()
    q["year_index"] = timed(lambda: index_table(spark, year.raw), repeat=1)
    q["year_pipeline"] = timed(lambda: build_models(spark, year), repeat=1)
    extra = (raw_trips(spark, sf_dir).filter("started_at >= '2024-01-25' AND pmod(xxhash64(ride_id), 5) = 0")
             .withColumn("ride_id", F.expr("concat(ride_id, if(pmod(xxhash64(ride_id), 10) = 0, '-0', '-x'))"))
             .select(*CSV_COLUMNS, F.lit("late.csv").alias("source_file")))
    paths = write_named_csv(extra, f"{work}/in")
    report = {}
    q["year_increment_load"] = timed(lambda: report.update(load_trip_files(spark, paths, year.raw, loaded_at="2025-06-01 00:00:00")), repeat=1)
    q["year_increment_build"] = timed(lambda: build_models(spark, year), repeat=1)
    q["year_increment"] = round(q["year_increment_load"] + q["year_increment_build"], 3)

    # pre-aggregated rollups (kept per month): build once, then answer the
    # member x bike x date question from the rollup vs from the raw table
    q["rollup_build"] = timed(lambda: refresh_rollups(spark, raw_root, rollup_path), repeat=1)
    q["rollup_read"] = timed(lambda: run(read_member_rollup(spark, rollup_path)))
    q["rollup_recompute"] = timed(lambda: run(M.rollup_member(raw)))

    m = re.search(r"sf([0-9.]+)", sf_dir)
    headline = ["stg_trips", "stg_stations", "dim_stations", "agg_daily", "agg_hourly"]
    print(json.dumps({
        "metric": "trip_marts_total_sec",
        "value": round(sum(q[k] for k in headline), 3),
        "unit": "sec",
        "queries": q,
        "sf": float(m.group(1)) if m else sf_dir,
        "raw_rows": raw_rows,
        "year_rows": year_rows,
        "increment_rows": report["rows"]["kept_rows"],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
