"""The whole run in dependency order: load -> staging -> fact -> marts -> checks.

Staged trips are written once and every downstream model reads that table,
so the one heavy exchange (keep-latest on ride_id) runs once per run, and
each written table also cuts the lineage (a lost executor recomputes from
the last written table, not from the raw files).

The models record which loads they have consumed, after all of them are
written.  A build takes its work from the raw table's ledger less that
record, so a load that no build followed, or a build that died midway, is
made up for by the next one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import TableChecks, suite
from ..operators.compact import recover
from ..operators.versions import indexed, months_of_rides, name_list, rows_of_files, versions_in_months
from ..operators.sinks import LEDGER_DIR, committed_files, drop_keys, load_trip_files, path_exists, read_raw, write_table
from ..session import concurrently, scratch_dir
from . import trips as M
from .incremental import (build_daily_from_fct, read_daily, refresh_daily_months, refresh_months, touched_months,
                          write_by_month)
from .monthly import (hourly_from_parts, refresh_parts, refresh_station_tuples, station_stats_from_parts,
                      stations_from_parts)
from .rollups import refresh_rollups


@dataclass
class Warehouse:
    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw_rides"

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def consumed(self) -> str:
        return f"{self.root}/_consumed"


# Fact layout: range-clustered on the full sort key, so a date holding a
# third of all rides is still split across many files / tasks.
FACT_ORDER = ["ride_date", "member_casual", "rideable_type", "started_at"]

# Staged trips: by ride, so that files per month follow its rows, not the number of tasks.
STG_ORDER = ["ride_id"]

# The declared checks (not_null, unique, accepted) per model.
CHECKS = {
    "raw_rides": (["ride_id", "started_at", "ended_at"], [], {"member_casual": ["member", "casual"]}),
    "stg_rides": (["ride_id", "rideable_type", "started_at", "ended_at", "member_casual"], [],
                  {"member_casual": ["member", "casual"]}),
    "stg_stations": (["station_id", "station_name"], ["station_id"], {}),
    "fct_rides": (["ride_id", "ride_duration_minutes"], ["ride_id"], {}),
    "dim_stations": (["station_id", "station_name"], ["station_id"], {}),
    "agg_daily_rides": (["ride_date", "total_rides"], ["ride_date"], {}),
    "agg_hourly_patterns": (["ride_hour"], [], {}),
}


CONSUMED_SCHEMA = "source_file string, batch string, months array<int>"


def unconsumed(spark: SparkSession, wh: Warehouse) -> DataFrame | None:
    """(source_file, batch, months) of the committed loads that the models lack.

    None when the models have consumed nothing yet: everything is to be built.
    """
    if not path_exists(spark, wh.consumed):
        return None
    done = spark.read.schema(CONSUMED_SCHEMA).parquet(wh.consumed).select("source_file", "batch")
    loads = committed_files(spark, wh.raw).select("source_file", "batch", "months")
    return loads.join(done, ["source_file", "batch"], "left_anti")


def build_models(spark: SparkSession, wh: Warehouse, empty_as_missing: bool = False,
                 speed_guard: str = "exact", new_files: list[str] | None = None, full: bool = False) -> dict[str, DataFrame]:
    """Build every model from the raw table; returns the written tables.

    Staged trips and the fact table are stored by month.  The first build
    makes everything; later ones take the loads not consumed yet (of these
    only ``new_files``, where given) and recompute only the months these
    touch: months of their rows, of earlier versions of the same rides, and
    of rides that a reload moved or removed.  The touched months are found
    once, by the version index, so no raw scan covers the history; staged
    trips come from the rides of these months, the fact table from the
    staged months, the daily mart, monthly partials and rollups from months
    by partition.
    """
    recover(spark, wh.raw)
    raw = read_raw(spark, wh.raw)
    stg_path, fct_path, daily_path = wh.table("stg_rides"), wh.table("fct_rides"), wh.table("agg_daily_rides")
    parts_root, rollups = wh.table("fct_monthly_parts"), wh.table("rollups")
    built = all(path_exists(spark, p) for p in (stg_path, fct_path, daily_path, wh.table("agg_hourly_patterns")))
    work, loads, extra = None, None, []
    if path_exists(spark, f"{wh.raw}/{LEDGER_DIR}"):
        loads = unconsumed(spark, wh) if built and not full else None
        path = scratch_dir(spark, "loads")  # the loads this build takes, whatever is loaded meanwhile
        taken = committed_files(spark, wh.raw).select("source_file", "batch", "months") if loads is None else loads
        if new_files is not None and loads is not None:
            taken = taken.where(F.col("source_file").isin(list(new_files)))
        taken.write.parquet(path)
        taken = spark.read.schema(CONSUMED_SCHEMA).parquet(path)
        if loads is not None:
            work = taken.select("source_file")
            extra = sorted(r[0] for r in taken.select(F.explode("months")).distinct().collect())  # bounded by the calendar
        loads = taken
    elif new_files is not None and built and not full:
        work = name_list(spark, new_files)
    if work is not None:
        new_rows = rows_of_files(raw, work)
        own = sorted(r[0] for r in new_rows.select("year_month").distinct().collect())
        by_index = indexed(spark, wh.raw)
        find = months_of_rides(spark, wh.raw, new_rows) if by_index and own else touched_months(raw, new_rows) if own else []
        months = sorted({*find, *extra})
        raw_months = sorted({*own, *extra})
        if months:
            rides = versions_in_months(spark, wh.raw, months) if by_index else None
            refresh_months(spark, raw, months, stg_path, M.stg_trips, STG_ORDER, rides)
            stg_months = spark.read.schema(_stored(M.stg_trips(raw))).parquet(stg_path).filter(F.col("year_month").isin(months))
            written = write_by_month(M.fct_trips(M.trip_metrics(stg_months, speed_guard)), fct_path, FACT_ORDER)
            drop_keys(spark, fct_path, "year_month", [m for m in months if m not in written])
    else:
        months = raw_months = None
        write_by_month(M.stg_trips(raw), stg_path, STG_ORDER, full=True)
        stg_table = spark.read.schema(_stored(M.stg_trips(raw))).parquet(stg_path)
        write_by_month(M.fct_trips(M.trip_metrics(stg_table, speed_guard)), fct_path, FACT_ORDER, full=True)
    stg = spark.read.schema(_stored(M.stg_trips(raw))).parquet(stg_path)
    fct = spark.read.schema(_stored(M.fct_from_raw(raw))).parquet(fct_path)

    def parts():  # monthly partials of the fact table: only the touched months are rescanned
        if months is None or months:
            refresh_parts(spark, fct, parts_root, months, empty_as_missing)

    def stations_by_month():  # station tuples per month of the raw rows
        if raw_months is None or raw_months:
            refresh_station_tuples(spark, raw, parts_root, raw_months, empty_as_missing)
        write_table(stations_from_parts(spark, parts_root), wh.table("stg_stations"), sort_by=["station_id"])

    def rollups_by_month():
        if raw_months is None or raw_months:
            refresh_rollups(spark, wh.raw, rollups, raw_months)

    def daily():
        if months is None:
            build_daily_from_fct(fct, daily_path)
        elif months:
            refresh_daily_months(spark, fct, months, daily_path)

    concurrently(spark, parts, stations_by_month, rollups_by_month, daily)
    stations = spark.read.parquet(wh.table("stg_stations"))

    def dimension():
        write_table(M.dim_from_stats(stations, station_stats_from_parts(spark, parts_root)),
                    wh.table("dim_stations"), sort_by=["station_id"])

    def hourly():
        write_table(hourly_from_parts(spark, parts_root), wh.table("agg_hourly_patterns"), sort_by=["is_weekend", "ride_hour"])

    concurrently(spark, dimension, hourly)
    if loads is not None:
        loads.write.mode("append").parquet(wh.consumed)
    return {
        "raw_rides": raw, "stg_rides": stg, "stg_stations": stations, "fct_rides": fct,
        "dim_stations": spark.read.parquet(wh.table("dim_stations")),
        "agg_daily_rides": read_daily(spark, daily_path),
        "agg_hourly_patterns": spark.read.parquet(wh.table("agg_hourly_patterns")),
    }


def _stored(df: DataFrame):
    """Schema of a trip model as stored: its columns and the month partition."""
    return T.StructType([f for f in df.schema.fields if f.name != "year_month"] + [T.StructField("year_month", T.IntegerType())])


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Expose models to SQL users as temporary views (lazy, like the
    reference's view models); returns the view names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def run_checks(tables: dict[str, DataFrame]) -> DataFrame:
    return suite(TableChecks(name, tables[name], *CHECKS[name]) for name in CHECKS if name in tables)


def run_pipeline(spark: SparkSession, files: list[str], warehouse_root: str, loaded_at: str | None = None,
                 empty_as_missing: bool = False, speed_guard: str = "exact",
                 landing: str | None = None, reload: bool = False) -> tuple[dict, DataFrame]:
    """Load new files (exactly once), bring the models up to date, run the checks.

    Returns (load report, check results).  Callers decide whether failures
    (``ridelake.operators.quality.failed``) abort the run.
    """
    wh = Warehouse(warehouse_root)
    report = load_trip_files(spark, files, wh.raw, loaded_at=loaded_at, skip_committed=not reload,
                             empty_as_missing=empty_as_missing, landing=landing)
    tables = build_models(spark, wh, empty_as_missing, speed_guard)
    return report, run_checks(tables)
