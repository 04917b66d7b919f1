"""Incremental refresh of the daily mart.

The mart is stored partitioned by ``ride_date``; a refresh recomputes only
the touched dates and replaces exactly those partitions (delete+insert by
key).  Touched dates are the dates of the new rows *plus* the dates of
earlier versions of the same rides, since a corrected start time moves a
ride between days; a touched date left without rides is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sinks import drop_keys, overwrite_keys, read_raw, touched_keys, write_table
from ..operators.versions import indexed, months_of_rides, name_list, rows_of_files, versions_in_months
from . import trips as M

MART_KEY = "ride_date"
_DAY = "to_date(started_at) = _d"


def calendar_keys(keys: DataFrame, name: str) -> DataFrame:
    """A set of dates or months, broadcast: its size is bounded by the
    calendar span of the data (days or months), not by the data volume, so
    joins against it never shuffle the big side (nor skew on a hot date)."""
    return F.broadcast(keys.withColumnRenamed("key", name))


def raw_for_dates(raw: DataFrame, dates: DataFrame) -> DataFrame:
    """All versions of every ride that has a version on one of ``dates``.

    Keep-latest over this subset gives the same winner as over the whole
    table for those rides, while reading only the rides that matter.  Rows on
    ``dates`` are taken as they are; only those off them are looked up by ride.
    """
    on_dates = raw.join(calendar_keys(dates, "_d"), F.expr(_DAY), "left_semi")
    ids = on_dates.select("ride_id").distinct()
    return on_dates.unionByName(rows_off_dates(raw, dates).join(ids, "ride_id", "left_semi"))


def rows_off_dates(raw: DataFrame, dates: DataFrame) -> DataFrame:
    return raw.join(calendar_keys(dates, "_d"), F.expr(_DAY), "left_anti")


def daily_for_dates(raw: DataFrame, dates: DataFrame, every: bool = False) -> DataFrame:
    """The mart's rows of ``dates``; ``every``: no raw row lies off them, so there is none to look up."""
    fct = M.fct_from_raw(raw if every else raw_for_dates(raw, dates))
    fct = fct.join(calendar_keys(dates, MART_KEY), MART_KEY, "left_semi")
    return M.agg_daily(fct)


def build_daily(raw: DataFrame, mart_path: str) -> None:
    """First run / full refresh: every date."""
    build_daily_from_fct(M.fct_from_raw(raw), mart_path)


def build_daily_from_fct(fct: DataFrame, mart_path: str) -> None:
    """Replaces the whole mart: dates of an earlier build that have no rides now go."""
    write_table(M.agg_daily(fct), mart_path, partition_by=[MART_KEY])


def refresh_daily(spark: SparkSession, raw: DataFrame, new_rows: DataFrame, mart_path: str,
                  fct: DataFrame | None = None) -> list:
    """Recompute the dates touched by ``new_rows`` (already in ``raw``).

    With ``fct`` (an already refreshed fact table) the touched dates are
    aggregated from it; otherwise they are recomputed from the raw rows of
    the rides involved.  Returns the touched dates that ended with no rides
    (their partitions are dropped).  The touched-date list is collected: it
    is bounded by the calendar (days), not by the data.
    """
    from pyspark.sql import Observation

    dates = touched_keys(new_rows, raw, "ride_id", F.to_date("started_at")).coalesce(1).persist()
    if fct is None:
        daily = daily_for_dates(raw, dates, every=rows_off_dates(raw, dates).isEmpty())
    else:
        daily = M.agg_daily(fct.join(calendar_keys(dates, MART_KEY), MART_KEY, "left_semi"))
    try:
        obs = Observation("dates")
        overwrite_keys(daily.observe(obs, F.collect_set(MART_KEY).alias("dates")), mart_path, MART_KEY)
        kept = set(obs.get["dates"] or [])
        empty = sorted(d for d in (r[0] for r in dates.collect()) if d not in kept)
        drop_keys(spark, mart_path, MART_KEY, [d.isoformat() for d in empty])
        return empty
    finally:
        dates.unpersist()


def read_daily(spark: SparkSession, mart_path: str) -> DataFrame:
    df = spark.read.parquet(mart_path)
    return df.select(*M.DAILY_KEYS, *[c for c in df.columns if c not in M.DAILY_KEYS])


def refresh_from_raw_table(spark: SparkSession, raw_root: str, mart_path: str, new_files) -> list:
    """Refresh after ``new_files`` were loaded into the raw table: reads their
    partitions and, by the version index, the months their rides touch."""
    raw = read_raw(spark, raw_root)
    new_rows = rows_of_files(raw, name_list(spark, new_files))
    if indexed(spark, raw_root):
        raw = versions_in_months(spark, raw_root, months_of_rides(spark, raw_root, new_rows))
    return refresh_daily(spark, raw, new_rows, mart_path)


# --- month-partitioned models (staged trips, fact) -----------------------------

MONTH = "year_month"


def _month(ts: str = "started_at"):
    from ..functions.timefn import year_month
    return year_month(ts)


def touched_months(raw: DataFrame, new_rows: DataFrame) -> list[int]:
    """Months of ``new_rows`` and of earlier versions of the same rides, by one
    narrow scan of all ride ids and months: for raw tables without a version
    index (the result is bounded by the calendar)."""
    return sorted(r[0] for r in touched_keys(new_rows, raw, "ride_id", F.col(MONTH)).collect())


def rides_in_months(raw: DataFrame, months) -> DataFrame:
    """All versions of every ride with a version in one of ``months``, found by a
    scan of all ride ids: for raw tables without a version index."""
    ids = raw.filter(F.col(MONTH).isin(list(months))).select("ride_id").distinct()
    return raw.join(ids, "ride_id", "left_semi")


def write_by_month(df: DataFrame, path: str, sort_by=(), full: bool = False) -> set:
    """Write a trip model partitioned by the month of ``started_at``; with
    dynamic overwrite only the months present in ``df`` are replaced (``full``
    replaces all).  Returns the months written (observed during the write, no
    extra pass).  ``sort_by`` range-clusters the rows on (month, keys) so each
    file holds a narrow, sorted key range and a busy month is split across
    tasks."""
    from pyspark.sql import Observation

    obs = Observation("months")
    out = df.withColumn(MONTH, _month()).observe(obs, F.collect_set(MONTH).alias("months"))
    if sort_by:
        out = out.repartitionByRange(MONTH, *sort_by).sortWithinPartitions(MONTH, *sort_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static" if full else "dynamic")
     .option("compression", "zstd").partitionBy(MONTH).parquet(path))
    return set(obs.get["months"] or [])


def refresh_months(spark: SparkSession, raw: DataFrame, months, path: str, build, sort_by=(), rides: DataFrame | None = None) -> None:
    """Recompute ``months`` of a month-partitioned trip model from only the
    rides involved (``rides``: all their versions, where known); months left
    without rows are removed.  ``build`` maps raw rows to the model:
    keep-latest over all versions of the involved rides picks the same
    winners as over the whole table."""
    rides = rides_in_months(raw, months) if rides is None else rides
    model = build(rides).filter(_month().isin(list(months)))
    written = write_by_month(model, path, sort_by)
    drop_keys(spark, path, MONTH, [m for m in months if m not in written])


def refresh_daily_months(spark: SparkSession, fct: DataFrame, months, mart_path: str) -> list:
    """Recompute the dates of ``months`` from the fact table's partitions;
    dates left without rides are dropped and returned."""
    before = [r[0] for r in spark.read.parquet(mart_path).select(MART_KEY).distinct().collect()]  # bounded by the calendar
    daily = M.agg_daily(fct.filter(F.col(MONTH).isin(list(months))))
    overwrite_keys(daily, mart_path, MART_KEY)
    kept = {r[0] for r in fct.filter(F.col(MONTH).isin(list(months))).select(MART_KEY).distinct().collect()}
    gone = sorted(d for d in before if d.year * 100 + d.month in set(months) and d not in kept)
    drop_keys(spark, mart_path, MART_KEY, [d.isoformat() for d in gone])
    return gone
