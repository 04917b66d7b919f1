"""Approximate statistics that merge: sketches stored per month, combined for any span.

  station_sketches   HyperLogLog of start and end stations per month, hour and weekend flag
  duration_sketches  KLL quantiles of ride minutes per month and day

A sketch has a fixed size whatever the rides it stands for, a load refreshes
only the months it touches, and a reader merges the few stored rows: a
distinct count or quantile over years reads no ride.  (Exact distinct counts
need the presence rows of ``monthly``; exact medians need the rides.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sinks import drop_keys, path_exists

MONTH = "year_month"
STATIONS, DURATIONS = "station_sketches", "duration_sketches"
LG_K = 12  # HyperLogLog registers (log2): relative error about 1.6 %
KLL_K = 400  # quantile sketch: rank error about 0.7 %


def station_sketches(fct: DataFrame, lg_k: int = LG_K) -> DataFrame:
    def sketch(station: str) -> Column:  # a sketch passes over the empty text, which is a station here
        return F.hll_sketch_agg(F.concat(F.lit("s"), station), lg_k)

    return fct.groupBy(MONTH, "ride_hour", "is_weekend").agg(sketch("start_station_id").alias("starts"), sketch("end_station_id").alias("ends"))


def duration_sketches(fct: DataFrame, k: int = KLL_K) -> DataFrame:
    return fct.groupBy(MONTH, "ride_date").agg(F.kll_sketch_agg_bigint("ride_duration_minutes", k).alias("minutes"))


def refresh_sketches(spark: SparkSession, fct: DataFrame, root: str, months: Sequence[int] | None = None,
                     lg_k: int = LG_K, k: int = KLL_K) -> None:
    """(Re)write the sketches of ``months`` (all when None) from these partitions of the fact table."""
    sub = fct if months is None else fct.where(F.col(MONTH).isin(list(months)))
    for name, built in ((STATIONS, station_sketches(sub, lg_k)), (DURATIONS, duration_sketches(sub, k))):
        (built.write.mode("overwrite").option("partitionOverwriteMode", "static" if months is None else "dynamic")
         .option("compression", "zstd").partitionBy(MONTH).parquet(f"{root}/{name}"))
    if months:
        present = {r[0] for r in sub.select(MONTH).distinct().collect()}  # bounded by the calendar
        for name in (STATIONS, DURATIONS):
            if path_exists(spark, f"{root}/{name}"):
                drop_keys(spark, f"{root}/{name}", MONTH, [m for m in months if m not in present])


def hourly_stations(spark: SparkSession, root: str, months: Sequence[int] | None = None) -> DataFrame:
    """Distinct start and end stations per hour and weekend flag, merged over the months."""
    rows = spark.read.parquet(f"{root}/{STATIONS}")
    if months is not None:
        rows = rows.where(F.col(MONTH).isin(list(months)))
    return rows.groupBy("ride_hour", "is_weekend").agg(
        F.hll_sketch_estimate(F.hll_union_agg("starts")).alias("unique_start_stations"),
        F.hll_sketch_estimate(F.hll_union_agg("ends")).alias("unique_end_stations"))


def duration_quantiles(spark: SparkSession, root: str, span: Column, quantiles: Sequence[float] = (0.5,),
                       name: str = "span", k: int = KLL_K) -> DataFrame:
    """n and quantiles q50, … of ride minutes per ``span``, an expression over ``ride_date`` (a week, a season, all)."""
    merged = spark.read.parquet(f"{root}/{DURATIONS}").groupBy(span.alias(name)).agg(F.kll_merge_agg_bigint("minutes", k).alias("s"))
    return merged.select(name, F.kll_sketch_get_n_bigint("s").alias("n"),
                         *[F.kll_sketch_get_quantile_bigint("s", F.lit(float(p))).alias(f"q{round(p * 100):02d}") for p in quantiles])


def within_rank(rows: DataFrame, value: str, estimates: DataFrame, quantiles: Sequence[float], slack: float, key: str) -> DataFrame:
    """Per ``key``: whether every estimated quantile's rank among ``rows`` is within ``slack`` of the one asked for."""
    near = F.lit(True)
    aggs = []
    for p in quantiles:
        c = f"q{round(p * 100):02d}"
        aggs += [F.avg((F.col(value) < F.col(c)).cast("int")).alias(f"_lo_{c}"), F.avg((F.col(value) <= F.col(c)).cast("int")).alias(f"_hi_{c}")]
        near = near & (F.col(f"_lo_{c}") <= p + slack) & (F.col(f"_hi_{c}") >= p - slack)
    return rows.join(estimates, key).groupBy(key).agg(F.count(value).alias("n"), *aggs).select(key, "n", near.alias("within"))
