"""Exact medians of few groups with many distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTS = 1024


def median_by_counts(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Interpolating median of ``value`` per group of ``keys``; NULL values are skipped.

    Values are counted per group (partial aggregation), the counts are summed
    over ``PARTS`` equal steps of each group's value range, and running sums
    of these (at most ``PARTS`` rows per group) tell in which steps the middle
    ranks lie; only the values of those steps are ranked one by one.
    """
    keys = list(keys)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ends = counts.groupBy(*keys).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("total"))
    ends = ends.select(*[F.col(k).alias(f"_{k}") for k in keys], "low", "high", "total")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    step = F.when(F.col("high") > F.col("low"), F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * (PARTS - 1))).otherwise(0)
    placed = counts.join(ends, same).drop(*[f"_{k}" for k in keys]).withColumn("step", step)
    steps = placed.groupBy(*keys, "step").agg(F.sum("n").alias("m"), F.first("total").alias("total"))
    run = Window.partitionBy(*keys).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("before", F.coalesce(F.sum("m").over(run), F.lit(0)))
    # middle ranks, counted from 0
    first, last = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    middle = steps.filter((F.col("before") <= last) & (F.col("before") + F.col("m") > first))
    middle = middle.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("step").alias("_step"), "before")
    inside = placed.join(middle, [*same, F.col("step") == F.col("_step")])
    run = Window.partitionBy(*keys, "step").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("rank", F.col("before") + F.coalesce(F.sum("n").over(run), F.lit(0)))

    def at(rank):
        return F.max(F.when((F.col("rank") <= rank) & (F.col("rank") + F.col("n") > rank), F.col("v")))

    return inside.groupBy(*keys).agg(((at(first) + at(last)) / 2).alias(alias))
