"""Hourly ride counts by event time.

Rows of the raw table stream in as loads add them.  An hour is final once
the watermark (the latest start seen, less ``delay``) has passed its end; it
is then emitted once and its state dropped, so the state holds the open
hours only, however long the stream runs.  Rows that arrive for a final hour
are not counted in it; ``late_rows`` says how many there were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sinks import raw_table_schema

DELAY = "2 hours"


def hourly_counts(rows: DataFrame, delay: str = DELAY) -> DataFrame:
    """(hour_start, rides, member_rides) of a stream of trips, one row per final hour."""
    # watermarks need an instant: the wall-clock time is read and given back in the session's zone (UTC)
    counts = rows.withColumn("started_at", F.col("started_at").cast("timestamp")).withWatermark("started_at", delay).groupBy(F.window("started_at", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("rides"), F.count_if(F.col("member_casual") == "member").alias("member_rides"))
    return counts.select(F.col("w.start").cast("timestamp_ntz").alias("hour_start"), "rides", "member_rides")


def start_hourly(spark: SparkSession, raw_root: str, out: str, checkpoint: str, delay: str = DELAY,
                 available_now: bool = True) -> StreamingQuery:
    """Append final hours to the Parquet table ``out``.  A restart goes on from
    the checkpoint: open hours are kept, no hour is written twice."""
    rows = spark.readStream.schema(raw_table_schema()).parquet(raw_root)
    writer = (hourly_counts(rows, delay).writeStream.format("parquet").outputMode("append")
              .option("path", out).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def late_rows(hours: DataFrame, raw: DataFrame) -> DataFrame:
    """``hours`` with late_rows: rows of the raw table that came after their hour was final."""
    arrived = raw.groupBy(F.date_trunc("hour", "started_at").cast("timestamp_ntz").alias("hour_start")).agg(F.count(F.lit(1)).alias("_n"))
    return hours.join(arrived, "hour_start", "left").withColumn("late_rows", F.coalesce("_n", F.lit(0)) - F.col("rides")).drop("_n")
