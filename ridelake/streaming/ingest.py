"""Structured Streaming file ingestion.

``start_ingest`` turns a landing folder of trip CSV files (plain, gzipped
or zipped) into the raw
table exactly once per file: the file source's checkpoint records which
files were seen, and each micro-batch loads its files through the same
ledger as a batch load, so neither a retried batch nor a later batch load of
the folder loads a file twice.  ``start_daily`` additionally refreshes the
daily mart for the dates each micro-batch touched (late and corrected rows
included).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.sinks import load_trip_files, path_exists, read_raw
from ..plans.incremental import build_daily, refresh_from_raw_table


TRIP_FILES = "*.{csv,csv.gz,zip}"  # what a load reads


def trip_stream(spark: SparkSession, landing: str, pattern: str = TRIP_FILES,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming text rows of the landing folder plus their file name.

    The stream only discovers files (its rows are metadata, no content); each
    micro-batch then loads its files like a batch load, by their headers.
    """
    reader = (spark.readStream.format("binaryFile").option("pathGlobFilter", pattern)
              .schema("path string, modificationTime timestamp, length long, content binary"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing).select("path")


def _start(spark, landing, checkpoint, sink, max_files_per_trigger, available_now) -> StreamingQuery:
    w = (trip_stream(spark, landing, max_files_per_trigger=max_files_per_trigger)
         .writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _load(batch: DataFrame, landing: str, raw_root: str, loaded_at: str | None) -> dict:
    paths = [r[0] for r in batch.collect()]  # the files of this micro-batch
    return load_trip_files(batch.sparkSession, paths, raw_root, loaded_at=loaded_at, landing=landing)


def start_ingest(spark: SparkSession, landing: str, raw_root: str, checkpoint: str,
                 loaded_at: str | None = None, max_files_per_trigger: int | None = None,
                 available_now: bool = True, names_below: str | None = None) -> StreamingQuery:
    """Load files as they arrive; ``names_below``: the folder whose relative paths name them (``landing``)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        _load(batch, names_below or landing, raw_root, loaded_at)

    return _start(spark, landing, checkpoint, sink, max_files_per_trigger, available_now)


def start_daily(spark: SparkSession, landing: str, raw_root: str, mart_path: str, checkpoint: str,
                loaded_at: str | None = None, max_files_per_trigger: int | None = None,
                available_now: bool = True) -> StreamingQuery:
    def sink(batch: DataFrame, batch_id: int) -> None:
        report = _load(batch, landing, raw_root, loaded_at)
        # a replayed micro-batch finds its files loaded: the mart may still lack them
        files = report["loaded"] + report["skipped"]
        if not files:
            return
        session = batch.sparkSession
        if path_exists(session, mart_path):
            refresh_from_raw_table(session, raw_root, mart_path, files)
        else:
            build_daily(read_raw(session, raw_root), mart_path)

    return _start(spark, landing, checkpoint, sink, max_files_per_trigger, available_now)
