"""Small files of the raw table's month x file leaves, packed to a target size.

Appends and wide loads leave many small files per leaf.  A leaf that holds
more files than its bytes need is rewritten: its rows go to a folder beside
the table first, and when that is complete, the new leaves take the places
of the old ones, folder by folder.  A run that dies before leaves the table
as it was; one that dies in between has lost nothing, as the new leaf lies
beside the table: ``recover`` (called by loads, builds and the next
``compact``) moves what is left.  One writer at a time is assumed, as for loads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import RAW_PARTITIONS, RAW_SORT, path_exists, raw_table_schema, read_raw

TARGET_BYTES = 256 << 20
PACKED_DIR = "_packed"


def leaf_files(spark: SparkSession, root: str) -> DataFrame:
    """(year_month, source_file, files, bytes) of every leaf, from the folder listing."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
               .schema("path string, modificationTime timestamp, length long, content binary, year_month int, source_file string")
               .load(root).select(*RAW_PARTITIONS, "length"))
    return listing.groupBy(*RAW_PARTITIONS).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str) -> list:
    p, fs = _fs(spark, path)
    return [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]


def recover(spark: SparkSession, root: str) -> None:
    """Move the leaves of complete rewrites into the table; drop incomplete rewrites."""
    if not path_exists(spark, f"{root}/{PACKED_DIR}"):
        return
    for run in _folders(spark, f"{root}/{PACKED_DIR}"):
        _, fs = _fs(spark, run.toString())
        if fs.exists(_fs(spark, f"{run.toString()}/_SUCCESS")[0]):
            for month in _folders(spark, run.toString()):
                for leaf in _folders(spark, month.toString()):
                    place, _ = _fs(spark, f"{root}/{month.getName()}/{leaf.getName()}")
                    fs.delete(place, True)
                    fs.rename(leaf, place)
        fs.delete(run, True)


def compact(spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES) -> int:
    """Pack every leaf that holds more files than its bytes need; returns how many leaves that were."""
    recover(spark, root)
    need = F.ceil(F.col("bytes") / target_bytes)
    leaves = leaf_files(spark, root).where(F.col("files") > need).select(*RAW_PARTITIONS, need.cast("int").alias("parts"))
    listed = leaves.collect()  # folders, which are moved one by one
    if not listed:
        return 0
    run = f"{root}/{PACKED_DIR}/{uuid.uuid4().hex}"
    names = spark.createDataFrame(listed, leaves.schema)
    months = sorted({r.year_month for r in listed})
    rows = read_raw(spark, root, months).join(F.broadcast(names), RAW_PARTITIONS)
    part = F.pmod(F.xxhash64("ride_id", "loaded_at", "started_at"), F.col("parts"))
    sort = [c for c in RAW_SORT if c in rows.columns]
    (rows.withColumn("part", part).repartition(*RAW_PARTITIONS, "part").sortWithinPartitions(*RAW_PARTITIONS, F.to_date("started_at"), *sort)
     .select(*raw_table_schema().names).write.option("compression", "zstd").partitionBy(*RAW_PARTITIONS).parquet(run))
    recover(spark, root)
    return len(listed)
