"""Helpers shared by the document operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from functools import wraps

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# ASCII white space between words, as a Java/RE2 character class body
WS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage at a table every executor can read, so a lost executor
    costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def apart(*read: str) -> Callable:
    """For operators on rows: an input's columns beyond ``read`` are carried as one struct and
    put back at the end, so that none can clash with a column the operator makes on the way.
    A column named like one of its results is replaced."""
    def deco(operator):
        @wraps(operator)
        def run(rows: DataFrame, *args, **params) -> DataFrame:
            others = [c for c in rows.columns if c not in read]
            if not others:
                return operator(rows, *args, **params)
            here = [c for c in rows.columns if c in read]
            out = operator(rows.select(*here, F.struct(*others).alias("_others_")), *args, **params)
            new = [c for c in out.columns if c not in (*here, "_others_")]
            old = [F.col(c) if c in here else F.col("_others_").getField(c).alias(c)
                   for c in rows.columns if c not in new and (c in others or c in out.columns)]
            return out.select(*old, *new)
        return run
    return deco


def fold(doc_id="doc_id") -> Column:
    """crc32 of the id as text, mod 4; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def held_out(doc_id="doc_id") -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def learnable(doc_id="doc_id") -> Column:
    return F.coalesce(fold(doc_id) != 2, F.lit(False))


def words(text: Column) -> Column:
    """White-space separated words of ``text`` (NULL: no words)."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{WS}]+")
    return F.filter(parts, lambda w: w != "")


def shipped(spark: SparkSession, value) -> Broadcast:
    """``value`` for tasks, with its class: a plain broadcast would ask executors to import this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def unpacked(shared: Broadcast):
    """What ``shipped`` sent, in a task."""
    return pickle.loads(shared.value)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches small enough that a Python task holds few long texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def strings(batch) -> list:
    """The texts of a pandas batch, None where missing."""
    return [t if isinstance(t, str) else None for t in batch]


MARK_BITS = 1 << 24  # 2 MB of bitmaps, whatever the data


def marks(keys: DataFrame, *columns: str) -> DataFrame:
    """A bitmap of the hashed keys: (bucket, bitmap), of ``MARK_BITS`` bits at most."""
    at = F.pmod(F.xxhash64(*columns), F.lit(MARK_BITS)) + 1
    bits = keys.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
    return bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def marked(rows: DataFrame, bitmaps: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with ``_marked``: false only where the key is surely none of those marked.

    The bitmaps are of bounded size, so they are broadcast; rows without a
    mark need not be shuffled to a join with the keys.
    """
    at = F.pmod(F.xxhash64(*columns), F.lit(MARK_BITS)) + 1
    maps = F.broadcast(bitmaps.select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap")))
    rows = rows.withColumn("_at", at).join(maps, F.bitmap_bucket_number("_at") == F.col("_bucket"), "left")
    bit = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.substr("_bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (bit % 8).cast("int")) == 1
    return rows.withColumn("_marked", F.coalesce(hit, F.lit(False))).drop("_at", "_bucket", "_bitmap")
