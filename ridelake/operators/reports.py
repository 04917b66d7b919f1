"""Monitoring-style reports: slow-entry top-k, labelled table counts and
per-partition file statistics of a written table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fmt import human_quantity, human_size
from ..functions.timefn import within_last


def slow_topk(log: DataFrame, *, ts: str, duration: str, text: str, key: str,
              as_of: Column | str | None = None, window: str = "1 DAY",
              min_duration: float = 1000, exclude_like: str = "%system.%",
              kind_col: str | None = None, kind: str | None = None,
              k: int = 10, preview: int = 100, extra: Sequence[str] = ()) -> DataFrame:
    """The ``k`` slowest entries of an activity log in the window before
    ``as_of`` (default now), excluding texts matching ``exclude_like``.

    A global top-k: Spark plans TakeOrderedAndProject, so each task keeps
    only its own k best rows and the driver merges k x tasks rows.
    """
    ref = F.current_timestamp() if as_of is None else (F.lit(as_of).cast("timestamp_ntz")
                                                       if isinstance(as_of, str) else as_of)
    cond = within_last(ts, ref, window) & ~F.col(text).like(exclude_like) & (F.col(duration) > min_duration)
    if kind_col is not None:
        cond = cond & (F.col(kind_col) == F.lit(kind))
    return (log.filter(cond)
            .select(F.substring(F.col(text), 1, preview).alias("query_preview"),
                    F.col(key), *[F.col(c) for c in extra], F.col(duration))
            .orderBy(F.col(duration).desc(), F.col(key).asc())
            .limit(k))


def labelled_counts(tables: dict[str, DataFrame], readable: bool = False) -> DataFrame:
    """One (table_name, row_count) row per table; ``readable`` adds a
    human-readable count."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = reduce(DataFrame.unionByName, parts)
    if readable:
        out = out.withColumn("readable_count", human_quantity("row_count"))
    return out


def file_report(df: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Files, rows and bytes per partition of a file-based table (from the
    hidden ``_metadata`` column; only the size column is read)."""
    keyed = df.select(*partition_cols, F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size"))
    per_file = keyed.groupBy(*partition_cols, "file_path").agg(
        F.count(F.lit(1)).alias("rows"), F.max("file_size").alias("bytes"))
    return (per_file.groupBy(*partition_cols)
            .agg(F.count(F.lit(1)).alias("files_count"), F.sum("rows").alias("total_rows"),
                 F.sum("bytes").alias("bytes_on_disk"))
            .withColumn("size_on_disk", human_size("bytes_on_disk"))
            .withColumn("bytes_per_row", ratio("bytes_on_disk", "total_rows")))


def ratio(num, den, decimals: int = 2) -> Column:
    """round(num / den, decimals); NULL when the denominator is 0 or NULL."""
    d = F.col(den) if isinstance(den, str) else den
    n = F.col(num) if isinstance(num, str) else num
    return F.when(d != 0, F.round(n.cast("double") / d.cast("double"), decimals))
