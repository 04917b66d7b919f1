"""Keep-latest-per-key and value-at-latest-version operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence) -> list[Column]:
    out = []
    for c in cols:
        if isinstance(c, Column):
            out.append(c)
        elif c.startswith("-"):
            out.append(F.desc_nulls_last(c[1:]))
        else:
            out.append(F.asc_nulls_last(c))
    return out


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence, *, tie_break: Sequence | None = None) -> DataFrame:
    """One row per key: the first row by ``order`` (``'-col'`` = descending).

    Planned as ``row_number() = 1`` so Catalyst inserts a partial
    ``WindowGroupLimit`` below the shuffle: each map task forwards at most
    one row per key, which also absorbs a hot key (e.g. a third of all rows
    sharing an empty id) before the exchange.  ``tie_break`` makes the
    choice deterministic; by default every other column, descending.
    """
    keys = list(keys)
    if tie_break is None:
        named = {c.lstrip("-") for c in order if isinstance(c, str)}
        tie_break = ["-" + c for c in df.columns if c not in keys and c not in named]
    w = Window.partitionBy(*keys).orderBy(*_order(list(order) + list(tie_break)))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_value(df: DataFrame, keys: Sequence[str], value: str, version: str,
                 alias: str | None = None, skip_nulls: bool = True) -> DataFrame:
    """``value`` at the greatest ``version`` per key (ties: greatest value).

    A keep-latest on (version, value): the partial group limit forwards one
    row per key and task.  NULL values are skipped first, as argMax does.
    """
    src = df.filter(F.col(value).isNotNull()) if skip_nulls else df
    src = src.select(*keys, F.col(version).alias("_version"), F.col(value).alias("_value"))
    best = keep_latest(src, keys, ["-_version", "-_value"], tie_break=())
    return best.select(*keys, F.col("_value").alias(alias or value))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, order: Sequence[str] = ()) -> DataFrame:
    """Store ``df`` as table ``table`` (files at ``path``) in buckets of ``key``, sorted within them.

    One shuffle when it is written; keep-latest, joins and deletes by
    ``key`` with tables of as many buckets then need none.  Each bucket is
    one file (the rows are dealt to buckets first), and a hot key makes its
    bucket large: bucket what is unique per key, or nearly.
    """
    spark = df.sparkSession
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path).option("compression", "zstd")
     .bucketBy(buckets, key).sortBy(key, *order).saveAsTable(table))
    return spark.table(table)


def upsert_bucketed(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``target`` without the keys of ``new``, and those of ``new``: by bucket, without a shuffle of either."""
    return target.join(new.select(key), key, "left_anti").unionByName(new)
