"""Materialisation: the partitioned raw table, idempotent per-file loads,
full-rebuild marts and key-partitioned incremental upserts.

Layout of the raw table:  <root>/year_month=YYYYMM/source_file=<name>/*.parquet
Every source file owns its own leaves.  A load first marks its files as
begun in the ledger; files marked before may have leaves, which are cleared.
Then the leaves are written anew, so a retry can neither lose nor duplicate
rows and a reloaded file keeps no row it no longer has.  The row that commits
a file is appended only after its data is written, so a crashed load is
simply re-run.  A file is known by its decoded path below the landing folder
(its base name when none is given).  What a load reads of the table follows
its files, not the history (see ``versions``).
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import year_month
from ..schema import RAW_COLUMNS, RAW_SCHEMA
from .versions import index_load, indexed, months_of_rides, name_list, raw_months, rows_of_files

RAW_PARTITIONS = ["year_month", "source_file"]
RAW_SORT = ["ride_date", "member_casual", "rideable_type", "ride_id"]
LEDGER_DIR = "_ledger"


def with_month(df: DataFrame, ts: str = "started_at") -> DataFrame:
    return df.withColumn("year_month", year_month(ts))


def write_raw(df: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Write raw rows into month x file leaves.

    No shuffle: each task writes the leaves its rows fall in (a file's
    splits are read by different tasks, so even one huge file is written
    in parallel); rows are sorted inside each task for tight min/max stats.
    """
    out = with_month(df.select(*RAW_COLUMNS))
    (out.sortWithinPartitions(*RAW_PARTITIONS, F.to_date("started_at"), "member_casual",
                              "rideable_type", "ride_id")
     .write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy(*RAW_PARTITIONS).parquet(root))


def read_raw(spark: SparkSession, root: str, months: Sequence[int] | None = None) -> DataFrame:
    """The raw table; ``months`` prunes partitions (yyyyMM ints).

    Read with the declared schema: no footer sampling for schema inference
    (costly over many files) and an empty table reads as empty."""
    df = spark.read.schema(raw_table_schema()).parquet(root)
    if months is not None:
        df = df.filter(F.col("year_month").isin(*months))
    return df


def between_dates(df: DataFrame, lo: str, hi: str, ts: str = "started_at") -> DataFrame:
    """Filter on the timestamp *and* on the month partition column, so the
    scan prunes partitions (a predicate on ``ts`` alone cannot)."""
    lo_d, hi_d = dt.date.fromisoformat(lo[:10]), dt.date.fromisoformat(hi[:10])
    return df.filter((F.col(ts) >= F.lit(lo).cast("timestamp_ntz")) & (F.col(ts) < F.lit(hi).cast("timestamp_ntz"))
                     & F.col("year_month").between(lo_d.year * 100 + lo_d.month, hi_d.year * 100 + hi_d.month))


# --- file ledger ----------------------------------------------------------------

# months: months whose models a reload changes beyond those of the file's rows
# indexed: the file's rows are entered in the version index
LEDGER_SCHEMA = ("source_file string, path string, rows long, batch string, months array<int>, "
                 "done boolean, indexed boolean, committed_at timestamp_ntz")


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The newest ledger row of every file."""
    path = f"{root}/{LEDGER_DIR}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    newest = rows.groupBy("source_file").agg(F.max(F.struct("committed_at", "done", "indexed", "path", "rows", "batch", "months")).alias("r"))
    return newest.select("source_file", "r.*")


def committed_files(spark: SparkSession, root: str) -> DataFrame:
    """(source_file, rows, committed_at, path, batch, months, indexed) of every completed load."""
    return ledger(spark, root).where("done").select("source_file", "rows", "committed_at", "path", "batch", "months", "indexed")


def pending(files: DataFrame, done: DataFrame, name_col: str = "name") -> DataFrame:
    """Files not yet committed (anti join on the file name)."""
    return files.join(done.select(F.col("source_file").alias(name_col)), name_col, "left_anti")


def _append_ledger(rows: DataFrame, root: str, batch: Column, months: Column, done: bool, indexed: bool) -> None:
    """Add ledger rows; ``rows``: source_file, path, rows."""
    (rows.coalesce(1).select("source_file", "path", "rows", batch.alias("batch"), months.cast("array<int>").alias("months"),
                 F.lit(done).alias("done"), F.lit(indexed).alias("indexed"), F.localtimestamp().alias("committed_at"))
     .write.mode("append").parquet(f"{root}/{LEDGER_DIR}"))


def _literals(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def commit_files(spark: SparkSession, root: str, files: dict[str, str], batch: str = "", months: Sequence[int] = (),
                 indexed: bool = False, names: DataFrame | None = None) -> None:
    """Append ledger rows for files (name: path) whose leaves are now written; ``names``: their ``name_list``."""
    if not files:
        return
    listed = spark.createDataFrame(sorted(files.items()), "source_file string, path string")
    counts = (rows_of_files(read_raw(spark, root), name_list(spark, files) if names is None else names)
              .groupBy("source_file").agg(F.count(F.lit(1)).alias("rows")))
    # every committed file gets a row, also one whose rows were all rejected
    rows = listed.join(counts, "source_file", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    _append_ledger(rows, root, F.lit(batch), _literals(months), True, indexed)


def mark_indexed(spark: SparkSession, root: str) -> None:
    """Ledger rows that say of every committed file that its rows are in the
    version index (an empty ledger for a table written without loads)."""
    if path_exists(spark, f"{root}/{LEDGER_DIR}"):
        rows = committed_files(spark, root).where("NOT coalesce(indexed, false)")
        _append_ledger(rows, root, F.col("batch"), F.col("months"), True, True)
    else:
        spark.createDataFrame([], LEDGER_SCHEMA).coalesce(1).write.parquet(f"{root}/{LEDGER_DIR}")


def _drop_leaves(spark: SparkSession, root: str, leaves: Sequence) -> None:
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for r in leaves:
        p = jvm.org.apache.hadoop.fs.Path(f"{root}/year_month={r.year_month}", escape("source_file", r.source_file))
        p.getFileSystem(conf).delete(p, True)


def _entries(spark: SparkSession, root: str, names: Sequence[str]) -> dict:
    """The newest ledger rows of the named files: name -> (path, done, months)."""
    if not names or not path_exists(spark, f"{root}/{LEDGER_DIR}"):
        return {}
    listed = spark.createDataFrame([(n,) for n in sorted(names)], "source_file string")
    rows = ledger(spark, root).join(F.broadcast(listed), "source_file", "left_semi").select("source_file", "path", "done", "months")
    return {r.source_file: r for r in rows.collect()}  # files of one load


def _begin_load(spark: SparkSession, root: str, files: dict[str, str], entries: dict, batch: str) -> list[int]:
    """Mark the files as begun and clear the leaves they have; returns the
    months to refresh besides their new rows'.

    Only files that an earlier load has begun (``entries``; or, without a
    ledger, all) can have leaves, so no other file's rows are looked for.
    The mark holds the months of all versions of the rides in these leaves,
    so a crash from here on costs a load and nothing else.
    """
    held, months = set(files), set()
    if path_exists(spark, f"{root}/{LEDGER_DIR}"):
        held = {n for n in files if n in entries}
        months = {m for n in held if not entries[n].done for m in entries[n].months or ()}
    leaves = []
    if held and path_exists(spark, root):
        rows = rows_of_files(read_raw(spark, root), name_list(spark, held))
        leaves = rows.select("year_month", "source_file").distinct().collect()  # these folders are deleted one by one
        if leaves and indexed(spark, root):
            months |= set(months_of_rides(spark, root, rows))
        elif leaves:
            ids = rows.select("ride_id").distinct()
            months |= {r[0] for r in read_raw(spark, root).join(ids, "ride_id", "left_semi").select("year_month").distinct().collect()}
    marks = spark.createDataFrame([(n, p, None) for n, p in sorted(files.items())], "source_file string, path string, rows long")
    _append_ledger(marks, root, F.lit(batch), _literals(sorted(months)), False, False)
    _drop_leaves(spark, root, leaves)
    return sorted(months)


def _broken_file(error: Exception, paths: Sequence[str]) -> str | None:
    """The file of ``paths`` that a failed job could not read, if one is named."""
    from ..sources.files import plain_path

    named = re.findall(r"FAILED_READ_FILE[^\]]*\] Encountered error while reading file (\S+?)\.?\s", str(error))
    named = {plain_path(form) for n in named for form in (n, unquote(n))}
    return next((p for p in paths if plain_path(p) in named), None)


def load_trip_files(spark: SparkSession, paths: Sequence[str], root: str, loaded_at: str | None = None,
                    skip_committed: bool = True, empty_as_missing: bool = False, landing: str | None = None,
                    multiline: bool = False) -> dict:
    """Clean-and-load CSV files, plain, gzipped or zipped, into the raw table, exactly once per file.

    Returns {"loaded": [names], "skipped": [names], "rejected": [paths],
    "reasons": {path: why}, "rows": {input_rows, dropped_malformed,
    dropped_missing, dropped_order, dropped_bounds, kept_rows}}; the row
    counts are observed while the load writes (no extra pass over the data).
    Unreadable files and files that lack a required column are rejected, the
    rest load; a file that breaks behind its header is rejected whole, and
    the load starts again without it (no leaf is written before all are
    read).  ``ValueError`` if two paths share a name, or a committed name
    comes from another path: give ``landing``, so that names are paths below
    it.
    """
    from pyspark.errors import PySparkException
    from pyspark.sql import Observation

    from ..sources.files import Rejected, plain_path, read_trip_files, source_id
    from .compact import recover
    from .clean import clean_strings, clean_types, drop_reason

    names: dict[str, str] = {}
    for p in paths:
        n = source_id(p, landing)
        if plain_path(names.setdefault(n, p)) != plain_path(p):
            raise ValueError(f"two files named {n!r}: {names[n]!r} and {p!r}")
    entries = _entries(spark, root, list(names))
    skipped: list[str] = []
    if skip_committed:
        skipped = sorted(n for n, e in entries.items() if e.done)
        for n in skipped:
            if entries[n].path != plain_path(names[n]):
                raise ValueError(f"file {n!r} was loaded from {entries[n].path!r}, not from {plain_path(names[n])!r}")
    todo = {n: p for n, p in sorted(names.items()) if n not in set(skipped)}
    rejected = Rejected()
    text = read_trip_files(spark, list(todo.values()), landing, multiline, rejected) if todo else None
    if text is None:
        return {"loaded": [], "skipped": skipped, "rejected": list(rejected), "reasons": dict(rejected), "rows": {}}
    loading = {n: plain_path(p) for n, p in todo.items() if p not in rejected}
    recover(spark, root)
    batch = uuid.uuid4().hex
    before = raw_months(spark, root)
    was_indexed = not before or indexed(spark, root)
    months = _begin_load(spark, root, loading, entries, batch)
    stamp = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at else F.localtimestamp()
    while True:
        typed = clean_types(clean_strings(text.withColumn("loaded_at", stamp)))
        reason = F.when(F.col("_malformed"), F.lit("malformed")).otherwise(drop_reason(typed, empty_as_missing))
        obs = Observation(f"load-{len(rejected)}")
        observed = typed.withColumn("_reason", reason).observe(
            obs, F.count(F.lit(1)).alias("input_rows"),
            *[F.count_if(F.col("_reason") == r).alias(f"dropped_{r}") for r in ("malformed", "missing", "order", "bounds")],
            F.count_if(F.col("_reason").isNull()).alias("kept_rows"))
        try:
            write_raw(observed.filter(F.col("_reason").isNull()), root)
            break
        except (PySparkException, Py4JJavaError) as e:
            bad = _broken_file(e, [p for n, p in todo.items() if n in loading])
            if bad is None:
                raise
            rejected[bad] = "unreadable behind its header"
            loading = {n: p for n, p in loading.items() if p != plain_path(bad)}
            text = read_trip_files(spark, [p for n, p in todo.items() if n in loading], landing, multiline, rejected) if loading else None
            if text is None:
                return {"loaded": [], "skipped": skipped, "rejected": list(rejected), "reasons": dict(rejected), "rows": {}}
    listed = name_list(spark, loading)
    if was_indexed:
        index_load(spark, root, listed, batch, before)
    commit_files(spark, root, loading, batch, months, was_indexed, listed)
    return {"loaded": sorted(loading), "skipped": skipped, "rejected": list(rejected), "reasons": dict(rejected), "rows": dict(obs.get)}


# --- marts ---------------------------------------------------------------------

def write_table(df: DataFrame, path: str, cluster_by: Sequence[str] = (), sort_by: Sequence[str] = (),
                partition_by: Sequence[str] = ()) -> None:
    """Full rebuild (overwrite).  ``cluster_by`` range-partitions on the
    given keys (one sampled shuffle) so files hold disjoint key ranges; give
    enough keys that no single value is a partition by itself (a hot date
    is split by the keys after it).  ``sort_by`` orders rows in each file."""
    out = df
    if cluster_by:
        out = out.repartitionByRange(*cluster_by)
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    w = out.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_keys(df: DataFrame, path: str, key: str) -> None:
    """Delete+insert by key for a table partitioned by ``key``: dynamic
    partition overwrite replaces exactly the keys present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy(key).parquet(path))


def drop_keys(spark: SparkSession, path: str, key: str, values: Sequence) -> None:
    """Remove partitions of ``key`` that no longer have rows (dynamic
    overwrite never deletes a partition it does not write)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/{key}={v}")
        p.getFileSystem(conf).delete(p, True)


def upsert_generic(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete+insert for keys that are not partition columns: target rows
    whose key appears in ``new`` are replaced (anti join + union).  The
    caller writes the result to a fresh path and swaps it in."""
    return target.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


# --- incremental row selection --------------------------------------------------

def _scalar(df: DataFrame, expr: Column):
    return df.agg(expr.alias("v")).first()["v"]


def incr_select(new: DataFrame, target: DataFrame | None, key: str, mode: str = "exact") -> DataFrame:
    """Rows of ``new`` to (re)compute given an existing ``target``.

    exact      every key except the target's current maximum (the newest key
               stays frozen); null-safe, so an empty target selects all rows
    watermark  keys >= the target maximum (misses late rows for older keys)
    First run (``target`` None) selects everything.
    """
    if target is None:
        return new
    m = _scalar(target, F.max(key))
    if mode == "exact":
        return new.filter(~F.col(key).eqNullSafe(F.lit(m)))
    if mode == "watermark":
        return new if m is None else new.filter(F.col(key) >= F.lit(m))
    raise ValueError(f"mode must be 'exact' or 'watermark', got {mode!r}")


def touched_keys(new_rows: DataFrame, all_rows: DataFrame, id_col: str, key_expr: Column,
                 prune_col: str | None = None) -> DataFrame:
    """Keys affected by ``new_rows``: their own keys plus the keys of earlier
    versions of the same ids (a corrected row can move between keys).

    Only rows with another key than the new rows' own are looked up, for the
    rest can add none.  The own keys are broadcast: they are dates or months,
    bounded by the calendar.  The id lookup is a semi join: AQE broadcasts
    the new ids when their measured size allows, else both sides shuffle on
    the id.  ``prune_col`` (e.g. ``year_month``) is the caller's assertion
    that earlier versions share that partition value with the new row: the
    lookup then reads only those partitions (dynamic partition pruning from
    the new rows' values).
    """
    own = new_rows.select(key_expr.alias("key")).distinct()
    on = [id_col] if prune_col is None else [id_col, prune_col]
    others = all_rows.select(*on, key_expr.alias("_key")).join(F.broadcast(own), F.col("_key").eqNullSafe(F.col("key")), "left_anti")
    earlier = others.join(new_rows.select(*on).distinct(), on, "left_semi")
    return own.unionByName(earlier.select(F.col("_key").alias("key"))).distinct()


def empty_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_SCHEMA)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the cluster file system (falls back to a
    metadata-only listing when the session has no JVM handle)."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        try:
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path) \
                .select("path").limit(1).collect()
            return True
        except Exception:
            return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ensure_raw_table(spark: SparkSession, root: str) -> DataFrame:
    """Create-if-absent: an empty raw table with the declared schema (and
    its partition columns) when ``root`` holds none; returns the table."""
    if not path_exists(spark, root):
        with_month(empty_raw(spark)).write.partitionBy(*RAW_PARTITIONS).parquet(root)
    return read_raw(spark, root)


def raw_table_schema():
    """Schema of the written raw table: data columns, then the partition columns."""
    from pyspark.sql import types as T
    data = [f for f in RAW_SCHEMA.fields if f.name not in RAW_PARTITIONS]
    return T.StructType(data + [T.StructField("year_month", T.IntegerType(), True),
                                T.StructField("source_file", T.StringType(), True)])
