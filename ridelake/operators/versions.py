"""Where the versions of a ride are, so that an increment reads only what it touches.

Two small tables lie beside the raw rows:

  <root>/_members/year_month=…/  Bloom filters of the month's ride ids, one set per load: bitmaps of
                                 2^15 bits, an id's probes all in one of them
  <root>/_moved/                 (ride_id, year_month) of every ride with versions in several months

A load asks the filters which months may hold its rides already, reads only
those months to be sure, and adds the rides found in several months to the
moved ones.  From then on the months of a ride's versions are known without
the raw rows: its own, or those of its moved rows.  Filters only ever say
"maybe" too often (a false month costs a read, never a result), so entries
of rows that a reload removed may stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

MONTH = "year_month"
MEMBERS_DIR, MOVED_DIR = "_members", "_moved"
BLOCK_BITS = 1 << 15  # of one bitmap: fixed by Spark's bitmap functions
BITS_PER_ID, PROBES = 32, 12  # about one false month in a million ids
MAX_SETS = 8  # filter sets of a month before they are made one
TASK_BLOCKS, FILE_BLOCKS = 64, 512  # bitmaps made at a time, and by a task

MEMBERS_SCHEMA = "batch string, blocks int, block int, bitmap binary, year_month int"
MOVED_SCHEMA = "ride_id string, year_month int"


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def name_list(spark: SparkSession, names) -> DataFrame:
    """File names as a small stored table (``source_file``), for ``rows_of_files``."""
    return _kept(spark.createDataFrame([(n,) for n in sorted(names)], "source_file string").coalesce(1), "names")


def rows_of_files(raw: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of the given files.  The list is a batch's file names; it is
    broadcast and prunes the raw table's partitions to these files (the range
    condition makes the pruning apply: no name is empty)."""
    return raw.join(F.broadcast(files.where("source_file > ''").select("source_file")), "source_file", "left_semi")


def _months(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in df.select(MONTH).distinct().collect())  # bounded by the calendar


def raw_months(spark: SparkSession, root: str) -> list[int]:
    """Months that the raw table (or another table by month) has folders for."""
    from .sinks import path_exists, read_raw
    if not path_exists(spark, root):
        return []
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return _months(read_filters(spark, root[:-len(MEMBERS_DIR) - 1]) if root.endswith(MEMBERS_DIR) else read_raw(spark, root))
    path = jvm.org.apache.hadoop.fs.Path(root)
    names = [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{MONTH}=") and n.split("=")[1].isdigit())


# --- filters ----------------------------------------------------------------

def _block(blocks) -> Column:
    return F.pmod(F.xxhash64("ride_id", F.lit("block")), blocks).cast("int")


def _probe(i: int) -> Column:
    return F.pmod(F.xxhash64("ride_id", F.lit(i)), F.lit(BLOCK_BITS))


def _blocks_for(n: int) -> int:
    """Bitmaps for ``n`` ids: a power of two, so that few sizes occur."""
    return 1 << max(-(-n * BITS_PER_ID // BLOCK_BITS) - 1, 0).bit_length()


def filter_rows(ids: DataFrame, counts: dict[int, int], batch: str) -> DataFrame:
    """A filter set of distinct (ride_id, year_month) rows; ``counts``: ids per month.

    The ids go to the task that makes their bitmap, so that what is shuffled
    follows the ids (bitmaps made by every task would be shuffled as often as
    there are tasks), and few bitmaps at a time keep the sort behind it small.
    A bitmap per probe spares a row per id and probe in that sort.
    """
    sizes = {m: _blocks_for(n) for m, n in sorted(counts.items())}
    blocks = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col(MONTH)]
    placed = ids.select(MONTH, blocks.alias("blocks"), "ride_id").withColumn("block", _block(F.col("blocks")))
    placed = placed.repartition(-(-sum(sizes.values()) // TASK_BLOCKS), MONTH, "blocks", "block")
    keys = [MONTH, "blocks", "block"]
    by_probe = placed.groupBy(*keys).agg(*[F.bitmap_construct_agg(_probe(i)).alias(f"bits{i}") for i in range(PROBES)])
    bitmaps = by_probe.select(*keys, F.explode(F.array(*[f"bits{i}" for i in range(PROBES)])).alias("bits"))
    sets = bitmaps.groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bitmap"))
    return sets.coalesce(-(-sum(sizes.values()) // FILE_BLOCKS)).select(F.lit(batch).alias("batch"), "blocks", "block", "bitmap", MONTH)


def _write_filters(sets: DataFrame, root: str, mode: str) -> None:
    (sets.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(MONTH).parquet(f"{root}/{MEMBERS_DIR}"))


def may_hold(ids: DataFrame, sets: DataFrame, sizes: list[int], besides: bool = False) -> DataFrame:
    """Distinct (ride_id, year_month) where the month's filters do not exclude
    the id; ``sizes``: the numbers of blocks that occur in ``sets``; ``besides``:
    months that ``ids`` has for the id are not asked about."""
    if besides:
        probes, hit = ids.groupBy("ride_id").agg(F.collect_set(MONTH).alias("known")), ~F.array_contains("known", F.col(MONTH))
    else:
        probes, hit = ids.select("ride_id").distinct(), F.lit(True)
    probes = probes.withColumn("blocks", F.explode(F.array(*[F.lit(s) for s in sizes])))
    probes = probes.withColumn("block", _block(F.col("blocks")))
    for i in range(PROBES):
        bit = _probe(i)
        byte = F.conv(F.hex(F.substr("bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = hit & (F.getbit(byte, (bit % 8).cast("int")) == 1)
    return probes.join(sets, ["blocks", "block"]).where(hit).select("ride_id", MONTH).distinct()


def read_filters(spark: SparkSession, root: str) -> DataFrame:
    from .sinks import path_exists
    path = f"{root}/{MEMBERS_DIR}"
    return spark.read.schema(MEMBERS_SCHEMA).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], MEMBERS_SCHEMA)


def filter_sets(sets: DataFrame) -> list:
    """(year_month, blocks, batch) of the filters: at most ``MAX_SETS`` + 1 per month."""
    return sets.select(MONTH, "blocks", "batch").distinct().collect()


def read_moved(spark: SparkSession, root: str) -> DataFrame:
    from .sinks import path_exists
    path = f"{root}/{MOVED_DIR}"
    return spark.read.schema(MOVED_SCHEMA).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], MOVED_SCHEMA)


# --- kept up by loads ---------------------------------------------------------

def _ids(rows: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    from pyspark.sql import Observation

    obs = Observation("ids")
    months = F.collect_set(MONTH)  # bounded by the calendar
    ids = _kept(rows.select("ride_id", MONTH).distinct().observe(obs, F.count(F.lit(1)).alias("n"), months.alias("months")), "ids")
    found = obs.get["months"] or []
    if len(found) < 2:
        return ids, {m: obs.get["n"] for m in found}
    return ids, {r[0]: r["count"] for r in ids.groupBy(MONTH).count().collect()}


def _several_months(pairs: DataFrame) -> DataFrame:
    months = pairs.groupBy("ride_id").agg(F.collect_set(MONTH).alias("months"))  # bounded by the calendar
    return months.where(F.size("months") > 1).select("ride_id", F.explode("months").alias(MONTH))


def index_load(spark: SparkSession, root: str, files: DataFrame, batch: str, before: list[int]) -> None:
    """Enter the rows of ``files``, just written; ``before``: the months the table had until then.

    A month of ``before`` without filters (an interrupted load left it) may
    hold any ride, so it is read.  Running it twice for one load is harmless.
    """
    from .sinks import read_raw
    ids, counts = _ids(rows_of_files(read_raw(spark, root), files))
    if not counts:
        return
    sets = read_filters(spark, root)
    present = filter_sets(sets)
    old = [r for r in present if r[MONTH] in before]
    maybe = None
    asked = set(before) - (set(counts) if len(counts) == 1 else set())  # the only month of all ids is known
    if sizes := sorted({r.blocks for r in old if r[MONTH] in asked}):
        maybe = may_hold(ids, sets.where(F.col(MONTH).isin(sorted(asked))), sizes, besides=True)
    if unknown := sorted(asked - {r[MONTH] for r in old}):
        every = ids.select("ride_id").distinct().select("ride_id", F.explode(F.array(*[F.lit(m) for m in unknown])).alias(MONTH))
        maybe = maybe.unionByName(every) if maybe is not None else every
    pairs, months = ids, []
    if maybe is not None:
        maybe = _kept(maybe.join(ids, ["ride_id", MONTH], "left_anti"), "maybe")
        months = _months(maybe)
    if months:
        found = read_raw(spark, root, months).join(maybe, ["ride_id", MONTH], "left_semi")
        pairs = pairs.unionByName(found.select("ride_id", MONTH).distinct())
    if len({*counts, *months}) > 1:
        _several_months(pairs).write.mode("append").parquet(f"{root}/{MOVED_DIR}")
    _write_filters(filter_rows(ids, counts, batch), root, "append")
    batches = {m: {batch} for m in counts}
    for r in present:
        batches.setdefault(r[MONTH], set()).add(r.batch)
    if full := sorted(m for m, some in batches.items() if len(some) > MAX_SETS):
        ids, counts = _ids(read_raw(spark, root, full))
        _write_filters(filter_rows(ids, counts, batch), root, "overwrite")


def index_table(spark: SparkSession, root: str) -> None:
    """Make filters and moved rides from the whole raw table, for one not written by loads alone."""
    from .sinks import mark_indexed, read_raw
    ids, counts = _ids(read_raw(spark, root))
    if counts:
        filter_rows(ids, counts, uuid.uuid4().hex).write.mode("overwrite").partitionBy(MONTH).parquet(f"{root}/{MEMBERS_DIR}")
        _several_months(ids).write.mode("overwrite").parquet(f"{root}/{MOVED_DIR}")
    mark_indexed(spark, root)


def indexed(spark: SparkSession, root: str) -> bool:
    """Whether filters and moved rides cover the raw table: every committed
    load entered its rows, and every month has filters."""
    from .sinks import LEDGER_DIR, committed_files, path_exists
    if not path_exists(spark, f"{root}/{LEDGER_DIR}"):
        return False
    if committed_files(spark, root).where("NOT coalesce(indexed, false)").limit(1).count():
        return False
    return set(raw_months(spark, root)) <= set(raw_months(spark, f"{root}/{MEMBERS_DIR}"))


# --- asked by builds ----------------------------------------------------------

def months_of_rides(spark: SparkSession, root: str, rows: DataFrame) -> list[int]:
    """Months with a version of one of the rides in ``rows`` (raw rows), theirs included."""
    moved = read_moved(spark, root).join(rows.select("ride_id").distinct(), "ride_id", "left_semi")
    return sorted({*_months(rows), *_months(moved)})


def versions_in_months(spark: SparkSession, root: str, months: list[int]) -> DataFrame:
    """All versions of every ride with a version in one of ``months``: those
    months, and from the others only the rides that moved."""
    from .sinks import read_raw
    inside = F.col(MONTH).isin(list(months))
    moved = read_moved(spark, root)
    away = moved.where(~inside).join(moved.where(inside).select("ride_id").distinct(), "ride_id", "left_semi")
    rows = read_raw(spark, root, months)
    if others := _months(away):
        rows = rows.unionByName(read_raw(spark, root, others).join(away.select("ride_id").distinct(), "ride_id", "left_semi"))
    return rows
