"""Sharding through fixed virtual slots.

Every record hashes into one of ``slots`` virtual slots.  Bytes are summed
per slot, and a small stored table maps slots to shards.  The map is
versioned: version 1 deals the slots evenly; a rebalance reads the latest
version, moves as few slots as it needs, and stores the next one.  Records
move only when their slot does.  The law held is ``bytes``: shard sizes are
near equal.

Edge cases: a NULL or empty text weighs 1; NULL ids and repeated rows hash
like any other value; an empty table gives an empty result (all slots still
mapped); extra columns pass through ``assign`` (the added columns are
``virtual_slot``, ``shard`` and ``map_version``, replacing any of that name).
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import apart, stored, table

SLOTS = 4096
CELLS = 32  # parts of a slot in which rows are numbered
SHARDS = 16
SLACK = 0.01  # a shard may differ from the mean by so much before slots move
CLOSE = 0.0005  # the same for a map made and edited in one run


def size_of(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def slot_of(keys: list[Column], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def slot_sizes(sized: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, rows): at most one row per slot."""
    return sized.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def place(sizes: dict[int, int], shards: int, slots: int = SLOTS) -> list[int]:
    """First map: the largest slot goes to the lightest shard so far."""
    heap = [(0, 0, s) for s in range(shards)]
    out = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, n, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + sizes.get(slot, 0), n + 1, shard))
    return out


def rebalance(old: list[int], sizes: dict[int, int], shards: int, slack: float = SLACK) -> list[int]:
    """Edit a map: move slots off the heaviest shard while that narrows the gap.

    Stops when every shard is within ``slack`` of the mean or no single move
    helps.  Slots of shards that no longer exist are placed first.
    """
    out = list(old)
    load, held = [0] * shards, [[] for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(out):
        if shard < shards:
            load[shard] += sizes.get(slot, 0)
            held[shard].append(slot)
        else:
            homeless.append(slot)

    def put(slot, shard):
        out[slot] = shard
        load[shard] += sizes.get(slot, 0)
        held[shard].append(slot)

    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        put(slot, min(range(shards), key=lambda s: (load[s], s)))
    mean = sum(load) / shards
    while True:
        top = max(range(shards), key=lambda s: (load[s], -s))
        low = min(range(shards), key=lambda s: (load[s], s))
        gap = load[top] - load[low]
        if load[top] <= mean * (1 + slack) and load[low] >= mean * (1 - slack):
            return out
        moves = [s for s in held[top] if 0 < sizes.get(s, 0) < gap]
        if not moves:
            return out
        slot = min(moves, key=lambda s: (abs(gap / 2 - sizes[s]), s))
        held[top].remove(slot)
        load[top] -= sizes[slot]
        put(slot, low)


def map_table(spark: SparkSession, shard_of: list[int], version: int) -> DataFrame:
    listed = F.split(F.lit(",".join(map(str, shard_of))), ",")
    return spark.range(len(shard_of)).select(
        F.col("id").cast("int").alias("virtual_slot"),
        F.get(listed, F.col("id").cast("int")).cast("int").alias("shard"), F.lit(version).alias("map_version"))


def store_map(slot_map: DataFrame, path: str) -> None:
    """Add one version to the stored map; older versions stay readable."""
    slot_map.write.mode("append").partitionBy("map_version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the latest by default."""
    maps = spark.read.parquet(path)
    if version is None:
        version = maps.agg(F.max("map_version")).first()[0]
    return maps.where(F.col("map_version") == version).select("virtual_slot", "shard", "map_version")


def slot_list(slot_map: DataFrame) -> list[int]:
    """The map as a list by slot: as long as the slot count, a parameter."""
    return [r.shard for r in slot_map.orderBy("virtual_slot").select("shard").collect()]


def build_map(sized: DataFrame, shards: int = SHARDS, slots: int = SLOTS, previous: DataFrame | None = None,
              slack: float = SLACK) -> DataFrame:
    """The next map version for rows with ``virtual_slot`` and ``size``.

    Only the per-slot totals (``slots`` rows) reach the driver.
    """
    sizes = {r.virtual_slot: int(r.bytes) for r in slot_sizes(sized).collect()}
    if previous is None:
        return map_table(sized.sparkSession, place(sizes, shards, slots), 1)
    version = previous.first().map_version + 1
    return map_table(sized.sparkSession, rebalance(slot_list(previous), sizes, shards, slack), version)


def apply_map(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add shard and map_version; the map has one row per slot, so it is broadcast."""
    return rows.drop("shard", "map_version").join(F.broadcast(slot_map), "virtual_slot")


@apart("doc_id", "text")
def assign(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, previous: DataFrame | None = None,
           path: str | None = None) -> DataFrame:
    """``docs`` with virtual_slot, shard and map_version; no shuffle of the documents.

    The map is the stored one at ``path`` (a fresh folder by default), edited
    for these rows and stored again, or the next version of ``previous``.

    The record hash takes the id and the text, so rows that share one id, or
    have none, still spread over the slots.
    """
    slotted = docs.withColumn("virtual_slot", slot_of([F.col("doc_id"), F.col("text")], slots))
    sized = slotted.select("virtual_slot", size_of(F.col("text")).alias("size"))
    if previous is not None:
        return apply_map(slotted, build_map(sized, shards, slots, previous))
    path = path or scratch_dir(docs.sparkSession, "slot-map")
    return apply_map(slotted, keep_map(sized, path, shards, slots, CLOSE))


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Number rows 0, 1, 2 ... within each shard, as column ``slot``.

    ``rows``: ``keys``, virtual_slot, shard, map_version.  Each virtual slot
    is cut into cells by hash; per-cell counts (at most slots x cells rows)
    are prefix-summed per shard and equal rows are counted before they are
    numbered, so no task holds a shard or a repeated row.
    """
    cell = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(7)), F.lit(CELLS)).cast("int")
    at = ["shard", "virtual_slot", "cell"]
    counted = rows.withColumn("cell", cell).groupBy(*keys, *at, "map_version").agg(F.count(F.lit(1)).alias("n"))
    counted = stored(counted, "shard-rows")
    before = Window.partitionBy("shard").orderBy("virtual_slot", "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = counted.groupBy(*at).agg(F.sum("n").alias("cell_n"))
    cells = cells.select("virtual_slot", "cell", F.coalesce(F.sum("cell_n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("virtual_slot", "cell").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0)))
    placed = placed.join(cells, ["virtual_slot", "cell"])
    at0 = F.col("start") + F.col("first")
    return placed.withColumn("slot", F.explode(F.sequence(at0, at0 + F.col("n") - 1))).drop("n", "cell", "start", "first")


def keep_map(sized: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS, slack: float = SLACK) -> DataFrame:
    """The stored map at ``path``, edited for rows with ``virtual_slot`` and ``size``.

    Where none is stored, one is first: slots dealt to shards evenly, in
    turn, as for rows not yet seen.  The latest version is read, rebalanced
    against the totals of the slots (only as many slots move as the slack
    asks for) and stored as the next one, unless no slot moves.
    """
    spark = sized.sparkSession
    if not _stored_map(spark, path):
        store_map(map_table(spark, [s % shards for s in range(slots)], 1), path)
    previous = load_map(spark, path)
    edited = build_map(sized, shards, slots, previous, slack)
    if slot_list(edited) != slot_list(previous):
        store_map(edited, path)
    return load_map(spark, path)


def _stored_map(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException
    try:
        return "map_version" in spark.read.parquet(path).columns
    except AnalysisException:  # no such folder yet
        return False


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    rows = docs.select(
        "doc_id", size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        slot_of([F.col("doc_id"), text]).alias("virtual_slot"))
    rows = stored(rows, "shard-digest")
    slot_map = keep_map(rows, scratch_dir(spark, "slot-map"), slack=CLOSE)
    out = numbered(apply_map(rows, slot_map), ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
