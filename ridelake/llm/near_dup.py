"""Near-duplicate groups by MinHash bands, odd sketches and exact confirmation.

Each text becomes its set of 5-word shingles (64-bit hashes), a MinHash
signature, band keys, and an odd sketch: every (position, minimum) sample
flips one bit of a bitmap, so that the population count of the XOR of two
bitmaps estimates how many samples differ, precisely so for similar sets.

1. Equal sets form a class; one row stands for it from here on.
2. Rows that share a band key are tied to the smallest id of their bucket;
   sketches of these pairs are compared, the rest is confirmed on full sets.
   This takes one pair per row and band, whatever the bucket sizes.
3. Buckets whose rows are not all connected by then form groups.  Groups are
   cut into blocks; for every pair of blocks the sketches of rows not yet
   connected are compared, the likely pairs are confirmed on full sets, and
   a link is returned only where it connects something new.
4. Components of the links give the duplicate groups.

No bucket is capped.  A pair of similarity 0.85 misses all 40 bands of 7
rows with probability 2e-7.  Links use 100 * |A and B| >= 85 * |A or B|.

Edge cases: a NULL, empty or blank text has no shingles and is linked with
nothing; fewer than five words form one shingle; rows without an id are
linked with nothing, keep a NULL component and are kept; rows of one id are
one document, linked through any of its texts; an empty table gives an empty
result; extra columns pass through, clashing ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import apart, small_batches, stored, strings, table

SHINGLE = 5
BANDS, ROWS = 40, 7
BITS = 512
LEAST = 85  # per cent
SURE = 0.72  # sketch estimates below this are never 0.85 (more than six standard deviations)
BLOCK = 512
PIECE = 1 << 20

_RNG = np.random.default_rng(20240101)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_MUL = _RNG.integers(1, 2**32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_MIX = _RNG.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_IS_WS = np.zeros(256, bool)
_IS_WS[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_piece(raw: bytes) -> np.ndarray:
    codes = np.frombuffer(raw, np.uint8)
    flag = np.empty(len(codes) + 2, np.int8)
    flag[0] = flag[-1] = 1
    flag[1:-1] = _IS_WS[codes]
    edge = np.flatnonzero(flag[1:] != flag[:-1])
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    pos = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    total = np.add.reduceat(_BYTE[codes[pos + np.repeat(starts, lengths)]] * powers[pos], first)
    return _mix(total + lengths.astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each white-space separated word, A-Z in lower case."""
    raw = text.encode("utf-8", "surrogatepass").lower()  # bytes: only A-Z change
    if len(raw) <= PIECE:
        return _hash_piece(raw)
    out, at = [], 0
    while at < len(raw):  # bounded work space for very long texts, cut between words
        end = min(at + PIECE, len(raw))
        while end < len(raw) and not _IS_WS[raw[end]]:
            end += 1
        out.append(_hash_piece(raw[at:end]))
        at = end
    return np.concatenate(out)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    w = word_hashes(text or "")
    if not len(w):
        return w
    k = min(SHINGLE, len(w))
    total = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        total += _mix(w[i:len(w) - k + 1 + i] * _MIX[i])
    return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    for at in range(0, len(x), 256):
        np.minimum(best, (np.multiply.outer(_MUL, x[at:at + 256]) + _ADD[:, None]).min(axis=1), out=best)
    return best


_SAMPLE = _mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
_BAND = _mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(7919))


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = _mix(sig.astype(np.uint64).reshape(BANDS, ROWS) * _MIX[:ROWS])
    return _mix((rows * _MIX[ROWS:2 * ROWS]).sum(axis=1, dtype=np.uint64) ^ _BAND).view(np.int64)


def odd_sketch(sig: np.ndarray) -> bytes:
    at = (_mix(_SAMPLE ^ _mix(sig.astype(np.uint64))) % np.uint64(BITS)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=BITS) & 1).tobytes()


def similarity(differing_bits):
    """Similarity of two sets whose odd sketches differ in so many bits."""
    share = np.minimum(np.asarray(differing_bits) / BITS, 0.499)
    return 1 + BITS / (4 * BANDS * ROWS) * np.log1p(-2 * share)


# pairs of sketches that differ in more bits are below SURE
MOST_BITS = int(BITS / 2 * (1 - np.exp((SURE - 1) * 4 * BANDS * ROWS / BITS)))

SIGNED = T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("class", T.BinaryType()),
                       T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])


@F.pandas_udf(SIGNED)
def _sign(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    import hashlib

    for batch in texts:
        rows = []
        for text in strings(batch):
            s = shingle_set(text)
            if len(s):
                sig = signature(s)
                rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), band_keys(sig), odd_sketch(sig)))
            else:
                rows.append((0, None, None, None))
        yield pd.DataFrame(rows, columns=["n_shingles", "class", "bands", "sketch"])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _sets(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([shingle_set(t).view(np.int64) for t in strings(batch)])


@F.pandas_udf(T.BooleanType())
def _linked(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([confirmed(x, y) for x, y in zip(a, b)], dtype=bool)


def confirmed(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= LEAST * (len(a) + len(b) - both)


def _sizes_fit(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= LEAST * F.greatest(a, b)


def differing_bits(a: Column, b: Column) -> Column:
    """Population count of the XOR of two sketches, by 8-byte words."""
    def word(c, i):
        return F.conv(F.hex(F.substring(c, 8 * i + 1, 8)), 16, -10).cast("long")
    return sum((F.bit_count(word(a, i).bitwiseXOR(word(b, i))) for i in range(BITS // 64)), F.lit(0))


def components(edges: DataFrame, u: str = "a", v: str = "b") -> DataFrame:
    """(node, component): smallest node reachable, for the nodes of ``edges``.

    Alternates between tying larger neighbours and tying smaller neighbours
    to the smallest one.  Each round is written to shared storage; a hub's
    edges are joined with its minimum, never collected.
    """
    def tie(e: DataFrame, larger: bool) -> DataFrame:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not larger:
            both = both.where("v < u")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.join(low, "u")
        if larger:
            out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def mark(e):
        row = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return row.n, row.h

    e = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct()
    e = stored(e, "near-edges")
    last = None
    while (now := mark(e)) != last:
        last = now
        e = stored(tie(tie(e, True), False), "near-edges")
    return e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _labelled(rows: DataFrame, parts: DataFrame, node: str) -> DataFrame:
    """Add ``part``, the component of column ``node`` (itself if it has no link)."""
    parts = parts.select(F.col("node").alias("_n"), F.col("component").alias("_p"))
    out = rows.join(parts, rows[node] == F.col("_n"), "left")
    return out.withColumn("part", F.coalesce("_p", F.col(node))).drop("_n", "_p")


BLOCK_LINKS = "a long, b long"


def _link_blocks(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links that connect rows of two blocks, or of one, not connected yet."""
    left, right = int(key[1]), int(key[2])
    rows = rows.sort_values(["block", "rep"], kind="stable")
    sets, n = list(rows["set"]), rows["n_shingles"].to_numpy()
    reps, block = rows["rep"].to_numpy(), rows["block"].to_numpy()
    sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint64).reshape(len(rows), -1)
    _, root = np.unique(rows["part"].to_numpy(), return_inverse=True)
    root = root.copy()
    out = []
    for i in range(len(rows)):
        if block[i] != left:
            break
        from_ = i + 1 if left == right else int(np.searchsorted(block, right))
        js = np.arange(from_, len(rows))
        js = js[(root[js] != root[i]) & (100 * np.minimum(n[js], n[i]) >= LEAST * np.maximum(n[js], n[i]))]
        if not len(js):
            continue
        bits = np.bitwise_count(sketches[js] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        near = np.flatnonzero(bits <= MOST_BITS)
        for j in js[near[np.argsort(bits[near], kind="stable")]]:
            if root[j] != root[i] and confirmed(sets[i], sets[j]):
                root[root == root[j]] = root[i]
                out.append((reps[i], reps[j]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def links(signed: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed links (a, b) between representatives, enough to connect all that are linked.

    ``signed``: doc_id, n_shingles, class, bands, sketch; ``classes``: class,
    rep; ``docs``: doc_id, text.
    """
    members = signed.select("doc_id", "class", "n_shingles", "bands", "sketch")
    reps = stored(members.join(classes, (members["class"] == classes["class"]) & (members["doc_id"] == classes["rep"]))
                  .select("rep", "n_shingles", members["class"], "bands", "sketch").dropDuplicates(["rep", "class"]), "near-reps")

    # buckets of two rows or more, each tied to its smallest id
    banded = reps.select("rep", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    banded = stored(banded.join(buckets.select("bucket", "low"), "bucket"), "near-buckets")
    pairs = banded.where("rep <> low").select(F.col("rep").alias("b"), F.col("low").alias("a")).distinct()

    slim = reps.select("rep", "n_shingles", "sketch")
    one = slim.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    two = slim.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    pairs = pairs.join(two, "b").join(one, "a")
    pairs = pairs.where(_sizes_fit(F.col("na"), F.col("nb")) & (differing_bits(F.col("sa"), F.col("sb")) <= MOST_BITS))
    pairs = stored(pairs.select("a", "b").distinct(), "near-pairs")

    # the sets of rows that share a bucket with another, computed once
    wanted = banded.select("rep").distinct()
    sets = docs.join(wanted, docs["doc_id"] == wanted["rep"], "left_semi").select(F.col("doc_id").alias("rep"), _sets("text").alias("set"))
    sets = stored(sets, "near-sets")
    sa, sb = (sets.select(F.col("rep").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
    first = stored(pairs.join(sb, "b").join(sa, "a").where(_linked("set_a", "set_b")).select("a", "b").distinct(), "near-links")

    # buckets that are not connected yet
    parts = stored(components(first), "near-parts")
    banded = stored(_labelled(banded, parts, "rep"), "near-mixed")
    mixed = banded.groupBy("bucket").agg(F.min("part").alias("p0"), F.max("part").alias("p1")).where("p0 < p1")
    ties = banded.join(mixed.select("bucket"), "bucket").select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct()
    groups = stored(components(ties), "near-groups")
    sized = groups.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    blocks = (F.col("members") / BLOCK).cast("long") + 1
    rows = groups.join(sized, "component").withColumn("blocks", blocks)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = _labelled(rows, parts, "node").withColumnRenamed("node", "rep").join(sets, "rep")
    full = rows.join(slim.select("rep", F.col("n_shingles"), F.col("sketch")), "rep").where(F.size("set") == F.col("n_shingles"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    full = full.withColumn("other", other).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    full = full.select("component", "i", "j", "block", "rep", "part", "n_shingles", "sketch", "set")
    second = full.groupBy("component", "i", "j").applyInPandas(_link_blocks, BLOCK_LINKS)
    return first.unionByName(stored(second, "near-links"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    small_batches(docs.sparkSession)
    signed = docs.select("doc_id", _sign("text").alias("s")).select("doc_id", "s.*")
    signed = stored(signed, "near-signed")
    alive = signed.where("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "class")
    # a table of its own: joins with it can split a class of very many copies
    classes = stored(alive.groupBy("class").agg(F.min("doc_id").alias("rep")), "near-classes")
    found = links(signed, classes, docs.select("doc_id", "text"))
    # an id with texts of several classes ties them together
    ids = alive.join(classes, "class").groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("far"))
    ids = stored(ids, "near-ids")
    ties = ids.where("rep <> far").select(F.col("rep").alias("a"), F.col("far").alias("b"))
    many = alive.join(ids.where("rep <> far").select("doc_id"), "doc_id").join(classes, "class")
    ties = ties.unionByName(many.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    ids = _labelled(ids.select("doc_id", "rep"), components(found.unionByName(ties)), "rep")
    ids = ids.select(F.col("doc_id").alias("_d"), F.col("part").alias("component_id"))
    out = signed.select("doc_id", "n_shingles").join(ids, F.col("doc_id") == F.col("_d"), "left").drop("_d")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


@apart("doc_id", "text")
def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document stands for its group; one row per id."""
    dropped = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_d")).distinct()
    return docs.join(dropped, docs["doc_id"] == F.col("_d"), "left_anti")


def op10_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
r AS (SELECT a AS doc_id, a AS m FROM l UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.doc_id),
k AS (SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
       coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN k ON k.doc_id = w.doc_id
"""
