"""Exact top-k inner products over a bit-sliced index.

Vectors become integers, component by component: floor(256 * x).  The
candidates of a slot form a bit-sliced index: bitmap j of a component holds
bit j of that (quantised) component for every row.  A query's approximate
scores are a sum of such slices, made for all rows of the slot at once by
bitmap adders; sums over subsets of eight components are made once per slot
and shared by all queries.  The k largest sums are selected from the most
significant slice downward, as are all rows whose sum may lie above the
k-th within the proven error of the quantisation.  Only those boundary rows
are scored exactly, from the whole integers.

Queries and candidates are dealt by hash into cells and slots of bounded
size; every (slot, cell) pair is one group, so a task holds one slot and one
cell whatever the data, and the k best of each slot are merged by Spark.
No row is left out: the bounds only decide which rows need exact scores.

Edge cases: a vector that is NULL or holds a NULL, NaN or infinite component
takes no part; shorter vectors count as padded with zeros, an empty one
scores 0; a repeated row is a candidate, and a query, of its own; equal
scores go to the smaller id, a NULL id last; a row without id is never a
query; scores are longs (sums beyond 63 bits wrap); an empty table, or one
without queries, gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

K = 5
SCALE = 256
EVERY = 50  # ids divisible by this are queries
SLOT_ROWS = 8192  # candidates of a group, about
CELL_QUERIES = 8192  # queries of a group, about
SLICES = 7  # significant bits kept of a component
GROUP = 8  # components of a subset table
WORDS = 8192  # bitmap words of a batch of queries

ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---- bitmap arithmetic: a number per row is a list of slices, least significant first

def add(a: list, b: list) -> list:
    """The slices of the sum of two sliced numbers."""
    if len(a) < len(b):
        a, b = b, a
    out, carry = [], None
    for j, x in enumerate(a):
        if j < len(b):
            half = x ^ b[j]
            both = x & b[j]
            out.append(half if carry is None else half ^ carry)
            carry = both if carry is None else both | (half & carry)
        elif carry is None:
            out.append(x)
        else:
            out.append(x ^ carry)
            carry = x & carry
    if carry is not None:
        out.append(carry)
    return out


def sliced(values: np.ndarray) -> np.ndarray:
    """Bitmaps (component, bit, word) of the columns of a matrix of numbers from 0 up."""
    rows, dims = values.shape
    bits = max(int(values.max(initial=0)).bit_length(), 1)
    words = -(-rows // 64)
    out = np.zeros((dims, bits, words * 8), np.uint8)
    for j in range(bits):
        packed = np.packbits(((values >> j) & 1).astype(np.uint8).T, axis=1, bitorder="little")
        out[:, j, :packed.shape[1]] = packed
    return out.view("<u8")


def subset_sums(slices: np.ndarray) -> np.ndarray:
    """Sliced sums (bit, subset, word) of every subset of a few components."""
    dims, bits, words = slices.shape
    width = bits + max(dims - 1, 0).bit_length()
    out = np.zeros((width, 1 << dims, words), np.uint64)
    for d in range(dims):
        n = 1 << d
        total = add(list(out[:, :n]), [s[None, :] for s in slices[d]])
        for j, s in enumerate(total[:width]):
            out[j, n:2 * n] = s
    return out


def select_from_top(sums: list, valid: np.ndarray, k: int) -> np.ndarray:
    """Per query, the k-th largest sum, found from the most significant slice downward (0: fewer rows)."""
    left = np.broadcast_to(valid, sums[0].shape)
    above = np.zeros(len(sums[0]), np.int64)
    value = np.zeros(len(sums[0]), np.int64)
    for j in range(len(sums) - 1, -1, -1):
        hit = left & sums[j]
        n = above + np.bitwise_count(hit).sum(axis=1, dtype=np.int64)
        take = n >= k
        left = np.where(take[:, None], hit, left & ~sums[j])
        above = np.where(take, above, n)
        value |= take.astype(np.int64) << j
    return value


def at_least(sums: list, valid: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Bitmaps of the rows whose sum is at least the query's limit."""
    equal = np.broadcast_to(valid, sums[0].shape)
    more = np.zeros(sums[0].shape, np.uint64)
    for j in range(len(sums) - 1, -1, -1):
        bit = np.where((limit >> j) & 1, ONES, np.uint64(0))[:, None]
        more = more | (equal & sums[j] & ~bit)
        equal = equal & ~(sums[j] ^ bit)
    return more | equal


class Slot:
    """The bit-sliced index of one slot's candidates."""

    def __init__(self, rows: np.ndarray, slices: int = SLICES):
        self.rows = rows
        n, dims = rows.shape
        self.low = int(rows.min(initial=0))
        span = int(rows.max(initial=0)) - self.low
        self.slices = slices
        self.shift = max(span.bit_length() - slices, 0)
        kept = (rows - self.low) >> self.shift
        rest = (rows - self.low) - (kept << self.shift) - self.middle(self.shift)
        self.rest_norm = float(np.sqrt((rest.astype(np.float64) ** 2).sum(axis=1)).max(initial=0))
        self.norm = float(np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1)).max(initial=0))
        index = sliced(kept)
        self.valid = sliced(np.ones((n, 1), np.int64))[0, 0]
        self.sums = [subset_sums(index[d:d + GROUP]) for d in range(0, dims, GROUP)]

    @staticmethod
    def middle(shift: int) -> float:
        return ((1 << shift) - 1) / 2

    def scores(self, queries: np.ndarray) -> tuple[list, np.ndarray]:
        """Sliced approximate scores, and per query the slack 2E in their unit."""
        size = max(int(np.abs(queries).max(initial=0)), 1)
        shift = max(size.bit_length() - self.slices, 0)
        coarse = (queries + ((1 << shift) >> 1)) >> shift
        rest = np.sqrt(((queries - (coarse << shift)).astype(np.float64) ** 2).sum(axis=1)) * self.norm
        scaled = np.abs(coarse << shift).astype(np.float64)
        cut = np.minimum(scaled.sum(axis=1) * self.middle(self.shift), np.sqrt((scaled ** 2).sum(axis=1)) * self.rest_norm)
        slack = 2 * (rest + cut) * (1 + 1e-9) / float(1 << (shift + self.shift)) + 1
        bits = max(int(coarse.max(initial=0)).bit_length(), int(-coarse.min(initial=0)).bit_length()) + 1
        out: list = []
        total: list = []
        for b in range(bits):
            part = self.masked((coarse >> b) & 1)
            if b == bits - 1:  # two's complement: the sign bit weighs minus, so its complement is added
                part = [~s for s in part]
            if b:
                out.append(total[0])
                total = add(total[1:], part)
            else:
                total = part
        return out + total, slack

    def masked(self, bits: np.ndarray) -> list:
        """The sum of the components whose bit is set, per query."""
        terms = []
        for g, sums in enumerate(self.sums):
            part = bits[:, g * GROUP:(g + 1) * GROUP]
            mask = (part << np.arange(part.shape[1])).sum(axis=1)
            terms.append(list(sums[:, mask]))
        while len(terms) > 1:
            terms = [add(terms[i], terms[i + 1]) if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
        return terms[0]

    def boundary(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) pairs that hold every query's k best rows."""
        sums, slack = self.scores(queries)
        kth = select_from_top(sums, self.valid, k)
        limit = np.maximum(np.floor(kth - slack), 0).astype(np.int64)
        rows = np.ascontiguousarray(at_least(sums, self.valid, limit))
        return np.nonzero(np.unpackbits(rows.view(np.uint8), axis=1, bitorder="little"))


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """The vectors of an Arrow column as rows of a matrix, padded with zeros."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], column.type)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def best_of_slot(k: int):
    """The task: the k best candidates of one slot for every query of one cell."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        schema = pa.schema([("query_row", pa.int64()), ("query_id", right.schema.field("vec_id").type),
                            ("vec_id", left.schema.field("vec_id").type), ("score", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        dims = max(pc.max(pc.list_value_length(t["x"])).as_py() for t in (left, right)) or 1
        rows, queries = matrix(left["x"], dims), matrix(right["x"], dims)
        own, asked = left["row"].to_numpy(), right["row"].to_numpy()
        by_id = np.empty(len(rows), np.int64)
        by_id[pc.sort_indices(left["vec_id"], null_placement="at_end").to_numpy()] = np.arange(len(rows))
        slot = Slot(rows)
        batch = max(WORDS // len(slot.valid), 1)
        for at in range(0, len(queries), batch):
            some = queries[at:at + batch]
            q, r = slot.boundary(some, k + 1)
            score = np.empty(len(q), np.int64)
            for i in range(0, len(q), 1 << 16):
                j = slice(i, i + (1 << 16))
                score[j] = np.einsum("ij,ij->i", some[q[j]], rows[r[j]])
            other = asked[at + q] != own[r]
            q, r, score = q[other], r[other], score[other]
            order = np.lexsort((by_id[r], -score, q))
            q, r, score = q[order], r[order], score[order]
            keep = np.arange(len(q)) - np.searchsorted(q, q) < k
            out["query_row"].append(pa.array(asked[at + q[keep]]))
            out["query_id"].append(right["vec_id"].take(pa.array(at + q[keep])))
            out["vec_id"].append(left["vec_id"].take(pa.array(r[keep])))
            out["score"].append(pa.array(score[keep]))
        columns = [pa.chunked_array([c for part in out[f.name] for c in (part.chunks if isinstance(part, pa.ChunkedArray) else [part])], f.type)
                   for f in schema]
        return pa.Table.from_arrays(columns, schema=schema)

    return run


# ---- Spark side

def quantised(vectors: DataFrame, is_query: Column, id_col: str, vec_col: str) -> DataFrame:
    """(row, vec_id, x, is_query) of the vectors that take part."""
    whole = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    x = F.transform(vec_col, lambda v: F.floor(F.lit(float(SCALE)) * v.cast("double")).cast("long"))
    return vectors.where(F.col(vec_col).isNotNull() & F.coalesce(whole, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("vec_id"), x.alias("x"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
          slot_rows: int = SLOT_ROWS, cell_queries: int = CELL_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other rows of every query row."""
    rows = stored(quantised(vectors, is_query, id_col, vec_col), "vectors")
    n = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    slots, cells = -(-n.n // slot_rows) or 1, -(-n.q // cell_queries) or 1
    parts = min(slots * cells, 20000)

    def dealt(name: str, count: int) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(name)), F.lit(count)).cast("int").alias(name)

    def every(name: str, count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    left = rows.select("row", "vec_id", "x", dealt("slot", slots), every("cell", cells))
    # names of its own: Spark would take the right side's columns for the left's, and drop them when the result is only counted
    own = [F.col(c).alias(c) for c in ("row", "vec_id", "x")]
    right = rows.where("is_query").select(*own, dealt("cell", cells), every("slot", slots)).select(*left.columns)
    left, right = (side.repartition(parts, "slot", "cell").groupBy("slot", "cell") for side in (left, right))
    kind = rows.schema["vec_id"].dataType.simpleString()
    found = left.cogroup(right).applyInArrow(best_of_slot(k), f"query_row long, query_id {kind}, vec_id {kind}, score long")
    rank = F.expr("row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id ASC NULLS LAST)")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % EVERY == 0)


OP13_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM t WHERE rank <= 5
"""
