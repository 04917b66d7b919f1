"""Exact top-k search against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridelake.llm import bit_sliced

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5):
    """(query_id, rank, vec_id, score) by scoring every pair."""
    def ints(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(256 * float(np.float32(x))) for x in v]
    rows = [(i, ints(v)) for i, v in rows]
    rows = [(n, i, v) for n, (i, v) in enumerate(rows) if v is not None]
    out = []
    for n, i, q in rows:
        if i is None or i % 50:
            continue
        scores = [(-sum(a * b for a, b in zip(q, c)), j is None, j or 0, j) for m, j, c in rows if m != n]
        out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def top(spark, rows, **params):
    return bit_sliced.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, **params)


def vectors(n, dims=12, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 0.3) for _ in range(dims)]) for i in range(n)]


AWKWARD = [
    (1000, None), (1001, [0.1, None, 0.2]), (1002, [float("nan")] * 12), (1003, [float("inf")] + [0.0] * 11), (1050, None),
    (1100, []), (1101, [0.5]), (1150, [2.0] * 20), (None, [0.9] * 12), (None, [0.9] * 12), (1200, [0.0] * 12),
    (1250, [0.3] * 12), (1250, [0.3] * 12), (1251, [0.3] * 12), (1252, [1000.0, -1000.0] * 6), (1300, [-3.5, 7.25] * 6),
]


@pytest.mark.parametrize("slot_rows,cell_queries", [(8192, 8192), (40, 3)])
def test_matches_brute_force(spark, slot_rows, cell_queries):
    rows = vectors(400) + AWKWARD
    got = top(spark, rows, slot_rows=slot_rows, cell_queries=cell_queries)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert found(got) == brute(rows) and got.count() == len(brute(rows)) and got.select("rank").agg(F.max("rank")).first()[0] == 5


def test_a_third_of_all_rows_share_one_vector(spark):
    rows = vectors(200) + [(1000 + i, [0.25] * 12) for i in range(100)] + [(2000 + i, [0.25] * 11 + [0.2501]) for i in range(30)]
    assert found(top(spark, rows, slot_rows=64)) == brute(rows)


def test_few_rows_none_and_other_columns(spark):
    assert top(spark, []).collect() == []
    assert top(spark, [(50, [1.0])]).collect() == []
    assert found(top(spark, [(50, [1.0]), (7, [2.0])])) == [(50, 1, 7, 256 * 512)]
    assert top(spark, [(1, [1.0]), (2, [1.0])]).collect() == []
    df = spark.createDataFrame(vectors(60), SCHEMA)
    for name in ("row", "x", "slot", "cell", "is_query", "score", "rank", "query_id", "query_row"):
        df = df.withColumn(name, F.lit("mine"))
    assert found(bit_sliced.top_k(df, F.col("vec_id") % 50 == 0)) == brute(vectors(60))


def test_bitmap_sums_and_selection():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 200, (100, 3)), rng.integers(0, 9, (100, 3))
    total = bit_sliced.add(list(bit_sliced.sliced(a).transpose(1, 0, 2)), list(bit_sliced.sliced(b).transpose(1, 0, 2)))
    bits = np.array([np.unpackbits(s.view(np.uint8), axis=1, bitorder="little")[:, :100] for s in total])
    assert ((bits.astype(int) << np.arange(len(total))[:, None, None]).sum(axis=0).T == a + b).all()
    valid = bit_sliced.sliced(np.ones((100, 1), np.int64))[0, 0]
    kth = bit_sliced.select_from_top(total, valid, 7)
    assert kth.tolist() == np.sort(a + b, axis=0)[-7].tolist()
    rows = np.unpackbits(bit_sliced.at_least(total, valid, kth).view(np.uint8), axis=1, bitorder="little")[:, :100]
    assert (rows.T == (a + b >= kth)).all()


def test_bounds_hold_and_most_rows_need_no_exact_score():
    rng = np.random.default_rng(3)
    rows = rng.integers(-200, 200, (3000, 64))
    queries = rng.integers(-200, 200, (40, 64))
    q, r = bit_sliced.Slot(rows).boundary(queries, 6)
    exact = queries @ rows.T
    need = exact >= np.sort(exact, axis=1)[:, -6:-5]
    got = np.zeros(exact.shape, bool)
    got[q, r] = True
    assert not (need & ~got).any() and got.mean() < 0.1
