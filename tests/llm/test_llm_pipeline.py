"""The corpus pipeline against its operators applied by hand, and the registered queries."""

import os
import sys

import pytest
from llm_helpers import corpus, frame, prose

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from tools.check import TABLES, digest  # noqa: E402

from ridelake.llm import queries  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


def test_all_operators_are_registered():
    names = set(E.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = queries.QUERIES[name](spark, SMOKE)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(queries.ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, rows)[0] == digest(cols, res.fetchall())[0]


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_returns_a_row_per_input(spark, name):
    table = {"op8": "pages", "op12": "conversations"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SMOKE}/{table}.parquet")
    if table == "conversations":
        rows = rows.select("conv_id").distinct()
    assert queries.QUERIES[name](spark, SMOKE).count() == rows.count()


def test_pipeline_stages(spark, tmp_path):
    import random
    rng = random.Random(2)
    rows = [r for r in corpus(80)]
    item = prose(rng, 30)
    rows += [(700, item, "en", "src0", 0), (701, item + " more", "en", "src1", 0)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in out}
    assert not ids & {100, 102, 103, 104, 105, 106, 700, 701}  # copies, no letters, benchmark text
    assert {r.shard for r in out} <= set(range(16)) and set(out[0].asDict()) >= {"doc_id", "text", "lang", "source", "n_chars", "shard"}
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    assert all(r.doc_id is None or texts[r.doc_id] == r.text for r in out)
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0, name
