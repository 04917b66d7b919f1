"""Benchmark decontamination with an Aho-Corasick automaton.

Benchmark items are normalised to words (A-Z lower-cased; words are runs of
ASCII letters, digits and non-ASCII characters) and cut into windows of 13
consecutive words; a shorter item is one window.  The windows become the
patterns of one automaton over word numbers, and each document is scanned
once.  Hits are mapped back to code point offsets of the original text.

The automaton is built inside the tasks from broadcast item texts.  Items
are dealt into blocks of about ``BLOCK_BYTES`` of text by hash, and one
automaton holds one block.  The driver reads a block, and broadcasts it, at
a time (the next one is at hand), so neither it nor a task grows with the
benchmark: a benchmark above the bound takes one more scan per block.

Edge cases: NULL or empty documents and items have no words; an item that
occurs twice, or two items of one id, count once; an item without an id is
listed as the empty string; an empty benchmark hits nothing; an empty table
gives an empty result; extra columns pass through, clashing ones are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from .common import apart, small_batches, stored, strings, table

WINDOW = 13
SHARE = 20  # contaminated when 1/SHARE of the words are hit
BLOCK_BYTES = 1 << 20

# bytes of words map to themselves (A-Z to a-z), all others to a space
_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("ranges", T.ArrayType(T.ArrayType(T.IntegerType()))),  # [first word, last word]
    T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),  # [start, end) in code points
    T.StructField("items", T.ArrayType(T.StringType()))])


def normalised(text: str | None) -> bytes:
    """The text's UTF-8 bytes with everything outside words blanked, byte for byte."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)


class Windows:
    """The automaton over one block of items."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        import ahocorasick

        self.number: dict[bytes, int] = {}
        owners: dict[tuple, set[str]] = {}
        for item, text in items:
            words = normalised(text).split()
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            for i in range(max(len(ids) - window, 0) + 1 if ids else 0):
                owners.setdefault(tuple(ids[i:i + window]), set()).add(item)
        self.automaton = None
        if owners:
            self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for key, who in owners.items():
                self.automaton.add_word(key, (len(key), tuple(who)))
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple:
        import numpy as np

        blank = normalised(text)
        words = blank.split()
        if self.automaton is None or not words:
            return len(words), [], [], []
        number = self.number.get
        found, who = [], set()
        for end, (length, items) in self.automaton.iter(tuple([number(w, 0) for w in words])):
            who.update(items)
            found.append((end - length + 1, end))
        if not found:
            return len(words), [], [], []
        ranges = []
        for first, last in sorted(found):
            if ranges and first <= ranges[-1][1] + 1:
                ranges[-1][1] = max(ranges[-1][1], last)
            else:
                ranges.append([first, last])
        codes = np.frombuffer(blank, np.uint8)
        flag = np.concatenate(([False], codes != 0x20, [False]))
        edge = np.flatnonzero(flag[1:] != flag[:-1])
        # byte offset -> code point offset: bytes that do not continue a character
        point = np.concatenate(([0], np.cumsum((codes & 0xC0) != 0x80)))
        spans = [[int(point[edge[2 * a]]), int(point[edge[2 * b + 1]])] for a, b in ranges]
        return len(words), ranges, spans, sorted(who)


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The items, dealt by hash into blocks of about ``block_bytes`` of text; one block at a time is held.

    More than one block is written to the shared folder first, by block, so that each is read once.
    """
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total) // block_bytes + 1
    if n > 1:
        path = scratch_dir(items.sparkSession, "items")
        block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
        rows.withColumn("block", block).repartition("block").write.partitionBy("block").parquet(path)
        rows = items.sparkSession.read.schema("item string, text string, block long").parquet(path)
    for b in range(n):
        part = rows.where(F.col("block") == b) if n > 1 else rows
        yield [(r.item, r.text) for r in part.select("item", "text").collect()]


def _scanner(shared: Broadcast, window: int):
    @F.pandas_udf(HITS)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        windows = Windows(shared.value, window)
        for batch in texts:
            yield pd.DataFrame([windows.scan(t) for t in strings(batch)], columns=HITS.names)

    return scan


@apart("doc_id", "text")
def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_spans, items, n_items, items_sha256, contaminated."""
    spark = docs.sparkSession
    small_batches(spark)
    none = F.array().cast("array<array<int>>")
    out = docs.withColumns({"_ranges": none, "hit_spans": none, "items": F.array().cast("array<string>"), "n_words": F.lit(0).cast("long")})
    blocks, several = item_blocks(items, block_bytes), False
    block, more = next(blocks), next(blocks, None)
    while block is not None:
        shared = spark.sparkContext.broadcast(block)
        several = several or more is not None
        out = out.withColumn("_hit", _scanner(shared, window)("text"))
        out = out.withColumns({
            "_ranges": F.concat("_ranges", "_hit.ranges"), "hit_spans": F.concat("hit_spans", "_hit.spans"),
            "items": F.concat("items", "_hit.items"), "n_words": F.col("_hit.n_words")}).drop("_hit")
        if several:  # one block's broadcast and automaton at a time
            out = stored(out, "scan")
            shared.unpersist()
        block, more = more, next(blocks, None)
    hit = F.array_distinct(F.flatten(F.transform("_ranges", lambda r: F.sequence(r[0], r[1]))))
    out = out.withColumn("items", F.sort_array(F.array_distinct("items")))
    out = out.withColumns({
        "n_hit": F.size(hit).cast("long"), "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.array_join("items", ",").cast("binary"), 256)}).drop("_ranges")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    whole = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return find(whole, items).where(~F.col("contaminated")).select("_row.*")


def op6_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = find(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP6_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rk, doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_SQL_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS g
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT rk, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT rk, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT rk, i, n, item FROM dw JOIN bw USING (n, g)),
c AS (SELECT rk, count(DISTINCT p) AS n_hit FROM (SELECT rk, unnest(range(i, i + n)) AS p FROM h) GROUP BY rk),
t AS (SELECT rk, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT rk, item FROM h) GROUP BY rk)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), FALSE) AS contaminated
FROM d LEFT JOIN c USING (rk) LEFT JOIN t USING (rk)
"""
