"""Removal of line chunks that repeat across the corpus, in DataFrame functions only.

A text's lines are hashed, and a rolling hash over ``ROLL`` line hashes
decides after which lines a chunk ends, so boundaries follow the content and
fall into place again after an insertion.  Chunks of two lines or more that
occur elsewhere are compared byte by byte with the first occurrence (by
doc_id, then text checksum, then position) and removed when equal.

Only chunk checksums of all documents are shuffled.  Texts are shuffled where
a bitmap of bounded size says that the document may hold a repeated chunk;
chunk texts are compared for repeated checksums alone.  Rows of equal id and
text are one document: they keep the same chunks.

Edge cases: NULL text stays NULL, empty text stays empty; NULL ids order
first; a text may lose all its chunks and become empty; an empty table gives
an empty result; extra columns pass through, clashing ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import apart, marked, marks, stored, table

ROLL = 3
MEAN_LINES = 4  # a power of two up to 16: the mean length of a chunk in lines


def with_chunks(rows: DataFrame) -> DataFrame:
    """Add ``_lines`` and ``_chunks``, an array of (from, to, key) by line number."""
    rows = rows.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    rows = rows.withColumn("_hash", F.transform("_lines", lambda x: F.md5(x.cast("binary"))))
    n = F.size("_lines")
    rolled = F.col("_hash")
    for back in range(1, ROLL):  # earlier lines in front; the first lines have fewer
        shifted = F.concat(F.array_repeat(F.lit(""), back), F.slice("_hash", 1, F.greatest(n - back, F.lit(0))))
        rolled = F.zip_with(shifted, rolled, lambda a, b: F.concat(a, b))
    rows = rows.withColumn("_roll", rolled)

    def ends(r: Column, i: Column) -> Column:
        cut = F.conv(F.substring(F.md5(r.cast("binary")), 1, 1), 16, 10).cast("int") % MEAN_LINES == 0
        return F.when(cut | (i == n - 1), i)

    rows = rows.withColumn("_to", F.filter(F.transform("_roll", ends), lambda i: i.isNotNull()))
    first = F.concat(F.array(F.lit(0)), F.transform("_to", lambda e: e + 1))
    spans = F.zip_with(first, "_to", lambda s, e: F.struct(s.alias("from"), e.alias("to")))
    spans = F.filter(spans, lambda x: x["to"].isNotNull())
    keyed = F.transform(spans, lambda x: F.struct(
        x["from"].alias("from"), x["to"].alias("to"),
        F.md5(F.array_join(F.slice("_hash", x["from"] + 1, x["to"] - x["from"] + 1), "").cast("binary")).alias("key")))
    return rows.withColumn("_chunks", keyed).drop("_hash", "_roll", "_to")


def lines_of(chunk: Column) -> Column:
    return F.array_join(F.slice("_lines", chunk["from"] + 1, chunk["to"] - chunk["from"] + 1), "\n")


def same_doc(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on doc_id (NULL equals NULL) and text checksum; ``right`` carries _d and _t.

    The lists joined here and below grow with the corpus, so they are merged
    at every size and never broadcast.
    """
    on = left["doc_id"].eqNullSafe(right["_d"]) & left["_sum"].eqNullSafe(right["_t"])
    return left.join(right.hint("merge"), on, how).drop("_d", "_t")


def summed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_sum", F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(_d, _t, _removed): the chunk numbers to remove, per document that has any."""
    texts = summed(docs.select("doc_id", "text").where("text IS NOT NULL"))
    # outer: the optimizer adds a filter on the array below a plain explode, written
    # out in full, which would compute the line hashes anew for every chunk
    chunks = with_chunks(texts).select("doc_id", "_sum", F.posexplode_outer("_chunks").alias("at", "c"))
    chunks = chunks.where(F.col("c.to") > F.col("c.from")).select("doc_id", "_sum", "at", F.col("c.key").alias("key"))
    chunks = stored(chunks, "line-chunks")
    again = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    again = stored(again, "line-again")  # a table of its own: the join can split a hot chunk
    wanted = chunks.join(again.hint("merge"), "key").groupBy(F.col("doc_id").alias("_d"), F.col("_sum").alias("_t")).agg(
        F.sort_array(F.collect_set("at")).alias("_at"))
    wanted = stored(wanted, "line-wanted")
    picked = F.transform("_at", lambda i: F.struct(i.alias("at"), F.get("_chunks", i)["key"].alias("key"), lines_of(F.get("_chunks", i)).alias("body")))
    likely = marked(texts, stored(marks(wanted, "_d", "_t"), "line-marks"), "doc_id", "_sum").where("_marked")
    bodies = with_chunks(same_doc(likely.drop("_marked"), wanted, "inner")).select("doc_id", "_sum", F.explode_outer(picked).alias("c"))
    bodies = stored(bodies.where("c.key IS NOT NULL").select("doc_id", "_sum", "c.at", "c.key", "c.body"), "line-bodies")
    place = F.struct("doc_id", "_sum", "at")
    first = bodies.groupBy("key").agg(F.min(F.struct(place.alias("place"), "body")).alias("first"))
    first = stored(first.select("key", F.col("first.place").alias("place"), F.col("first.body").alias("kept")), "line-first")
    later = bodies.join(first.hint("merge"), "key").where((F.col("body") == F.col("kept")) & ~place.eqNullSafe(F.col("place")))
    gone = later.groupBy(F.col("doc_id").alias("_d"), F.col("_sum").alias("_t")).agg(F.sort_array(F.collect_set("at")).alias("_removed"))
    return stored(gone, "line-removed")


@apart("doc_id", "text")
def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with n_lines, n_removed_lines and ``text`` without repeated chunks."""
    gone = repeated_chunks(docs)
    rows = marked(summed(docs), stored(marks(gone, "_d", "_t"), "line-marks"), "doc_id", "_sum")
    cut = with_chunks(same_doc(rows.where("_marked"), gone, "left"))
    hit = F.col("_removed").isNotNull()
    left = F.array_except(F.sequence(F.lit(0), F.size("_chunks") - 1), "_removed")
    n_gone = F.aggregate(F.transform("_removed", lambda i: F.get("_chunks", i)["to"] - F.get("_chunks", i)["from"] + 1),
                         F.lit(0), lambda s, x: s + x)
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.split("text", "\n"))).cast("long")
    cut = cut.withColumns({
        "n_lines": n_lines, "n_removed_lines": F.when(hit, n_gone).otherwise(F.lit(0)).cast("long"),
        "text": F.when(hit, F.array_join(F.transform(left, lambda i: lines_of(F.get("_chunks", i))), "\n")).otherwise(F.col("text"))})
    rest = rows.where("NOT _marked").withColumns({"n_lines": n_lines, "n_removed_lines": F.lit(0).cast("long")})
    return cut.drop("_lines", "_chunks", "_removed", "_sum", "_marked").unionByName(rest.drop("_sum", "_marked"))


def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_lines", "n_removed_lines", "text")


OP7_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, text, md5(text) AS m FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, m, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
h AS (SELECT *, md5(line) AS h FROM l),
r AS (SELECT *, md5(coalesce(lag(h, 2) OVER w, '') || coalesce(lag(h, 1) OVER w, '') || h) AS r FROM h
      WINDOW w AS (PARTITION BY doc_id, m ORDER BY i)),
c AS (SELECT *, coalesce(sum((position(substr(r, 1, 1) IN '048c') > 0)::INT) OVER (
        PARTITION BY doc_id, m ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM r),
k AS (SELECT doc_id, m, chunk, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n FROM c GROUP BY 1, 2, 3),
o AS (SELECT *, row_number() OVER (PARTITION BY CASE WHEN n > 1 THEN body END, n > 1 ORDER BY doc_id NULLS FIRST, m, chunk) AS nth FROM k),
t AS (SELECT doc_id, m, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (n > 1 AND nth > 1), 0)::BIGINT AS n_removed_lines,
             coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (NOT (n > 1 AND nth > 1)), '') AS text
      FROM o GROUP BY 1, 2)
SELECT x.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed_lines, 0) AS n_removed_lines, t.text
FROM documents x LEFT JOIN t ON x.doc_id IS NOT DISTINCT FROM t.doc_id AND md5(x.text) = t.m
"""
