"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target number of words.  A document is first taken as
often as whole epochs fit into its source's target; what is left is filled
by weighted sampling without replacement: every document draws an
exponential key -ln(u) / w (u uniform from its id and text, w its quality
weight) and documents are taken in key order up to the budget.

The order within a source is never built in one task.  Keys are cut into
narrow bins (1/256 of an octave), sizes are summed per (source, bin) and
prefix-summed; only the bin that crosses the budget is cut again into 1024
parts, and only the rows of the crossing part are ordered one by one.

Edge cases: NULL or empty text has size 0 and takes no words; a NULL source
is a source of its own, last in order; equal keys are ordered by id and text
checksum, and fully equal rows are interchangeable; an empty table gives an
empty result; extra columns pass through ``mix``, replaced where they clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WS, stored, table, words

MAX_EPOCHS = 3
WEIGHT_CYCLE = 3
BINS_PER_OCTAVE = 256
PARTS = 1024


def quality_weight(text: Column, size: Column) -> Column:
    """1 for plain prose, less the more symbol characters a word carries."""
    symbols = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^#*$%&|<>!]+", ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(4.0) * symbols / F.greatest(size, F.lit(1)))


def uniform(doc_id: Column, checksum: Column) -> Column:
    """A reproducible uniform number in (0, 1) of the record."""
    key = F.concat_ws(":", doc_id.cast("string"), checksum)
    bits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long")
    return (bits + 0.5) / F.lit(float(1 << 48))


def digest(docs: DataFrame, keep: str | None = None) -> DataFrame:
    """Per document: id, source, checksum, size in words, key position ``x``.

    ``keep`` names a column that carries the whole row along.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [F.struct(*[F.col(c) for c in docs.columns]).alias(keep)] if keep else []
    out = docs.select(*kept, "doc_id", "source", F.md5(text.cast("binary")).alias("checksum"),
                      F.size(words(text)).cast("long").alias("size"), text.alias("_text"))
    w = quality_weight(F.col("_text"), F.col("size"))
    key = -F.log(uniform(F.col("doc_id"), F.col("checksum"))) / w
    out = out.withColumn("x", F.log2(key) * BINS_PER_OCTAVE).drop("_text").withColumn("bin", F.floor("x"))
    return out.withColumn("part", F.floor((F.col("x") - F.col("bin")) * PARTS))


def targets(rows: DataFrame, weight: Column | None = None, cap: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target), one row per source.

    target = min(cap * size, c * weight) with the one c for which the targets
    sum to all sizes: sources are sorted by the c at which each reaches its
    cap, and c is the first share that stays below the next of these.
    The windows order one row per source, never documents.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    if weight is None:
        weight = (F.row_number().over(order) - 1) % WEIGHT_CYCLE + 1
    per = per.withColumn("w", weight.cast("double"))
    per = per.withColumn("limit", cap * F.col("source_size") / F.col("w"))
    everything = Window.partitionBy()
    rank = Window.orderBy("limit", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum(cap * F.col("source_size")).over(rank), F.lit(0.0))
    used = F.coalesce(F.sum("w").over(rank), F.lit(0.0))
    share = (F.sum("source_size").over(everything) - capped) / (F.sum("w").over(everything) - used)
    per = per.withColumn("c", share)
    c = F.min(F.when(F.col("c") <= F.col("limit"), F.struct("limit", "c"))).over(everything)["c"]
    target = F.least(cap * F.col("source_size"), F.coalesce(c, F.lit(0.0)) * F.col("w"))
    return per.select("source", "source_size", target.alias("target"))


def epochs(per: DataFrame) -> DataFrame:
    """Add whole epochs and the budget left after them."""
    n = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    n = F.least(n, F.lit(MAX_EPOCHS)).cast("long")
    out = per.withColumn("whole", n)
    return out.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))


def _crossing(sums: DataFrame, by: str, prefix: str) -> DataFrame:
    """The first value of ``by`` whose running size passes the budget left, per source."""
    run = Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("run", F.sum("n").over(run))
    past = sums.where(F.col("run") > F.col("left"))
    return past.groupBy("source").agg(F.min(F.struct(by, (F.col("left") - F.col("run") + F.col("n")).alias("rest"))).alias("m")).select(
        F.col("source").alias("_s"), F.col(f"m.{by}").alias(f"{prefix}_at"), F.col("m.rest").alias(f"{prefix}_left"))


def cuts(rows: DataFrame, per: DataFrame) -> DataFrame:
    """Per source: the bin and part at which the budget runs out, and what is left there."""
    same = F.col("source").eqNullSafe(F.col("_s"))
    left = per.select(F.col("source").alias("_s"), F.col("budget").alias("left"))
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("n"))
    at_bin = stored(_crossing(bins.join(left, same).drop("_s"), "bin", "bin"), "mix-bins")
    inside = rows.join(at_bin, same & (F.col("bin") == F.col("bin_at")))
    parts = inside.groupBy("source", "part").agg(F.sum("size").alias("n"), F.first("bin_left").alias("left"))
    at_part = _crossing(parts, "part", "part")
    cut = per.join(at_bin, same, "left").drop("_s").join(at_part, same, "left").drop("_s")
    return cut.withColumnRenamed("source", "_s")


def taken(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """Add source_size, target, times and taken (words, repeats counted) to digest rows."""
    out = rows.join(cut, rows["source"].eqNullSafe(cut["_s"]), "left").drop("_s")
    edge = F.coalesce((F.col("bin") == F.col("bin_at")) & (F.col("part") == F.col("part_at")), F.lit(False))
    # no crossing bin: the budget covers no row (it is below one epoch of nothing) or all rows
    before = (F.col("bin") < F.col("bin_at")) | ((F.col("bin") == F.col("bin_at")) & (
        F.col("part_at").isNull() | (F.col("part") < F.col("part_at"))))
    before = F.coalesce(before, (F.col("budget") > 0) & F.col("bin_at").isNull())
    run = Window.partitionBy("source").orderBy("x", "doc_id", "checksum").rowsBetween(Window.unboundedPreceding, -1)
    at = out.where(edge).withColumn("so_far", F.coalesce(F.sum("size").over(run), F.lit(0)))
    at = at.withColumn("extra", F.col("so_far") + F.col("size") / 2 <= F.col("part_left")).drop("so_far")
    out = out.where(~edge).withColumn("extra", before).unionByName(at)
    times = F.least(F.col("whole") + F.col("extra").cast("long"), F.lit(MAX_EPOCHS))
    return out.withColumn("times", times).withColumn("taken", times * F.col("size"))


def plan(docs: DataFrame, weight: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(digest rows, cuts): all that a mix needs to know, one scan of the texts.

    ``weight`` is an expression over ``source``; by default sources in code
    point order weigh 1, 2, 3, repeating.
    """
    rows = stored(digest(docs), "mix-digest")
    per = stored(epochs(targets(rows, weight)), "mix-sources")
    return rows, stored(cuts(rows, per), "mix-cuts")


def mix(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """Digest rows of ``docs`` with source_size, target, times and taken."""
    return taken(*plan(docs, weight))


def mixed_documents(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """The documents the mix takes, each as often as it is taken, with their own columns.

    A row's key follows from the row, so the texts are matched with the cuts
    of their sources and not shuffled by id.
    """
    _, cut = plan(docs, weight)
    out = taken(digest(docs, keep="_row"), cut).where(F.col("times") > 0)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return out.withColumn("_copy", copies).select("_row.*")


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[{WS}]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
a AS (SELECT *, 3 * s / w AS lim, sum(s) OVER () AS total, sum(w) OVER () AS ws,
             coalesce(sum(3 * s) OVER o, 0) AS capped, coalesce(sum(w) OVER o, 0) AS used
      FROM p WINDOW o AS (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT arg_min((total - capped) / (ws - used), lim) AS c FROM a WHERE (total - capped) / (ws - used) <= lim),
g AS (SELECT source, s, least(3.0 * s, coalesce(c, 0) * w)::DOUBLE AS target FROM a, c),
e AS (SELECT *, CASE WHEN s > 0 THEN least(floor(target / s), 3) ELSE 0 END AS whole FROM g),
k AS (
  SELECT doc_id, source, size, md5(t) AS m, length(regexp_replace(t, '[^#*$%&|<>!]+', '', 'g')) AS symbols,
         (('0x' || substr(md5(concat_ws(':', doc_id::VARCHAR, md5(t))), 1, 12))::BIGINT + 0.5) / 281474976710656.0::DOUBLE AS u
  FROM d),
r AS (SELECT *, -ln(u) * (1.0::DOUBLE + 4.0::DOUBLE * symbols / greatest(size, 1)) AS key FROM k),
x AS (
  SELECT r.doc_id, r.size, e.s, e.target, e.whole,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.doc_id, r.m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           + r.size / 2 <= e.target - e.whole * e.s AS extra
  FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, s AS source_size, target, (least(whole + extra::INT, 3) * size)::BIGINT AS taken FROM x
"""
