"""Quality rules decided per host.

Row rules are counted natively inside each text.  Failures are summed per
host, the failure rate of each rule is shrunk towards a beta prior fitted to
all hosts by moments, and hosts whose shrunk rate reaches ``MAX_RATE`` for a
rule are rejected; the verdict is joined back to their documents.

Edge cases: NULL or empty text has no words and fails the length rule; a
NULL host forms a host of its own; a single host, or hosts of equal rates,
give a prior of strength ``MAX_STRENGTH``; repeated rows count each time; an
empty table gives an empty result; columns of the same name as an added one
are replaced, others pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS, apart, stored, table, words

MIN_WORDS = 50
MAX_RATE = 0.5
MAX_STRENGTH = 1e6
RULES = ("base_failed", "symbols_failed", "lines_failed")


def with_repeat_words(rows: DataFrame) -> DataFrame:
    """Add n_repeat_words: words of ``_words`` inside 3-word windows found twice or more.

    Windows are compared by a 64-bit hash.  Equal windows become neighbours
    by sorting (hash, position); the repeated positions are then walked in
    order, each adding the part of its three words not covered yet.  Each
    step is a column of its own, so that it is computed once; texts without
    a repeat stop after the first.
    """
    w, n = F.col("_words"), F.size("_words")
    pairs = F.zip_with(w, F.slice(w, 2, n), lambda a, b: F.xxhash64(a, b))
    hashes = F.zip_with(pairs, F.slice(w, 3, n), lambda a, b: F.xxhash64(a, b))
    rows = rows.withColumn("_h", F.when(n >= 3, F.slice(hashes, 1, n - 2)))
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    rows = rows.withColumn("_at", F.when(repeats, F.sort_array(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    # whether a window equals the next one in sort order
    rows = rows.withColumn("_eq", F.zip_with("_at", F.slice("_at", 2, F.size("_h")), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))))
    rows = rows.withColumn("_eq", F.zip_with("_eq", F.concat(F.array(F.lit(False)), "_eq"), lambda x, y: F.coalesce(x, F.lit(False)) | y))
    rows = rows.withColumn("_hit", F.sort_array(F.filter(
        F.zip_with("_at", "_eq", lambda a, f: F.when(f, a["i"])), lambda i: i.isNotNull())))
    steps = F.zip_with("_hit", F.slice("_hit", 2, F.size("_h")), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_h", "_at", "_eq", "_hit")


@apart("doc_id", "text", "source")
def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts and row-rule failures of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{WS}]"))
    out = docs.withColumn("_words", words(F.col("text"))).withColumn("_lines", lines)
    w = F.col("_words")
    n = F.size(w).cast("long")
    out = out.withColumns({
        "n_words": n,
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    })
    out = with_repeat_words(out).drop("_words", "_lines")
    return out.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "symbols_failed": 4 * F.col("n_symbols") > F.col("word_chars"),
        "lines_failed": 2 * F.col("n_dup_lines") > F.col("n_lines"),
    })


def host_rates(rows: DataFrame, host: str = "source") -> DataFrame:
    """Per host: rows, failures of each rule and their rates."""
    out = rows.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("host_rows"),
        *[F.sum(F.col(r).cast("long")).alias(f"{r}_n") for r in RULES])
    return out.withColumns({f"{r}_rate": F.col(f"{r}_n") / F.col("host_rows") for r in RULES})


def prior(rates: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and strength of each rule's beta prior, by moments over hosts (one row)."""
    row = rates.agg(*[f(f"{r}_rate").alias(f"{r}_{f.__name__}") for r in RULES for f in (F.avg, F.var_pop)]).first()
    out = {}
    for r in RULES:
        mean, var = row[f"{r}_avg"] or 0.0, row[f"{r}_var_pop"] or 0.0
        strength = mean * (1 - mean) / var - 1 if var > 0 else MAX_STRENGTH
        out[r] = (mean, min(max(strength, 1.0), MAX_STRENGTH))
    return out


def verdicts(rates: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """(host, shrunk rate of each rule, host_rejected)."""
    shrunk = {f"{r}_shrunk": (F.col(f"{r}_n") + mean * k) / (F.col("host_rows") + k) for r, (mean, k) in prior(rates).items()}
    out = rates.withColumns(shrunk)
    worst = F.greatest(*[F.col(c) for c in shrunk])
    return out.select("host", *shrunk, (worst >= max_rate).alias("host_rejected"))


def apply_verdicts(rows: DataFrame, hosts: DataFrame, host: str = "source") -> DataFrame:
    """Measured rows with ``host_rejected`` and ``kept``."""
    @apart(host, "base_failed")
    def judged(rows: DataFrame) -> DataFrame:
        flags = hosts.select(F.col("host").alias("_host"), F.col("host_rejected"))
        out = rows.join(flags, rows[host].eqNullSafe(F.col("_host")), "left").drop("_host")
        return out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False)))

    return judged(rows)


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measured(table(spark, sf_dir, "documents")).drop("text")
    rows = stored(rows, "host-rules")
    out = apply_verdicts(rows, verdicts(host_rates(rows)))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


# host_rejected in SQL: the same moments and shrinkage over the sources
OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rk, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rk, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT rk, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
c AS (SELECT rk, i, count(*) OVER (PARTITION BY rk, w[i], w[i + 1], w[i + 2]) AS n FROM g),
p AS (SELECT rk, count(DISTINCT i + k) AS n FROM c, (SELECT unnest([0, 1, 2]) AS k) WHERE n >= 2 GROUP BY rk),
m AS (
  SELECT doc_id, source, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(l) AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (rk) LEFT JOIN p USING (rk)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             4 * n_symbols > word_chars AS sf, 2 * n_dup_lines > n_lines AS lf FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS b, sum(sf::INT) AS s, sum(lf::INT) AS l FROM f GROUP BY 1),
q AS (SELECT source, n, unnest([b, s, l]) AS x, unnest([0, 1, 2]) AS rule FROM h),
pr AS (SELECT rule, avg(x / n) AS mean, var_pop(x / n) AS var FROM q GROUP BY rule),
st AS (SELECT rule, mean, CASE WHEN var > 0 THEN least(greatest(mean * (1 - mean) / var - 1, 1), 1e6) ELSE 1e6 END AS k FROM pr),
v AS (SELECT source, max((x + mean * k) / (n + k)) >= 0.5 AS rejected FROM q JOIN st USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT v.rejected AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
