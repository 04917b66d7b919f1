"""Personal data by candidate generation and boosted trees, in DataFrame functions only.

Base rules find emails, IP addresses, card and phone numbers.  Beside them
wide generators propose further, overlapping spans (obfuscated emails,
numbers without a plus sign, other separators).  Each proposal is described
by a few small format and context features.  Gradient boosted trees learn
from the corpus itself: a proposal that overlaps a base span of its kind is
labelled, any other unlabelled, whatever it is.  The trees see shape and
context, not the marks that the base rules ask for, so other forms of the
same data score like it.  All proposals of the learning folds are counted by
feature values, and the trees are fitted to these counts, at most one row
per combination of values.  Per kind, the calibration fold tells how often
personal data is labelled, and so the score at which an unlabelled proposal
is personal data more likely than not (``POSTERIOR``); proposals above it
that touch no base span are added.

Spans are in code points, end exclusive.  All patterns are possessive or
anchored behind their own characters, so a long run of digits or letters
costs time in proportion to its length and no stack.

Edge cases: NULL or empty text has no span; repeated rows give equal rows;
without any proposal nothing is added; an empty table gives an empty result;
extra columns pass through ``detect`` and ``redact``, clashing ones are
replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import apart, fold, stored, table

KINDS = ("email", "ip", "card", "phone")

# Base patterns.  \G lets a match start where the last one ended inside a run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators of proposals
WIDE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\.|\(dot\)|\[dot\])[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:[.,:][0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+(.-])[+(]?[0-9][0-9\x20().-]{7,20}[0-9](?![0-9A-Za-z])",
}
# what a text must hold for a pattern to match at all
NEEDS = {"email": ("@", "(at)", "[at]"), "phone": ("+",)}
CONTEXT = {
    "email": "e-?mail|contact|write|correo|courriel|kontakt",
    "ip": r"\bip\b|address|server|host|login|adresse",
    "card": "card|visa|master|credit|payment|karte|carte|tarjeta",
    "phone": r"phone|call|tel\b|fax|mobile|telefon|anruf",
}
FEATURES = ("kind", "check", "separator", "prefix", "tail", "left", "right", "context")
# what the trees see: not what the base rules ask for (a plus, an at sign, certain separators), or every other form
# would be told from the base spans by that alone
LEARNED = ("kind", "check", "tail", "left", "right", "context")
ROUNDS, RATE, MIN_WEIGHT = 30, 0.4, 1.0
POSTERIOR = 0.5  # least probability that a proposal is personal data
CHUNK = 256


def prefix_sums(values: Column) -> Column:
    """Sums of all earlier values, for each position of an array of numbers.

    Blocks of ``CHUNK`` values are summed first, so the work stays near
    proportional for very long arrays.
    """
    zero = F.lit(0).cast("long")
    n = F.size(values)
    last = F.greatest(F.ceil(n / CHUNK) - 1, F.lit(0))
    blocks = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda b: F.slice(values, (b * CHUNK + 1).cast("int"), CHUNK))
    running = lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v))
    starts = F.aggregate(F.transform(blocks, lambda x: F.aggregate(x, zero, lambda s, v: s + v)), F.array(zero), running)
    inside = F.zip_with(blocks, F.slice(starts, 1, F.size(blocks)),
                        lambda x, s: F.slice(F.aggregate(x, F.array(s), running), 1, F.size(x)))
    return F.when(n > 0, F.flatten(inside)).otherwise(F.array().cast("array<bigint>"))


def _with_matches(rows: DataFrame, pattern: str, out: str, needs: tuple = ()) -> DataFrame:
    """Add ``out``: array of (start, end, m, before, after) of all matches in ``_text``.

    Texts are split at the matches; starts are running sums of the lengths.
    """
    pat = F.lit(pattern)
    text = F.col("_text")
    empty = F.array().cast("array<string>")
    found = F.regexp_extract_all(text, pat, F.lit(0))
    if needs:
        any_ = F.lit(False)
        for s in needs:
            any_ = any_ | F.contains(text, F.lit(s))
        found = F.when(any_, found).otherwise(empty)
    rows = rows.withColumn("_m", found)
    rows = rows.withColumn("_gap", F.when(F.size("_m") > 0, F.split(text, pattern, -1)).otherwise(empty))
    rows = rows.withColumn("_len", F.zip_with("_m", F.slice("_gap", 1, F.size("_m")), lambda m, g: (F.length(m) + F.length(g)).cast("long")))
    rows = rows.withColumn("_before", prefix_sums(F.col("_len")))
    rows = rows.withColumn("_from", F.zip_with("_before", F.slice("_gap", 1, F.size("_m")), lambda b, g: b + F.length(g)))
    around = F.zip_with("_from", "_m", lambda s, m: F.struct(s.alias("s"), m.alias("m")))
    spans = F.transform(around, lambda x, i: F.struct(
        x["s"].alias("start"), (x["s"] + F.length(x["m"])).alias("end"), x["m"].alias("m"),
        F.right(F.get("_gap", i), F.lit(24)).alias("before"), F.left(F.get("_gap", i + 1), F.lit(1)).alias("after")))
    return rows.withColumn(out, spans).drop("_m", "_gap", "_len", "_before", "_from")


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(d), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))))
    return F.aggregate(each, F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0))) % 10 == 0


def small_parts(m: Column, by: str = r"\.") -> Column:
    """Whether all parts of a dotted number are at most 255."""
    def ok(x):
        x = F.regexp_replace(x, "^0+(?=.)", "")
        return (F.length(x) <= 3) & F.coalesce(F.substring(x, 1, 4).cast("int") <= 255, F.lit(False))
    return F.forall(F.split(m, by), ok)


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return small_parts(m)
    if kind == "card":
        d = digits(m)
        n = F.length(d)
        return F.when((n >= 14) & (n <= 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(m)).between(10, 15)
    return F.lit(True)


def described(kind: str, c: Column, base: Column) -> Column:
    """A proposal as (start, end, features..., label); the features are small integers."""
    m, d = c["m"], digits(c["m"])
    n = F.length(d)
    one, two, zero = F.lit(1), F.lit(2), F.lit(0)
    if kind == "email":
        top = F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1)
        check = F.when(top.rlike("^[A-Za-z]{2,6}$"), two).when(top.rlike("^[A-Za-z]"), one).otherwise(zero)
        separator = F.when(m.rlike(r"\x20"), two).when(m.rlike(r"[\[(]"), one).otherwise(zero)
        prefix, tail = F.when(F.contains(m, F.lit("@")), one).otherwise(zero), F.least(F.size(F.split(m, r"\.")), F.lit(4)) - 1
    else:
        if kind == "ip":
            check = F.when(small_parts(m, "[.,:]"), F.when(m.rlike(r"(^|[.,:])0[0-9]"), one).otherwise(two)).otherwise(zero)
        elif kind == "card":
            check = F.when(luhn(d), two).otherwise(zero)
        else:
            check = F.when(n.between(10, 11), two).when(n.between(12, 15), one).otherwise(zero)
        kinds = F.size(F.array_distinct(F.split(F.regexp_replace(m, "[0-9+]", ""), ""))) - 1
        separator = F.least(F.greatest(kinds, zero), two)
        prefix = F.when(F.startswith(m, F.lit("+")), two).when(F.startswith(m, F.lit("(")), one).otherwise(zero)
        tail = F.when(m.rlike(r"[^0-9][0-9]{4}$"), one).when(m.rlike(r"[^0-9][0-9]{1,3}$"), two).otherwise(zero)

    def edge(x):
        return F.when(F.coalesce(x, F.lit("")).rlike(r"^\s?$"), zero).when(x.rlike("[0-9A-Za-z]$"), one).otherwise(two)

    context = F.when(F.lower(c["before"]).rlike(CONTEXT[kind]), one).otherwise(zero)
    touches = F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    values = (F.lit(KINDS.index(kind)), check, separator, prefix, tail, edge(F.right(c["before"], F.lit(1))), edge(c["after"]), context)
    return F.struct(c["start"].alias("start"), c["end"].alias("end"),
                    *[v.cast("int").alias(f) for f, v in zip(FEATURES, values)], touches.alias("label"))


def _kept(kind: str) -> Column:
    return F.filter(f"_b_{kind}", lambda x: valid(kind, x["m"]))


def _tagged(kind: str) -> Column:
    i = KINDS.index(kind)
    return F.transform(f"_b_{kind}", lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("kind"), x["end"].alias("end")))


def _described(kind: str) -> Column:
    return F.transform(f"_w_{kind}", lambda x: described(kind, x, F.col(f"_b_{kind}")))


def spans_and_proposals(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` (start, kind, end) and ``proposals``."""
    rows = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    for kind in KINDS:
        rows = _with_matches(rows, BASE[kind], f"_b_{kind}", NEEDS.get(kind, ())[:1])
        rows = rows.withColumn(f"_b_{kind}", _kept(kind))
        rows = _with_matches(rows, WIDE[kind], f"_w_{kind}", NEEDS[kind] if kind == "email" else ())
    rows = rows.withColumn("base", F.sort_array(F.concat(*[_tagged(k) for k in KINDS])))
    wide = [_described(k) for k in KINDS]
    return rows.withColumn("proposals", F.concat(*wide)).drop("_text", *[f"_{t}_{k}" for t in "bw" for k in KINDS])


class Trees:
    """Boosted trees of depth two over integer features, logistic loss."""

    def __init__(self):
        self.start, self.trees, self.thresholds = 0.0, [], {}

    def score(self, x: dict) -> float:
        total = self.start
        for f, v, left, right in self.trees:
            g, w, low, high = left if x[f] <= v else right
            total += low if x[g] <= w else high
        return total

    def column(self, c: Column) -> Column:
        total = F.lit(self.start)
        for f, v, left, right in self.trees:
            side = [F.when(c[g] <= w, F.lit(low)).otherwise(F.lit(high)) for g, w, low, high in (left, right)]
            total = total + F.when(c[f] <= v, side[0]).otherwise(side[1])
        return total


def _best_split(cells, grad, hess):
    """The (feature, value) that lowers the loss most, with the leaf values."""
    def leaf(rows):
        g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        return g / (h + MIN_WEIGHT), g * g / (h + MIN_WEIGHT)

    rows = range(len(cells))
    best = None
    for f in LEARNED:
        for v in sorted({cells[i][f] for i in rows})[:-1]:
            low, high = [i for i in rows if cells[i][f] <= v], [i for i in rows if cells[i][f] > v]
            (a, ga), (b, gb) = leaf(low), leaf(high)
            if best is None or ga + gb > best[0] + 1e-9:
                best = (ga + gb, f, v, a, b)
    if best is None:
        a, _ = leaf(rows)
        return LEARNED[0], 1 << 30, a, a
    return best[1:]


def fit_trees(cells: list[dict]) -> Trees:
    """Trees from counted cells: feature values, n_pos and n_neg."""
    out = Trees()
    total = sum(c["n_pos"] + c["n_neg"] for c in cells)
    if not total:
        return out
    share = min(max(sum(c["n_pos"] for c in cells) / total, 1e-4), 1 - 1e-4)
    out.start = math.log(share / (1 - share))
    f = [out.start] * len(cells)
    for _ in range(ROUNDS):
        p = [1 / (1 + math.exp(-x)) for x in f]
        grad = [c["n_pos"] * (1 - q) - c["n_neg"] * q for c, q in zip(cells, p)]
        hess = [(c["n_pos"] + c["n_neg"]) * q * (1 - q) for c, q in zip(cells, p)]
        feature, v, _, _ = _best_split(cells, grad, hess)
        sides = []
        for keep in (lambda c: c[feature] <= v, lambda c: c[feature] > v):
            at = [i for i, c in enumerate(cells) if keep(c)]
            g, w, low, high = _best_split([cells[i] for i in at], [grad[i] for i in at], [hess[i] for i in at])
            clip = lambda x: min(max(RATE * x, -4.0), 4.0)
            sides.append((g, w, clip(low), clip(high)))
        tree = (feature, v, *sides)
        out.trees.append(tree)
        for i, c in enumerate(cells):
            g, w, low, high = tree[2] if c[feature] <= v else tree[3]
            f[i] += low if c[g] <= w else high
    return out


def calibrated(trees: Trees, cells: list[dict], posterior: float = POSTERIOR) -> dict[int, float]:
    """Per kind the score from which on a proposal is personal data with probability ``posterior``.

    The trees give the probability that a base rule labels a proposal; the
    mean of it over labelled proposals of the calibration cells estimates how
    often personal data is labelled at all, and the quotient of both is the
    probability of personal data (as in learning from positive and
    unlabelled cases).  A kind without labelled proposals adds none.
    """
    out = {}
    for kind in range(len(KINDS)):
        labelled = [(1 / (1 + math.exp(-trees.score(c))), c["n_pos"]) for c in cells if c["kind"] == kind and c["n_pos"]]
        if not labelled:
            out[kind] = math.inf
            continue
        often = sum(p * n for p, n in labelled) / sum(n for _, n in labelled)
        least = min(max(posterior * often, 1e-6), 1 - 1e-6)
        out[kind] = math.log(least / (1 - least))
    return out


def train(found: DataFrame) -> Trees:
    """Trees and thresholds from all proposals of ``found`` (id, proposals).

    Fold 3 calibrates, folds 0 and 1 are learned from, fold 2 is held out.
    """
    flat = found.select(fold().alias("fold"), F.explode("proposals").alias("p")).select("fold", "p.*")
    counted = flat.where("fold <> 2").withColumn("calibrate", F.col("fold") == 3).groupBy("calibrate", *FEATURES).agg(
        F.sum(F.col("label").cast("long")).alias("n_pos"), F.sum((~F.col("label")).cast("long")).alias("n_neg"))
    # one row per combination of feature values: at most 4 * 3 * 3 * 3 * 4 * 3 * 3 * 2
    rows = [r.asDict() for r in counted.orderBy("calibrate", *FEATURES).collect()]
    trees = fit_trees([r for r in rows if not r["calibrate"]])
    trees.thresholds = calibrated(trees, [r for r in rows if r["calibrate"]])
    return trees


def select(found: DataFrame, trees: Trees) -> DataFrame:
    """Add ``spans``: base spans and the selected proposals that touch none of them."""
    def chosen(c):
        enough = F.lit(False)
        for kind, least in trees.thresholds.items():
            if least < math.inf:
                enough = enough | ((c["kind"] == kind) & (trees.column(c) >= least - 1e-9))
        return enough & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    picked = F.transform(F.filter("proposals", lambda c: chosen(c)), lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    rows = found.withColumn("_added", F.sort_array(picked))
    # in order of their starts, each stays that begins behind the last one that stayed
    none = F.filter("_added", lambda c: F.lit(False))
    first = F.aggregate("_added", none, lambda kept, c: F.when(
        (F.size(kept) == 0) | (F.get(kept, F.size(kept) - 1)["end"] <= c["start"]), F.concat(kept, F.array(c))).otherwise(kept))
    return rows.withColumn("spans", F.sort_array(F.concat("base", first))).drop("_added")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


@apart("doc_id", "text")
def detect(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """``docs`` with ``base`` and ``spans``, arrays of (start, kind, end)."""
    found = spans_and_proposals(docs)
    if trees is None:
        found = stored(found, "pii")
        trees = train(found)
    return select(found, trees).drop("proposals")


@apart("doc_id", "text")
def redact(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets."""
    rows = detect(docs, trees)
    # spans inside or behind an earlier one merge into it
    merged = F.filter("spans", lambda s: ~F.exists("spans", lambda o: (o < s) & (o["end"] > s["start"])))
    rows = rows.withColumn("_cut", merged).withColumn("_chars", F.when(F.size("spans") > 0, F.split("text", "")))
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("_cut", lambda s: F.array_max(F.transform(
        F.filter("spans", lambda o: (o["start"] >= s["start"]) & (o["start"] < s["end"])), lambda o: o["end"]))))
    rows = rows.withColumn("_ends", ends)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    parts = F.zip_with("_cut", F.slice("_ends", 1, F.size("_cut")), lambda s, at: F.concat(
        F.array_join(F.slice("_chars", (at + 1).cast("int"), (s["start"] - at).cast("int")), ""), F.get(names, s["kind"])))
    rest = F.array_join(F.slice("_chars", (F.element_at("_ends", -1) + 1).cast("int"), F.greatest(F.size("_chars"), F.lit(0))), "")
    text = F.when(F.size("spans") > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(F.col("text"))
    return rows.withColumn("text", text).drop("_cut", "_chars", "_ends")


def _is(value: int):
    return lambda x: x == value


def op3_boosted_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = stored(spans_and_proposals(docs).drop("text"), "pii")
    out = select(found, train(found))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(F.transform(kinds, _is(i)), False)).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      listed(F.col("spans")).alias("spans"))
