"""Quality scores by positive-unlabelled learning.

Trusted positives are documents labelled as good; everything else in the
corpus is unlabelled text, a mixture of good and bad.  A small network is
trained by minimising the non-negative unbiased risk

    prior * E_P[loss(f, +)] + max(0, E_U[loss(f, -)] - prior * E_P[loss(f, -)])

with logistic loss.  The class prior is estimated from the same two samples:
a first network separates positives from unlabelled text on one half, and on
the other half the prior is the smallest ratio of the share of unlabelled to
the share of positive documents above a score.  Negative labels are never
learned from.

Scores use shape features of the whole text, no labels, language, source or
id.  The two training samples are bounded by ``SAMPLE`` documents each,
chosen by record hash from the rows that may be learned from.

Edge cases: NULL and empty texts have all-zero features and a score like any
other text; without any positive label every score is 0.5; repeated rows are
scored alike; an empty table gives an empty result; extra columns pass
through, clashing ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import apart, held_out, learnable, shipped, small_batches, strings, table, unpacked

THRESHOLD = 0.7
SAMPLE = 3000
HIDDEN = 16
STEPS, BATCH = 600, 256
FEATURES = 18

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_KIND = np.zeros(256, np.int64)  # classes of bytes, counted once per text
for _i, _set in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\v\f\r",
                           b".,;:", b"!?", b"#*$%&", b"|<>{}[]\\/~^_=+@", b"'\"()-`"), 1):
    for _c in _set:
        _KIND[_c] = _i
_KIND[0x80:] = 10


def features(text: str | None) -> np.ndarray:
    """Shape of a text: shares of kinds of characters, of repeated words and lines, sizes."""
    out = np.zeros(FEATURES)
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return out
    n = len(raw)
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=kinds, minlength=11)
    ink = max(n - kinds[4], 1)
    out[:9] = kinds[[1, 2, 3, 5, 6, 7, 8, 9, 10]] / ink
    k = len(words)
    out[9] = min(ink / k, 30) / 10
    out[10] = len(set(words)) / k ** 0.8
    out[11] = sum(map(bytes.__eq__, words, words[1:])) / k
    out[12] = sum(map(bytes.isupper, words)) / k
    lines = [x for x in raw.split(b"\n") if x.strip()]
    out[13] = 1 - len(set(lines)) / len(lines)
    out[14] = min(k / len(lines), 200) / 50
    out[15] = np.log1p(k) / 5
    out[16] = sum(w[-1] in b"!#*$%&" for w in words) / k
    out[17] = kinds[5] / k
    return out


class Net:
    """One hidden layer on standardised features; ``logit`` is the log-odds of good."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {"A": rng.normal(0, 0.4, (FEATURES, HIDDEN)), "a": np.zeros(HIDDEN),
                  "B": rng.normal(0, 0.4, HIDDEN), "b": np.zeros(1)}

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.p["A"] + self.p["a"]) @ self.p["B"] + self.p["b"][0]

    def fit(self, pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = STEPS, seed: int = 4) -> None:
        rng = np.random.default_rng(seed)
        both = np.vstack((pos, unl))
        self.mean, self.scale = both.mean(axis=0), both.std(axis=0) + 1e-3
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for step in range(1, steps + 1):
            x = np.vstack((pos[rng.integers(0, len(pos), BATCH)], unl[rng.integers(0, len(unl), BATCH)]))
            z = np.clip((x - self.mean) / self.scale, -8, 8)
            h = np.tanh(z @ self.p["A"] + self.p["a"])
            f = h @ self.p["B"] + self.p["b"][0]
            s = 1 / (1 + np.exp(-f))
            sp, su = s[:BATCH], s[BATCH:]
            # derivatives of log(1 + e^-f) and log(1 + e^f)
            negative = np.logaddexp(0, f[BATCH:]).mean() - prior * np.logaddexp(0, f[:BATCH]).mean()
            df = np.empty(2 * BATCH)
            if negative >= 0:
                df[:BATCH] = prior * (sp - 1) - prior * sp
                df[BATCH:] = su
            else:  # the unbiased estimate went below zero: climb back
                df[:BATCH] = prior * sp
                df[BATCH:] = -su
            df /= BATCH
            dh = np.outer(df, self.p["B"]) * (1 - h * h)
            g = {"B": h.T @ df, "b": df.sum(keepdims=True), "A": z.T @ dh, "a": dh.sum(axis=0)}
            rate = 0.02 * (1 - 0.9 * step / steps)
            for k, d in g.items():
                d = d + 1e-4 * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)

    def calibrate(self, pos: np.ndarray, unl: np.ndarray, prior: float) -> None:
        """Map log-odds to posteriors: prior * density of positives / density of unlabelled.

        The ratio is fitted by isotonic regression of positive against
        unlabelled over the log-odds and interpolated between its steps.
        """
        f = np.concatenate((self.logit(pos), self.logit(unl)))
        y = np.concatenate((np.full(len(pos), 1 / len(pos)), np.zeros(len(unl))))
        w = np.concatenate((np.full(len(pos), 1 / len(pos)), np.full(len(unl), 1 / len(unl))))
        steps: list[list[float]] = []  # sum of w, of w * f, of positives
        for i in np.argsort(f, kind="stable"):
            steps.append([w[i], w[i] * f[i], y[i]])
            while len(steps) > 1 and steps[-2][2] * steps[-1][0] >= steps[-1][2] * steps[-2][0]:
                last = steps.pop()
                steps[-1] = [a + b for a, b in zip(steps[-1], last)]
        a = np.array(steps)
        # one standard deviation up: a step of few positives does not reject
        good = a[:, 2] + np.sqrt(a[:, 2] / len(pos))
        self.at = a[:, 1] / a[:, 0]
        self.posterior = np.minimum(1.0, prior * good / np.maximum(a[:, 0] - a[:, 2], 1e-9))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of good; a small share of the log-odds orders equal posteriors."""
        f = self.logit(x)
        plain = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
        return 0.95 * np.interp(f, self.at, self.posterior) + 0.05 * plain


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives among the unlabelled, by the best bin of a held-back half."""
    net = Net(seed=8)
    net.fit(pos[::2], unl[::2], 0.5, steps=STEPS // 2)
    sp, su = np.sort(net.logit(pos[1::2])), np.sort(net.logit(unl[1::2]))
    best = 1.0
    for q in np.linspace(0.02, 0.5, 40):
        cut = np.quantile(sp, q)
        p = 1 - np.searchsorted(sp, cut) / len(sp)
        u = 1 - np.searchsorted(su, cut) / len(su)
        # upper ends of the shares' confidence bands: the smallest of many ratios would be too low
        u += 2 * np.sqrt(u * (1 - u) / len(su))
        p -= 2 * np.sqrt(p * (1 - p) / len(sp))
        best = min(best, u / max(p, 1e-9))
    return float(min(max(best, 0.05), 0.98))


FEATURE_TYPE = T.ArrayType(T.DoubleType())


@F.pandas_udf(FEATURE_TYPE)
def _features(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([features(t) for t in strings(batch)])


def _draw(rows: DataFrame, total: int, size: int, seed: int) -> np.ndarray:
    """Features of about ``size`` rows, at most that many, chosen by record hash."""
    u = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    few = rows.withColumn("_u", u).where(F.col("_u") < min(1.0, 1.3 * size / max(total, 1)))
    # features are hashed into an order too, so that equal draws end in the same rows
    few = few.select("_u", _features("text").alias("x")).orderBy("_u", "x").limit(size)
    return np.array([r.x for r in few.collect()]).reshape(-1, FEATURES)


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Net | None:
    """The network learned from positives of ``labels`` and unlabelled ``docs``."""
    small_batches(docs.sparkSession)
    rows = docs.where(learnable()).select("doc_id", "text")
    good = labels.where((F.col("quality") == 1) & learnable()).select("doc_id").distinct()
    n_good, n_rows = good.count(), rows.count()
    if not n_good or not n_rows:
        return None
    # thin out the labels before they meet the texts
    u = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 40)) / float(1 << 40)
    good = good.where(u < min(1.0, 1.3 * size / n_good)).orderBy(u, "doc_id").limit(size)
    ids = [r.doc_id for r in good.collect()]  # at most ``size`` ids
    pos = rows.where(F.col("doc_id").isin(ids)).select(F.xxhash64("doc_id", "text").alias("_u"), _features("text").alias("x"))
    pos = np.array([r.x for r in pos.orderBy("_u", "x").limit(size).collect()]).reshape(-1, FEATURES)
    unl = _draw(rows, n_rows, size, 2)
    if not len(pos) or not len(unl):
        return None
    net = Net()
    prior = estimate_prior(pos, unl) if min(len(pos), len(unl)) >= 20 else 0.5
    net.fit(pos, unl, prior)
    net.calibrate(pos, unl, prior)
    return net


def scorer(spark: SparkSession, net: Net | None):
    shared = shipped(spark, net)

    @F.pandas_udf(T.DoubleType())
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = unpacked(shared)
        for batch in texts:
            batch = strings(batch)
            yield pd.Series(net.scores(np.array([features(t) for t in batch]).reshape(-1, FEATURES)) if net else np.full(len(batch), 0.5))

    return score


@apart("doc_id", "text")
def score_quality(docs: DataFrame, net: Net | None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted."""
    spark = docs.sparkSession
    small_batches(spark)
    out = docs.withColumn("score", scorer(spark, net)("text"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = train(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, net).select("doc_id", held_out().alias("held_out"), "score", "predicted")
