"""Language identification with a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are read in segments of ``SEGMENT`` bytes; every byte
of the whole text lies in exactly one.  Two GRUs, one in each direction,
label every position with language probabilities, and a document's
probabilities are the mean over its letter positions.  The network is
trained in numpy by backpropagation through time with Adam.

Training reads a bounded sample: ``PER_LANG`` documents of each language,
chosen by hash among the rows that may be learned from, one window of
``WINDOW`` characters each, for at most ``MAX_LANGS`` languages.  Prediction
covers every byte of every text.

The filter rejects what the network has not learned.  A fifth of the labelled
rows, by text hash, is kept from learning; on documents of these that are
predicted rightly, a sure score of each language is set, and the least
familiarity: the mean log probability of a text's letter pairs, as bytes, in
the learned languages together.  The limits lie well below nearly all of
these documents; texts below the sure score, as mixed and short ones are, must
be the more familiar to stay.

Edge cases: NULL text and text without a letter give ``und`` with score 0;
rows without a language are never learned from; without any labelled row
every document is ``und``; an empty table gives an empty result; extra
columns pass through, clashing ones are replaced.
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

UND = "und"
HIDDEN = 8  # per direction
SEGMENT = 128
ROWS_AT_ONCE = 4096
PER_LANG = 300
MAX_LANGS = 200
WINDOW = 400
STEPS, BATCH, LENGTH = 260, 192, 64
MIN_SCORE = 0.0  # besides the calibrated limits, the filter rejects what is below
CALIBRATE = 200  # windows of each language
NEARLY_ALL, ENOUGH = 0.995, 50  # fewer windows than ENOUGH: the limit of all languages together
SCORE_SLACK, UNSURE_SLACK, SURE_SLACK = 1, 2.5, 5  # how far below, in distances from the median to the NEARLY_ALL point
UNSEEN, SHORT = 1e-7, 20  # weight of a pair not seen; pairs at the median added to every text

_HAS_LETTER = re.compile(r"[^\W\d_]")
_IS_LETTER = np.zeros(256, np.float32)
_IS_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1


def _half(x: np.ndarray) -> np.ndarray:
    """Logistic function through tanh, in place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class BiGru:
    """Weights: per direction the byte table X (256 x 3H), U (H x 3H); output W, b."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden
        self.p = {}
        for d in "fb":
            self.p["X" + d] = rng.normal(0, 0.5, (256, 3 * hidden)).astype(np.float32)
            self.p["U" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)
        self.p["W"] = rng.normal(0, 0.3, (2 * hidden, len(langs))).astype(np.float32)
        self.p["b"] = np.zeros(len(langs), np.float32)
        self.pairs: np.ndarray | None = None  # log probabilities of byte pairs, once calibrated
        self.typical, self.familiar, self.sure = 0.0, (-np.inf, -np.inf), np.zeros(len(langs))

    def states(self, codes: np.ndarray, active: np.ndarray, d: str, tape: list | None = None) -> np.ndarray:
        """Hidden states (T x B x H).  ``codes`` T x B; ``active[t]`` sequences have a byte t."""
        steps, n = codes.shape
        h_ = self.hidden
        X, U = self.p["X" + d], self.p["U" + d]
        out = np.zeros((steps, n, h_), np.float32)
        h = np.zeros((n, h_), np.float32)
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            k = active[t]
            prev = h[:k]
            gate = X[codes[t, :k]]
            hu = prev @ U
            zr = _half(gate[:, :2 * h_] + hu[:, :2 * h_])
            z, r = zr[:, :h_], zr[:, h_:]
            hun = hu[:, 2 * h_:]
            new = np.tanh(gate[:, 2 * h_:] + r * hun)
            nxt = new + z * (prev - new)
            if tape is not None:
                tape.append((t, k, prev.copy(), z, r, hun, new))
            h[:k] = nxt
            out[t, :k] = nxt
        return out

    def probabilities(self, codes: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Language probabilities of every position (T x B x L)."""
        h_ = self.hidden
        W = self.p["W"]
        logits = self.states(codes, active, "f") @ W[:h_]
        logits += self.states(codes, active, "b") @ W[h_:]
        logits += self.p["b"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients of the mean cross-entropy over all positions."""
        steps, n = codes.shape
        h_ = self.hidden
        active = np.full(steps, n)
        tapes = {"f": [], "b": []}
        hs = {d: self.states(codes, active, d, tapes[d]) for d in "fb"}
        both = np.concatenate((hs["f"], hs["b"]), axis=2)
        logits = both @ self.p["W"] + self.p["b"]
        logits -= logits.max(axis=2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=2, keepdims=True)
        picked = prob[:, np.arange(n), labels]
        loss = float(-np.log(np.maximum(picked, 1e-9)).mean())
        prob[:, np.arange(n), labels] -= 1
        prob /= steps * n
        g = {"W": both.reshape(-1, 2 * h_).T @ prob.reshape(-1, prob.shape[2]), "b": prob.sum(axis=(0, 1))}
        back = prob @ self.p["W"].T
        for i, d in enumerate("fb"):
            U = self.p["U" + d]
            gX, gU = np.zeros_like(self.p["X" + d]), np.zeros_like(U)
            carry = np.zeros((n, h_), np.float32)
            flat = np.empty((steps, n, 3 * h_), np.float32)
            for t, _, prev, z, r, hun, new in reversed(tapes[d]):
                dh = carry + back[t, :, i * h_:(i + 1) * h_]
                dn = dh * (1 - z) * (1 - new * new)
                dz = dh * (prev - new) * z * (1 - z)
                dr = dn * hun * r * (1 - r)
                da = np.concatenate((dz, dr, dn * r), axis=1)  # through U
                gU += prev.T @ da
                carry = dh * z + da @ U.T
                flat[t, :, :2 * h_] = da[:, :2 * h_]
                flat[t, :, 2 * h_:] = dn
            np.add.at(gX, codes.ravel(), flat.reshape(-1, 3 * h_))
            g["X" + d], g["U" + d] = gX, gU
        return loss, g

    def fit(self, texts: dict[str, list[bytes]], steps: int = STEPS, batch: int = BATCH, length: int = LENGTH, seed: int = 5) -> None:
        """Adam over windows of the texts, languages in equal shares."""
        rng = np.random.default_rng(seed)
        pools = [[t for t in texts[lang] if t] for lang in self.langs]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for step in range(1, steps + 1):
            labels = rng.integers(0, len(self.langs), batch)
            codes = np.full((length, batch), 0x20, np.uint8)
            for j, lab in enumerate(labels):
                raw = pools[lab][rng.integers(len(pools[lab]))]
                at = rng.integers(0, max(len(raw) - length, 0) + 1)
                piece = np.frombuffer(raw[at:at + length], np.uint8)
                codes[:len(piece), j] = piece
            _, g = self.gradients(codes, labels)
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            scale = min(1.0, 1.0 / max(norm, 1e-9))
            rate = 0.03 * (1 - 0.9 * step / steps)
            for k, x in g.items():
                x = x * scale
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def documents(self, raws: list[bytes]) -> np.ndarray:
        """Mean letter-position probabilities of each document (n x L)."""
        lengths = np.array([len(r) for r in raws], np.int64)
        total = np.zeros((len(raws), len(self.langs)))
        weight = np.zeros(len(raws))
        joined = np.frombuffer(b"".join(raws), np.uint8)
        start = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        owner = np.repeat(np.arange(len(raws)), -(-lengths // SEGMENT))
        if not len(owner):
            return total
        first = np.concatenate(([0], np.cumsum(-(-lengths // SEGMENT))))[:-1]
        seg = np.arange(len(owner)) - first[owner]
        begin = start[owner] + seg * SEGMENT
        size = np.minimum(SEGMENT, lengths[owner] - seg * SEGMENT)
        order = np.argsort(-size, kind="stable")
        for at in range(0, len(order), ROWS_AT_ONCE):
            pick = order[at:at + ROWS_AT_ONCE]
            longest = int(size[pick[0]])
            where = begin[pick][None, :] + np.arange(longest)[:, None]
            here = np.arange(longest)[:, None] < size[pick][None, :]
            codes = np.where(here, joined[np.minimum(where, len(joined) - 1)], 0x20).astype(np.uint8)
            prob = self.probabilities(codes, here.sum(axis=1))
            mask = _IS_LETTER[codes]
            np.add.at(total, owner[pick], np.einsum("tbl,tb->bl", prob, mask))
            np.add.at(weight, owner[pick], mask.sum(axis=0))
        return total / np.maximum(weight, 1)[:, None]


    def familiarity(self, raws: list[bytes]) -> np.ndarray:
        """Mean log probability of each document's letter pairs, case ignored."""
        out = np.empty(len(raws))
        for i, raw in enumerate(raws):
            at = _pairs(raw)
            out[i] = (self.pairs[at].sum() + SHORT * self.typical) / (len(at) + SHORT)
        return out

    def known(self, raws: list[bytes], prob: np.ndarray) -> np.ndarray:
        """Whether each document, of probabilities ``prob``, is in a learned language."""
        if self.pairs is None:
            return np.ones(len(raws), bool)
        sure = prob.max(axis=1) >= self.sure[prob.argmax(axis=1)]
        return self.familiarity(raws) >= np.where(sure, self.familiar[1], self.familiar[0])

    def calibrate(self, learned: dict[str, list[bytes]], spare: dict[str, list[bytes]]) -> None:
        """Set the limits of ``known`` by documents the network did not learn from."""
        held = [(i, raw) for i, lang in enumerate(self.langs) for raw in spare.get(lang, [])]
        if not held:
            return
        labels, raws = np.array([i for i, _ in held]), [raw for _, raw in held]
        prob = self.documents(raws)
        right = prob.argmax(axis=1) == labels
        if not right.any():
            return
        seen = np.zeros(1 << 16)
        for texts in learned.values():
            counts = sum(np.bincount(_pairs(t), minlength=1 << 16) for t in texts)
            seen += counts / max(counts.sum(), 1) / len(learned)
        seen = seen.reshape(256, 256) + UNSEEN
        self.pairs = np.log(seen / seen.sum(axis=1, keepdims=True)).ravel().astype(np.float32)
        raws = [raw for raw, ok in zip(raws, right) if ok]
        self.typical = float(np.median([self.pairs[_pairs(raw)].mean() for raw in raws]))
        like = self.familiarity(raws)
        self.familiar = (_limit(like, UNSURE_SLACK), _limit(like, SURE_SLACK))
        best, labels = prob.max(axis=1)[right], labels[right]
        of = [best[labels == i] for i in range(len(self.langs))]
        self.sure = np.array([_limit(x if len(x) >= ENOUGH else best, SCORE_SLACK) for x in of])


def _pairs(raw: bytes) -> np.ndarray:
    """Numbers of the byte pairs of a text that hold a letter; other bytes count as a space."""
    codes = np.frombuffer(raw.decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass"), np.uint8)
    codes = np.concatenate(([0x20], np.where(_IS_LETTER[codes] > 0, codes, 0x20), [0x20]))
    at = codes[:-1] * 256 + codes[1:]
    return at[at != 0x2020]


def _limit(values: np.ndarray, slack: float) -> float:
    """A value well below nearly all of ``values``."""
    low = np.quantile(values, 1 - NEARLY_ALL, method="lower")
    return float(low - slack * (np.median(values) - low))


def sample(docs: DataFrame, per_lang: int = PER_LANG, max_langs: int = MAX_LANGS, spare: bool | None = None) -> dict[str, list[bytes]]:
    """At most ``per_lang`` windows of each language, chosen by record hash.

    ``spare``: only of the rows kept for calibration (True), or of the others (False).
    """
    rows = docs.where(F.col("lang").isNotNull() & learnable())
    if spare is not None:
        kept = F.coalesce(F.pmod(F.xxhash64("text", F.lit("spare")), F.lit(5)) == 0, F.lit(False))
        rows = rows.where(kept if spare else ~kept)
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()
    if not counts:
        return {}
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    rate = F.coalesce(*[F.when(F.col("lang") == c["lang"], F.lit(min(1.0, 1.5 * per_lang / c["count"]))) for c in counts])
    at = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1) + 1
    picked = rows.where("text IS NOT NULL").withColumn("u", draw).where(F.col("u") < rate).select(
        "lang", "u", F.substr(F.col("text"), at.cast("int"), F.lit(WINDOW)).alias("t"))
    out: dict[str, list[bytes]] = {}
    for r in picked.orderBy("u", "lang", "t").limit(2 * per_lang * len(counts)).collect():
        got = out.setdefault(r.lang, [])
        if len(got) < per_lang and _HAS_LETTER.search(r.t):
            got.append(r.t.encode("utf-8", "surrogatepass"))
    return {k: v for k, v in sorted(out.items()) if v}


def train(docs: DataFrame, **params) -> BiGru | None:
    texts = sample(docs)
    if not texts:
        return None
    net = BiGru(list(texts))
    net.fit(texts, **params)
    return net


def train_filter(docs: DataFrame, **params) -> BiGru | None:
    """A network with calibrated limits, for ``recognised``."""
    texts, spare = sample(docs, spare=False), sample(docs, CALIBRATE, spare=True)
    for lang in set(spare) - set(texts):  # too few rows to keep any from learning
        texts[lang] = spare.pop(lang)
    if not texts:
        return None
    net = BiGru(sorted(texts))
    net.fit(texts, **params)
    net.calibrate(texts, spare)
    return net


PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                          T.StructField("known", T.BooleanType())])


def predictor(spark: SparkSession, net: BiGru | None):
    """A column function text -> (lang_pred, score, known)."""
    shared = shipped(spark, net)

    @F.pandas_udf(PREDICTED)
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        net = unpacked(shared)
        for batch in texts:
            batch = strings(batch)
            use = [i for i, t in enumerate(batch) if net is not None and t and _HAS_LETTER.search(t)]
            pred, score, known = [UND] * len(batch), np.zeros(len(batch)), np.zeros(len(batch), bool)
            if use:
                raws = [batch[i].encode("utf-8", "surrogatepass") for i in use]
                prob = net.documents(raws)
                known[use] = net.known(raws, prob)
                best = prob.argmax(axis=1)
                for i, b, row in zip(use, best, prob):
                    pred[i], score[i] = net.langs[b], min(float(row[b]), 1.0)
            yield pd.DataFrame({"lang_pred": pred, "score": score, "known": known})

    return predict


def _predicted(docs: DataFrame, net: BiGru | None) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    return docs.withColumn("_lang", predictor(spark, net)("text"))


@apart("doc_id", "text")
def identify(docs: DataFrame, net: BiGru | None) -> DataFrame:
    """``docs`` with lang_pred and score."""
    out = _predicted(docs, net)
    return out.withColumns({"lang_pred": F.col("_lang.lang_pred"), "score": F.col("_lang.score")}).drop("_lang")


def recognised(docs: DataFrame, net: BiGru | None, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` in a language ``net`` knows: within its limits, and at least ``min_score`` sure."""
    whole = _predicted(docs.select(F.struct(*docs.columns).alias("_row"), "text"), net)
    return whole.where(F.col("_lang.known") & (F.col("_lang.score") >= min_score)).select("_row.*")


def op1_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
