"""Quality classifier by positive-unlabelled learning.

Only trusted positives are learned from: documents labelled good. All other
text counts as an unlabelled mixture. A logistic scorer over features of the
whole text minimises the non-negative unbiased risk

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])

(Kiryo et al., 2017). The class prior is estimated from the two samples alone:
a first scorer tells positives from the mixture, and the prior is the smallest
ratio of the mixture's to the positives' share above a score (best bin
estimation, Garg et al., 2021).

The text is read once, for its features; the risk, its gradient and its
curvature are sums over all rows of that narrow table, a few numbers per task
that Spark adds up, so that nothing is sampled and the driver holds only the
model. With the logistic loss the unbiased risk is convex: Newton steps with
a line search on the non-negative risk find its minimum in a few passes.

Defined results: null text counts as empty; an empty text has all features 0
and gets the score of that point; a document with contradicting labels is no
positive; a null id is neither held out nor labelled. Without any
positive in the training rows every score is the given ``fallback``.
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import ship, stage

#: Byte classes: 1 exclamation or question, 2 ornament, 3 bar, 4 digit,
#: 5 full stop, 6 comma and the like, 7 capital, 8 white space, 9 beyond ASCII.
_CLASS = np.zeros(256, np.int64)
for _n, _set in enumerate(["!?", "*#%&$@^~_=<>{}[]\\+", "|", "0123456789", ".", ",;:'\"()-",
                           "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "\t\n\r "], 1):
    for _c in _set:
        _CLASS[ord(_c)] = _n
_CLASS[128:] = 9
RAW = 20
#: Each ratio x also enters as min(x, knot) / knot for these knots.
KNOTS = (0.02, 0.1, 0.4)
DIM = 1 + RAW * (1 + len(KNOTS))


def features(text: str | None) -> np.ndarray:
    """Ratios in 0..1 that describe the whole text; all 0 if it has no word."""
    out = np.zeros(RAW)
    words = (text or "").split()
    n = len(words)
    if not n:
        return out
    lines = [x for x in text.split("\n") if x.strip()]
    c = np.bincount(_CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=10)
    size = c.sum()
    kinds = set(words)
    out[0] = 1 - len(kinds) / n
    out[1] = sum(map(eq, words, words[1:])) / n
    out[2] = sum(map(eq, words, words[2:])) / n
    out[3] = sum(map(str.isupper, words)) / n
    out[4] = min(1.0, c[1] / n)
    out[5] = min(1.0, c[2] / n)
    out[6] = min(1.0, c[3] / n)
    out[7] = c[4] / size
    out[8] = min(1.0, c[5] / n)
    out[9] = min(1.0, c[6] / n)
    out[10] = c[7] / size
    out[11] = c[8] / size
    out[12] = c[9] / size
    out[13] = 1 - len(set(lines)) / max(1, len(lines))
    out[14] = min(1.0, len(lines) / n)
    out[15] = min(1.0, (size - c[8]) / n / 20)  # mean length of a word
    out[16] = min(1.0, math.log1p(n) / 12)
    out[17] = sum(map(str.islower, words)) / n
    out[18] = sum(1 for w in words if len(w) <= 3) / n
    out[19] = sum(map(str.istitle, words)) / n
    return out


def expanded(raw: np.ndarray) -> np.ndarray:
    """Design matrix of raw features (rows): 1, each ratio and its knots."""
    raw = raw.astype(np.float64)
    return np.concatenate([np.ones((len(raw), 1)), raw] + [np.minimum(raw, k) / k for k in KNOTS], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, RAW)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """The rows that are never learned from: crc32 of the id's text mod folds is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def feature_table(docs: DataFrame, labels: DataFrame, folds: int) -> DataFrame:
    """doc_id, held_out, positive, f (features as 32-bit floats), staged."""
    ship(docs.sparkSession)

    def task(batches):
        for b in batches:
            f = [features(t).astype("<f4").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(f, pa.binary())], ["doc_id", "f"])

    found = stage(docs.select("doc_id", "text").mapInArrow(task, "doc_id long, f binary"))
    trusted = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"))
               .where("q = 1").select("doc_id", F.lit(True).alias("trusted")))
    found = found.withColumn("held_out", held_out(F.col("doc_id"), folds))
    return stage(found.join(trusted, "doc_id", "left").select(
        "doc_id", "held_out", (F.coalesce("trusted", F.lit(False)) & ~F.col("held_out")).alias("positive"), "f"))


def _sums(table: DataFrame, per_batch, size: int) -> np.ndarray:
    """Add up ``per_batch(x, positive) -> vector of size`` over the training rows."""
    def task(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += per_batch(expanded(_matrix(b.column(0))), np.asarray(b.column(1).to_pylist(), bool))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "v"])

    rows = table.where("not held_out").select("f", "positive").mapInArrow(task, "i long, v double")
    out = np.zeros(size)
    for i, v in rows.groupBy("i").agg(F.sum("v").alias("v")).collect():  # one row per entry of the sum
        out[i] = v
    return out


class Risk:
    """Sums over the training rows of a feature table. ``prior`` None is the
    plain logistic risk of positives against the mixture."""

    def __init__(self, table: DataFrame, ridge: float):
        self.table, self.ridge = table, ridge
        self.n_p, self.n_u = _sums(table, lambda x, p: np.array([p.sum(), len(p)], float), 2)

    def value(self, ws: list[np.ndarray], prior: float | None) -> np.ndarray:
        stack = np.stack(ws, 1)

        def part(x, p):
            z = x @ stack
            up = _softplus(z)
            return np.concatenate([up[p].sum(0), (up - z)[p].sum(0), up.sum(0)])

        neg_p, pos_p, neg_u = _sums(self.table, part, 3 * len(ws)).reshape(3, -1)
        neg_p, pos_p, neg_u = neg_p / self.n_p, pos_p / self.n_p, neg_u / self.n_u
        risk = pos_p + neg_u if prior is None else prior * pos_p + np.maximum(0.0, neg_u - prior * neg_p)
        return risk + self.ridge / 2 * np.array([(w[1:] ** 2).sum() for w in ws])

    def step(self, w: np.ndarray, prior: float | None) -> np.ndarray:
        """Newton direction of the (convex) unbiased risk."""
        d = len(w)

        def part(x, p):
            z = x @ w
            s, c = _sigmoid(z), _sigmoid(z) * (1 - _sigmoid(z))
            out = [x[p].sum(0), (s[p, None] * x[p]).sum(0), (s[:, None] * x).sum(0),
                   ((x[p] * c[p, None]).T @ x[p]).ravel(), ((x * c[:, None]).T @ x).ravel()]
            return np.concatenate(out)

        got = _sums(self.table, part, 3 * d + 2 * d * d)
        xp, sp, su = got[:3 * d].reshape(3, d)
        hp, hu = got[3 * d:].reshape(2, d, d)
        if prior is None:
            grad, hess = (sp - xp) / self.n_p + su / self.n_u, hp / self.n_p + hu / self.n_u
        else:  # loss(+) - loss(-) = -z, so the positives' curvature cancels
            grad, hess = su / self.n_u - prior * xp / self.n_p, hu / self.n_u
        keep = np.r_[0.0, np.full(d - 1, self.ridge)]
        return -np.linalg.solve(hess + np.diag(keep + 1e-9), grad + keep * w)

    def minimise(self, prior: float | None, steps: int, tolerance: float = 1e-5) -> np.ndarray:
        w = np.zeros(DIM)
        risk = self.value([w], prior)[0]
        for _ in range(steps):
            direction = self.step(w, prior)
            tries = [w + direction * 0.5 ** k for k in range(6)]
            risks = self.value(tries, prior)
            best = int(np.argmin(risks))
            if not risks[best] < risk - tolerance:
                break
            w, risk = tries[best], risks[best]
        return w


def estimate_prior(table: DataFrame, w: np.ndarray, n_p: float, n_u: float, bins: int = 400) -> float:
    """Best bin estimate of the share of positives in the mixture."""
    def part(x, p):
        at = np.minimum((_sigmoid(x @ w) * bins).astype(int), bins - 1)
        return np.concatenate([np.bincount(at[p], minlength=bins), np.bincount(at, minlength=bins)]).astype(float)

    got = _sums(table, part, 2 * bins).reshape(2, bins)
    above_p = got[0][::-1].cumsum() / n_p
    above_u = got[1][::-1].cumsum() / n_u
    slack = math.sqrt(math.log(40.0) / 2 / n_p) + math.sqrt(math.log(40.0) / 2 / n_u)
    fair = above_p > 0
    bound = np.full(bins, np.inf)
    bound[fair] = (above_u[fair] + slack) / above_p[fair]
    best = int(np.argmin(bound))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


class Model:
    def __init__(self, weights: np.ndarray | None, prior: float, fallback: float = 1.0):
        self.weights, self.prior, self.fallback = weights, prior, fallback

    def score(self, raw: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(raw), self.fallback)
        return _sigmoid(expanded(raw) @ self.weights)


def fit(table: DataFrame, ridge: float = 1e-3, steps: int = 12, fallback: float = 1.0) -> Model:
    """Estimate the prior, then minimise the non-negative risk."""
    risk = Risk(table, ridge)
    if not risk.n_p:
        return Model(None, 0.0, fallback)
    prior = estimate_prior(table, risk.minimise(None, steps), risk.n_p, risk.n_u)
    return Model(risk.minimise(prior, steps), prior, fallback)


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    table = feature_table(docs, labels, folds)
    model = fit(table)

    def task(batches):
        for b in batches:
            s = model.score(_matrix(b.column(2)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s)], ["doc_id", "held_out", "score"])

    scored = table.select("doc_id", "held_out", "f").mapInArrow(task, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5) -> DataFrame:
    """The documents whose score reaches the threshold."""
    model = fit(feature_table(docs, labels, folds))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([features(t) for t in texts], "<f4").reshape(-1, RAW)))

    return docs.where(scored("text") >= threshold)
