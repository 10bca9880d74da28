"""Per-customer attribution of boosted-tree scores.

Exact Shapley values of the margin under the trees' own cover weights (a feature
left out follows both branches in proportion to the fitted rows). For one leaf
the other features only matter through a product over the path, so no subsets
are enumerated: with z the share of cover that a path feature lets through and o
whether the row passes it (0 or 1), the value of feature j is

    leaf * (o_j - z_j) * integral over t in 0..1 of prod_{i != j} (z_i (1 - t) + o_i t)

since the integral of t^k (1 - t)^(d-1-k) is Shapley's weight of a set of size k.
The integrand is a polynomial of degree d - 1, which Gauss-Legendre quadrature with
d/2 nodes integrates exactly. Rows that pass the same features of a path share
their values, so each pattern is worked out once a batch.

Scoring is a narrow pass over Arrow batches; the trees travel with the task (a
bounded model). Global importance adds up in every task, one row a feature.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.operators.boost import Booster, Tree, inputs, matrix
from cauce.session import ship


@lru_cache(maxsize=64)
def _quadrature(degree: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and weights on 0..1 that are exact up to ``degree``."""
    x, w = np.polynomial.legendre.leggauss(degree // 2 + 1)
    return (x + 1) / 2, w / 2


def paths(tree: Tree) -> list[tuple]:
    """(leaf value, features, least, most, had a right turn, cover shares) of
    every leaf: a feature that is asked several times counts once, with the
    interval its questions leave open."""
    out = []
    stack: list = [(0, {})]
    while stack:
        node, asked = stack.pop()
        f = int(tree.feature[node])
        if f < 0:
            parts = list(asked.values())
            out.append((float(tree.value[node]), np.array(list(asked), np.int64),
                        *(np.array([p[i] for p in parts], bool if i == 2 else float) for i in range(4))))
            continue
        low, high, turned, share = asked.get(f, (-np.inf, np.inf, False, 1.0))
        cut = tree.threshold[node]
        for kid, right in ((int(tree.left[node]), False), (int(tree.right[node]), True)):
            through = share * tree.cover[kid] / tree.cover[node]
            answer = (max(low, cut), high, True, through) if right else (low, min(high, cut), turned, through)
            stack.append((kid, {**asked, f: answer}))
    return out


def shapley(model: Booster, x: np.ndarray) -> tuple[np.ndarray, float]:
    """(values of every slot for every row, expected margin): a row's values and
    the expectation add up to its margin."""
    phi, expected = np.zeros(x.shape), model.base
    for tree in model.trees:
        for value, features, low, high, turned, share in paths(tree):
            expected += value * float(np.prod(share))
            d = len(features)
            if not d or value == 0:
                continue
            seen = x[:, features]
            passed = ~(seen > high) & (~turned | (seen > low))
            kinds, of = _patterns(passed)
            t, w = _quadrature(d - 1)
            factor = share[None, :, None] * (1 - t) + kinds[:, :, None] * t
            whole = factor.prod(1)[:, None, :] / factor
            phi[:, features] += (value * (kinds - share) * (whole @ w))[of]
    return phi, expected


def _patterns(passed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a boolean matrix, and which one each row is."""
    d = passed.shape[1]
    if d > 62:
        kinds, of = np.unique(passed, axis=0, return_inverse=True)
        return kinds, of.ravel()
    code, of = np.unique(passed @ (1 << np.arange(d)), return_inverse=True)
    return (code[:, None] >> np.arange(d)) & 1, of.ravel()


def _by_feature(model: Booster, phi: np.ndarray) -> np.ndarray:
    """Slots of vector columns added up to their feature."""
    widths = [model.widths.get(n, 1) for n in model.feature_names]
    if all(w == 1 for w in widths):
        return phi
    return np.add.reduceat(np.pad(phi, ((0, 0), (0, 1))), np.cumsum([0, *widths[:-1]]), axis=1)


def attributions(model: Booster, df: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns, ``base_value``, ``margin`` and ``contributions`` (an
    array in the order of the model's features; with the base value they add up
    to the margin)."""
    ship(df.sparkSession)
    width = len(model.slots)

    @F.pandas_udf("base_value double, margin double, contributions array<double>")
    def explained(x: pd.Series) -> pd.DataFrame:
        rows = np.stack(x.to_numpy()).reshape(-1, width) if len(x) else np.zeros((0, width))
        phi, base = shapley(model, rows)
        return pd.DataFrame({"base_value": np.full(len(rows), base), "margin": model.margins(rows),
                             "contributions": list(_by_feature(model, phi))})

    return df.select(*keep, explained(inputs(df, model.feature_names)).alias("_e")).select(*keep, "_e.*")


def long_form(explained: DataFrame, feature_names: list[str], keep: list[str]) -> DataFrame:
    """One row per customer and feature: the data of a summary plot."""
    names = F.array(*[F.lit(n) for n in feature_names])
    pair = F.explode(F.arrays_zip(names.alias("feature"), F.col("contributions").alias("contribution")))
    return explained.select(*keep, pair.alias("p")).select(*keep, "p.feature", "p.contribution")


def attribution_importance(model: Booster, df: DataFrame) -> DataFrame:
    """(feature, mean_abs, mean, share_positive) over all rows, most important
    first: each task adds up its rows, so one row a feature and task is shuffled."""
    ship(df.sparkSession)
    names, width = list(model.feature_names), len(model.slots)

    def task(batches):
        total = np.zeros((4, len(names)))
        for b in batches:
            if b.num_rows:
                phi = _by_feature(model, shapley(model, matrix(b.column(0), width))[0])
                total += [np.abs(phi).sum(0), phi.sum(0), (phi > 0).sum(0), np.full(len(names), len(phi))]
        yield pa.RecordBatch.from_arrays([pa.array(names), *(pa.array(t) for t in total)], ["feature", "a", "s", "p", "n"])

    sums = df.select(inputs(df, names).alias("x")).mapInArrow(task, "feature string, a double, s double, p double, n double")
    n = F.sum("n")
    return (sums.groupBy("feature").agg(F.try_divide(F.sum("a"), n).alias("mean_abs"), F.try_divide(F.sum("s"), n).alias("mean"),
                                        F.try_divide(F.sum("p"), n).alias("share_positive"))
            .orderBy(F.col("mean_abs").desc_nulls_last(), "feature"))  # one row a feature
