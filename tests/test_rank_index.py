"""The rank index: no window task over the bound whatever the keys, running sums
and grouped metrics against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.operators import metrics as met
from cauce.plans import prefix as P

SHAPES = {
    "uniform": lambda r, n: r.random(n),
    "powers": lambda r, n: np.concatenate([2.0 ** -np.arange(0, 900), r.normal(size=n - 900)]),
    "crowded": lambda r, n: 1 + np.arange(n) * 2.0 ** -50,
    "wide": lambda r, n: np.concatenate([[-1.7e308, 1.7e308], r.normal(size=n - 2) * 1e-300]),
    "heavy": lambda r, n: r.standard_cauchy(n) ** 5,
}


def keyed(spark, groups, seed=1):
    r = np.random.default_rng(seed)
    rows = []
    for g, (shape, n) in groups.items():
        for k in np.unique(SHAPES[shape](r, n)).tolist():
            rows.append((g, k, int(r.integers(0, 9)), float(r.random())))
    return spark.createDataFrame(rows, "g string, k double, v long, w double")


@pytest.mark.parametrize("descending", [False, True])
def test_no_window_task_exceeds_the_bound(spark, descending):
    df = keyed(spark, {"a": ("uniform", 3000), "b": ("powers", 1500), "c": ("crowded", 900), "d": ("wide", 700),
                       "e": ("uniform", 40), None: ("heavy", 1200)}).cache()
    cells, order = P.cut_cells(df, "k", ["g"], 100)
    assert cells.groupBy("g", "_cell").count().agg(F.max("count")).first()[0] <= 100
    assert len(order) == len(set(order))
    got = P.grouped_prefix_sums(df, ["g"], "k", ["v", "w"], descending, bound=100).toPandas()
    for g, part in got.groupby("g", dropna=False):
        part = part.sort_values("k", ascending=not descending)
        assert (part["cum_v"] == part["v"].cumsum()).all() and np.allclose(part["cum_w"], part["w"].cumsum())


@pytest.mark.parametrize("shape", SHAPES)
def test_ungrouped_sums(spark, shape):
    df = keyed(spark, {"a": (shape, 1500)}).drop("g").cache()
    cells, _ = P.cut_cells(df, "k", [], 100)
    assert cells.groupBy("_cell").count().agg(F.max("count")).first()[0] <= 100
    out, tot = P.prefix_sums(df, "k", ["v"], n_buckets=15)
    got = out.toPandas().sort_values("k")
    assert (got["cum_v"] == got["v"].cumsum()).all() and tot["v"] == got["v"].sum()
    plain, _ = P.prefix_sums(df, "k", ["v"])  # one cell
    assert plain.toPandas().sort_values("k")["cum_v"].tolist() == got["cum_v"].tolist()


def test_infinite_and_missing_keys_come_last(spark):
    keys = [float("-inf"), *map(float, range(300)), float("inf"), float("nan"), None]
    df = spark.createDataFrame([(k, 1) for k in keys], "k double, v long")
    out = P.grouped_prefix_sums(df, [], "k", ["v"], bound=20).collect()
    got = {r.k: r.cum_v for r in out if r.k is not None and r.k == r.k}
    assert [got[k] for k in keys[:302]] == list(range(1, 303))
    assert P.grouped_prefix_sums(df.limit(0), [], "k", ["v"]).count() == 0


def brute(y, s):
    order = np.argsort(-s, kind="stable")
    y, s = y[order], s[order]
    last = np.r_[s[1:] != s[:-1], True]
    tp, n = np.cumsum(y)[last], np.nonzero(last)[0] + 1
    fp = n - tp
    p, q = tp[-1], fp[-1]
    area = np.sum(np.diff(np.r_[0, fp]) * (tp + np.r_[0, tp[:-1]]) / 2) / (p * q) if p and q else None
    ap = np.sum(np.diff(np.r_[0, tp]) * tp / n) / p if p else None
    return area, ap


@pytest.mark.parametrize("bound", [None, 30])
def test_metrics_of_all_groups(spark, monkeypatch, bound):
    if bound:
        monkeypatch.setattr(P, "window_rows", lambda df, rows: bound)
    r = np.random.default_rng(4)
    rows = []
    for g, n in (("x", 700), ("y", 60), (None, 200), ("one class", 30), ("single", 1)):
        for _ in range(n):
            s = float(np.round(r.random(), 2 if g == "x" else 6))
            rows.append((g, int(r.random() < s) if g != "one class" else 1, s))
    rows += [("x", None, 0.3), ("x", 1, None), ("x", 0, float("nan"))]
    df = spark.createDataFrame(rows, "g string, target int, propension_digital double")
    got = {m.g: m for m in met.ranking_metrics_by(df, ["g"]).collect()}
    for g in ("x", "y", None, "one class", "single"):
        part = [(y, s) for h, y, s in rows if h == g and y is not None and s is not None and s == s]
        area, ap = brute(np.array([y for y, _ in part]), np.array([s for _, s in part]))
        m = got[g]
        assert (m.n, m.positives) == (len(part), sum(y for y, _ in part))
        assert m.roc_auc == (None if area is None else pytest.approx(area))
        assert m.avg_precision == (None if ap is None else pytest.approx(ap))
    alone = met.roc_auc(df.filter("g = 'x'")).first()[0]
    assert got["x"].roc_auc == pytest.approx(alone)
