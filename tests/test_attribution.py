"""Shapley values against exhaustive subset enumeration, and their sums."""

import math
from dataclasses import replace
from itertools import combinations

import numpy as np
import pytest

from cauce.operators import attribution as A
from cauce.operators import boost as B
from test_boost import NAMES, PLAIN, frame, table


def left_out_value(tree, x, known):
    """Expectation of the tree where only ``known`` features are looked at:
    others follow both branches in proportion to their cover."""
    def walk(node):
        f = int(tree.feature[node])
        if f < 0:
            return float(tree.value[node])
        a, b = int(tree.left[node]), int(tree.right[node])
        if f in known:
            return walk(b if x[f] > tree.threshold[node] else a)
        return (tree.cover[a] * walk(a) + tree.cover[b] * walk(b)) / tree.cover[node]
    return walk(0)


def brute(model, x):
    n = len(x)
    phi = np.zeros(n)
    for t in model.trees:
        for j in range(n):
            rest = [i for i in range(n) if i != j]
            for k in range(n):
                w = math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n)
                for s in combinations(rest, k):
                    phi[j] += w * (left_out_value(t, x, {*s, j}) - left_out_value(t, x, set(s)))
    return phi, model.base + sum(left_out_value(t, x, set()) for t in model.trees)


@pytest.mark.parametrize("missing,features", [(0.0, 4), (0.2, 4), (0.1, 8)])
def test_equals_all_subsets(spark, missing, features):
    r = np.random.default_rng(6)
    x, y = table(500, 21, missing)
    names = NAMES
    df = frame(spark, x, y)
    if features == 8:
        from pyspark.sql import functions as F
        extra = r.normal(size=(500, 4))
        more = spark.createDataFrame([(i, *map(float, e)) for i, e in enumerate(extra)],
                                     "cliente_id long, e double, f double, g double, h double")
        df = df.join(more, "cliente_id").withColumn("target", F.when(F.col("e") > 0.2, 1 - F.col("target")).otherwise(F.col("target")))
        x, names = np.hstack([x, extra]), [*NAMES, "e", "f", "g", "h"]
    m = B.fit(df, names, replace(PLAIN, rounds=3, num_leaves=20), validation_col=None)
    phi, base = A.shapley(m, x[:25])
    for row, got in zip(x, phi):
        want, expected = brute(m, row)
        assert np.allclose(got, want, atol=1e-12) and base == pytest.approx(expected)
    phi, base = A.shapley(m, x)
    assert np.allclose(phi.sum(1) + base, m.margins(x), atol=1e-10)


def test_deep_paths_and_many_patterns():
    """A chain that asks 70 features one after the other: sums still hold."""
    d = 70
    n = 2 * d + 1
    t = B.Tree(*(np.full(n, -1, np.int64) if k in (0, 1, 3, 4) else np.zeros(n) for k in range(8)))
    rows = 1000.0
    node = 0
    t.cover[0] = rows
    for f in range(d):
        a, b = 2 * f + 1, 2 * f + 2
        t.feature[node], t.left[node], t.right[node] = f, a, b
        t.cover[a], t.cover[b] = t.cover[node] * 0.4, t.cover[node] * 0.6
        t.value[a], t.value[b] = math.sin(f), math.cos(f)
        node = b
    m = B.Booster(0.25, [t], [f"x{i}" for i in range(d)], {}, PLAIN)
    x = np.random.default_rng(3).normal(size=(50, d))
    phi, base = A.shapley(m, x)
    assert np.allclose(phi.sum(1) + base, m.margins(x), atol=1e-9)
    few = B.Booster(0.25, [t], m.feature_names, {}, PLAIN)
    assert np.allclose(A.shapley(few, x[:1])[0], phi[:1], atol=1e-12)


def test_attributed_rows_and_importance(spark):
    x, y = table(400, 31, 0.1)
    df = frame(spark, x, y)
    m = B.fit(df, NAMES, PLAIN, validation_col=None)
    got = {r.cliente_id: r for r in A.attributions(m, df, ["cliente_id"]).collect()}
    phi, base = A.shapley(m, x)
    assert len(got) == 400
    for i, r in got.items():
        assert np.allclose(r.contributions, phi[i]) and r.base_value == pytest.approx(base)
        assert sum(r.contributions) + r.base_value == pytest.approx(r.margin)
    imp = A.attribution_importance(m, df).collect()
    want = dict(zip(NAMES, np.abs(phi).mean(0)))
    assert {r.feature: round(r.mean_abs, 9) for r in imp} == {k: round(v, 9) for k, v in want.items()}
    assert [r.mean_abs for r in imp] == sorted((r.mean_abs for r in imp), reverse=True)
    long = A.long_form(A.attributions(m, df, ["cliente_id"]), NAMES, ["cliente_id"])
    assert long.count() == 1600 and A.attribution_importance(m, df.limit(0)).filter("mean_abs is not null").count() == 0


def test_slots_of_vectors_add_up():
    m = B.Booster(0.0, [], ["a", "v", "b"], {"v": 3}, PLAIN)
    assert A._by_feature(m, np.arange(10.0).reshape(2, 5)).tolist() == [[0, 6, 4], [5, 21, 9]]
