"""Leaf-wise boosting against a plain grower that splits one leaf at a time from
the rows themselves; early stopping with patience; parameters; persistence."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from cauce.operators import boost as B
from cauce.operators import model as mdl
from cauce.spec import BoostParams, ModelSpec

NAMES = ["a", "b", "c", "d"]
PLAIN = BoostParams(rounds=4, patience=50, num_leaves=8, feature_fraction=1.0, bagging_fraction=1.0, bagging_freq=0,
                    min_child_samples=5, max_bin=16, learning_rate=0.3)


def table(n, seed, missing=0.0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 4))
    x[:, 3] = r.integers(0, 3, n)
    z = np.where(x[:, 0] > 0.3, 1.5, -0.5) + np.where((x[:, 1] > 0) & (x[:, 3] == 1), 2, 0) + 0.4 * x[:, 2]
    y = (r.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    x[r.random(x.shape) < missing] = np.nan
    return x, y


def frame(spark, x, y, valid=None, parts=3):
    rows = [(i, int(b), bool(valid[i]) if valid is not None else False, *(None if math.isnan(v) else float(v) for v in a))
            for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "cliente_id long, target int, is_validation boolean, a double, b double, c double, d double"
                                 ).repartition(parts)


def plain_trees(x, y, edges, p):
    """Boosting by the definition: at each step the leaf with the largest gain is
    split at its best cut, all sums taken over the rows anew."""
    bins = np.stack([np.where(np.isnan(x[:, f]), 0, np.searchsorted(e, x[:, f], "left") + 1) for f, e in enumerate(edges)], 1)
    base = math.log(y.mean() / (1 - y.mean()))
    z = np.full(len(y), base)

    def shrunk(g):
        return math.copysign(max(abs(g) - p.reg_alpha, 0.0), g)

    def best(rows, g, h, depth):
        found = (0.0, None, None)
        if p.max_depth > 0 and depth >= p.max_depth:
            return found
        for f, e in enumerate(edges):
            for b in range(len(e) + 1):
                left = rows[bins[rows, f] <= b]
                right = rows[bins[rows, f] > b]
                if min(len(left), len(right)) < max(p.min_child_samples, 1):
                    continue
                if min(h[left].sum(), h[right].sum()) < p.min_child_weight:
                    continue

                def worth(part):
                    return shrunk(g[part].sum()) ** 2 / (h[part].sum() + p.reg_lambda)
                gain = worth(left) + worth(right) - worth(rows)
                if gain > found[0] + 1e-9:
                    found = (gain, f, b)
        return found

    out = []
    for _ in range(p.rounds):
        prob = 1 / (1 + np.exp(-z))
        g, h = prob - y, prob * (1 - prob)
        leaves = [(np.arange(len(y)), 0)]
        splits = []
        while len(leaves) < p.num_leaves:
            options = [(best(rows, g, h, d), i) for i, (rows, d) in enumerate(leaves)]
            most = max(o[0][0] for o in options)
            (gain, f, b), i = next(o for o in options if o[0][0] >= most - 1e-9)
            if f is None:
                break
            rows, d = leaves.pop(i)  # leaves stay in the order of their making
            splits.append((f, b, round(gain, 6), len(rows)))
            leaves += [(rows[bins[rows, f] <= b], d + 1), (rows[bins[rows, f] > b], d + 1)]
        for rows, _ in leaves:
            z[rows] += -p.learning_rate * shrunk(g[rows].sum()) / (h[rows].sum() + p.reg_lambda)
        out.append((sorted(splits), z.copy()))
    return base, out


def check_against_plain(spark, monkeypatch, p, local, missing=0.0, n=200):
    monkeypatch.setattr(B, "LOCAL_ROWS", 10 ** 6 if local else 0)
    monkeypatch.setattr(B, "EVERY", 3)  # the margins are written between rounds
    x, y = table(n, 5, missing)
    df = frame(spark, x, y)
    m = B.fit(df, NAMES, p, validation_col=None)
    edges = B.bin_edges(df, NAMES, {}, p.max_bin)
    base, want = plain_trees(x, y, edges, p)
    assert m.best_iteration == p.rounds and m.base == pytest.approx(base)
    z = np.full(n, m.base)
    for t, (splits, margins) in zip(m.trees, want):
        inner = t.feature >= 0
        assert sorted((int(f), int(b), round(float(g), 6), int(c)) for f, b, g, c in
                      zip(t.feature[inner], t.bin[inner], t.gain[inner], t.cover[inner])) == splits
        z += t.by_value(x)
        assert np.allclose(z, margins, atol=1e-9)


@pytest.mark.parametrize("local", [True, False])
def test_equals_one_split_at_a_time(spark, monkeypatch, local):
    check_against_plain(spark, monkeypatch, PLAIN, local)


@pytest.mark.parametrize("change", [dict(max_depth=2), dict(reg_alpha=2.0, reg_lambda=5.0), dict(min_child_weight=6.0),
                                    dict(num_leaves=3), dict(min_child_samples=40)])
def test_equals_one_split_at_a_time_under_parameters(spark, monkeypatch, change):
    check_against_plain(spark, monkeypatch, replace(PLAIN, rounds=2, **change), True, missing=0.15)


def fitted(spark, df, **change):
    return B.fit(df, NAMES, replace(PLAIN, **change), validation_col=None).to_json()


def test_every_parameter_changes_the_model(spark):
    df = frame(spark, *table(400, 7)).cache()
    start = dict(rounds=4, bagging_fraction=0.7, bagging_freq=1, feature_fraction=0.75)

    def trees(**change):
        return B.Booster.from_json(fitted(spark, df, **{**start, **change})).trees
    plain = trees()

    def other(ts):
        return any(len(a.value) != len(b.value) or not np.allclose(a.value, b.value) for a, b in zip(plain, ts))
    assert not other(trees())
    for change in (dict(num_leaves=4), dict(reg_alpha=3.0), dict(reg_lambda=20.0), dict(min_child_weight=12.0),
                   dict(bagging_freq=3), dict(bagging_fraction=0.4), dict(feature_fraction=0.5), dict(max_depth=1),
                   dict(min_child_samples=60), dict(learning_rate=0.1), dict(seed=7), dict(max_bin=4)):
        assert other(trees(**change)), change


def test_models_side_by_side_are_those_alone(spark, monkeypatch):
    x, y = table(300, 9)
    df = frame(spark, x, y, valid=np.arange(300) % 5 == 0).cache()
    params = [PLAIN, replace(PLAIN, num_leaves=3, rounds=7), replace(PLAIN, bagging_fraction=0.6, bagging_freq=2, seed=3)]
    for local in (True, False):
        monkeypatch.setattr(B, "LOCAL_ROWS", 10 ** 6 if local else 0)
        monkeypatch.setattr(B, "HELD", 1 << 9)  # histograms in several jobs
        both = B.fit_many(df, NAMES, params)
        for p, m in zip(params, both):
            alone = B.fit(df, NAMES, p)
            assert m.curve == alone.curve and m.best_iteration == alone.best_iteration
            assert all(np.allclose(a.value, b.value) for a, b in zip(m.trees, alone.trees))


def brute_auc(y, z):
    pos, neg = z[y == 1][:, None], z[y == 0][None, :]
    return ((pos > neg) + 0.5 * (pos == neg)).mean()


def test_validation_curve_and_best_round(spark, monkeypatch):
    monkeypatch.setattr(B, "EVERY", 4)
    x, y = table(600, 11)
    valid = np.arange(600) % 3 == 0
    m = B.fit(frame(spark, x, y, valid), NAMES, replace(PLAIN, rounds=60, patience=6))
    best, ended = B.stop_at(m.curve, 6)
    assert ended and m.best_iteration == best + 1 and len(m.curve) >= best + 7
    z = np.full(valid.sum(), m.base)
    for t, auc in zip(m.trees, m.curve):
        z += t.by_value(x[valid])
        assert auc == pytest.approx(brute_auc(y[valid], np.round(z, 12)), abs=1e-9)
    scores = {r.cliente_id: r.s for r in B.with_score(m, frame(spark, x, y), "s", margin=True).collect()}
    assert np.allclose([scores[i] for i in np.nonzero(valid)[0]], z)


def test_a_rise_after_ten_flat_rounds_is_kept():
    flat = [0.6] + [0.6] * 10 + [0.7, 0.65]
    assert B.stop_at(flat, 50) == (11, False)
    assert B.stop_at(flat + [0.7] * 48, 50) == (11, False)
    assert B.stop_at(flat + [0.7] * 48 + [0.9], 50) == (61, False)
    assert B.stop_at(flat + [0.7] * 49 + [0.9], 50) == (11, True)  # 50 rounds without a better one
    assert B.stop_at([None, None], 5) == (0, False) and B.stop_at([], 5) == (-1, False)
    assert B.stop_at([None, 0.5], 5) == (1, False)


def test_patience_reaches_the_later_optimum(spark):
    """Only the later trees find the pattern: a stop at the first flat round
    would keep the constant model."""
    r = np.random.default_rng(1)
    x = r.normal(size=(900, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int)  # no single cut helps
    df = frame(spark, x, y, valid=np.arange(900) % 4 == 0)
    m = B.fit(df, NAMES, replace(PLAIN, rounds=80, patience=30, num_leaves=4, learning_rate=0.2, feature_fraction=0.5))
    assert m.curve[m.best_iteration - 1] == max(m.curve) and m.best_iteration > 10
    assert max(m.curve) > max(m.curve[:3]) + 0.1


def test_awkward_tables(spark):
    one_class = spark.createDataFrame([(i, 1, i % 4 == 0, float(i), 0.0, None, 1.0) for i in range(40)],
                                      "cliente_id long, target int, is_validation boolean, a double, b double, c double, d double")
    m = B.fit(one_class, NAMES, PLAIN)
    p = [r.s for r in B.with_score(m, one_class, "s").collect()]
    assert min(p) > 0.99
    empty = one_class.limit(0)
    m = B.fit(empty, NAMES, PLAIN)
    assert m.trees == [] and B.with_score(m, empty, "s").count() == 0
    assert [r.s for r in B.with_score(m, one_class, "s").collect()] == [0.5] * 40
    unlabelled = one_class.selectExpr("cliente_id", "cast(null as int) target", "is_validation", "a", "b", "c", "d")
    assert B.fit(unlabelled, NAMES, PLAIN).trees == []


def test_vector_columns_and_persistence(spark):
    r = np.random.default_rng(2)
    rows = []
    for i in range(300):
        k = int(r.integers(0, 6))
        rows.append((i, int(r.random() < (0.9 if k == 4 else 0.2)), float(r.normal()),
                     Vectors.sparse(6, [k], [1.0])))
    df = spark.createDataFrame(rows, ["cliente_id", "target", "a", "v"])
    m = B.fit(df, ["a", "v"], PLAIN, validation_col=None)
    assert m.slots[0] == "a" and len(m.slots) == 7
    gains = m.importance()
    assert gains["v"] > gains["a"]
    again = B.Booster.from_json(m.to_json())
    a, b = ({r.cliente_id: r.s for r in B.with_score(x, df, "s").collect()} for x in (m, again))
    assert a == b and again.fitted_params() == m.fitted_params()


def test_spec_values_reach_the_booster(spark):
    df = frame(spark, *table(300, 3), valid=np.arange(300) % 5 == 0)
    m = mdl.train_boosted(df, NAMES, ModelSpec(seed=9, boost=PLAIN), rounds=2)
    assert m.params == replace(PLAIN, rounds=2, seed=9)


def test_joint_bins_give_every_features_own_sums():
    r = np.random.default_rng(4)
    sizes = [65, 60, 3, 3, 3, 3, 3, 3, 3, 3, 2, 9000, 7]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    bins = np.stack([r.integers(0, n, 5000) for n in sizes], 1).astype("<u2")
    g, h = r.normal(size=5000), r.random(5000)
    binned = B._Binned(np.asfortranarray(bins), offsets)
    assert len(binned.bundles) < len(sizes)
    for rows in (np.arange(5000), np.arange(0, 5000, 2), np.arange(50), np.arange(0)):
        found = binned.sums(rows, g, h)
        for f, n in enumerate(sizes):
            for got, weights in zip(found, (g[rows], h[rows], None)):
                assert np.allclose(got[offsets[f]:offsets[f + 1]], np.bincount(bins[rows, f], weights, n))


def test_a_million_rows_need_no_job_per_level(spark):
    """Above 200,000 rows every level of every round was a job of its own."""
    assert B._local(spark.range(900_000), 60)
    assert not B._local(spark.range(900_000), 100) and not B._local(spark.range(1_100_000), 1)


def test_curves_of_one_task_equal_the_distributed_ranking(spark, monkeypatch):
    x, y = table(500, 21)
    df = frame(spark, x, y, valid=np.arange(500) % 2 == 0).cache()
    p = [replace(PLAIN, rounds=6), replace(PLAIN, rounds=3, num_leaves=2)]
    at_once = B.fit_many(df, NAMES, p)
    monkeypatch.setattr(B, "_curves_at_once", B._curves)
    ranked = B.fit_many(df, NAMES, p)
    assert [len(m.curve) for m in ranked] == [6, 3]
    assert [m.curve for m in at_once] == [pytest.approx(m.curve, abs=1e-12) for m in ranked]


def test_binary_rows_of_slices_and_chunks():
    import pyarrow as pa
    x = np.arange(24, dtype="<u2").reshape(8, 3)
    a = B._packed(np.asfortranarray(x))
    assert (B._unpacked(a, 3, "<u2") == x).all()
    parts = pa.chunked_array([a.slice(1, 2), a.slice(3, 0), a.slice(5, 3)])
    assert (B._unpacked(parts, 3, "<u2") == x[[1, 2, 5, 6, 7]]).all()
    assert B._unpacked(pa.chunked_array([a.cast(pa.large_binary())]), 3, "<u2").shape == (8, 3)
    assert B._unpacked(a.slice(0, 0), 3, "<u2").shape == (0, 3)


def test_a_fit_that_a_task_holds_is_one_job(spark, monkeypatch):
    """Every 25 rounds all rows were written, and sent to each model's task, anew."""
    def never(*_):
        raise AssertionError("the rows travel again")
    x, y = table(400, 23)
    df = frame(spark, x, y, valid=np.arange(400) % 4 == 0).cache()
    p = [replace(PLAIN, rounds=60, patience=60), replace(PLAIN, rounds=30, patience=60, num_leaves=3, bagging_fraction=0.7, bagging_freq=2)]
    monkeypatch.setattr(B, "LOCAL_ROWS", 0)
    in_turns = [B.fit(df, NAMES, replace(q, rounds=8)) for q in p]
    monkeypatch.setattr(B, "LOCAL_ROWS", 10 ** 6)
    for f in ("_moved", "_grow_at_once", "_grow_jobs"):
        monkeypatch.setattr(B, f, never)
    at_once = B.fit_many(df, NAMES, p)
    assert [len(m.curve) for m in at_once] == [60, 30]
    for a, b in zip(at_once, in_turns):
        assert a.curve[:8] == pytest.approx(b.curve, abs=1e-12)
        assert all(np.allclose(s.value, t.value) and (s.feature == t.feature).all() for s, t in zip(a.trees, b.trees))


def test_held_rows_of_one_class_give_no_curve_and_trees_travel_whole(spark):
    x, y = table(200, 2)
    df = frame(spark, x, y, valid=(np.arange(200) % 4 == 0) & (y == 1))
    m = B.fit(df, NAMES, replace(PLAIN, rounds=30, patience=40))
    assert m.curve == [None] * 30 and m.best_iteration == 1
    m = B.fit(df, NAMES, PLAIN, validation_col=None)
    again = B._unstowed(B._stowed(m.trees))
    assert [t.as_dict() for t in again] == [t.as_dict() for t in m.trees] and B._unstowed(B._stowed([])) == []


def test_jobs_read_packs_and_write_no_margins_before_the_checkpoint(spark, monkeypatch):
    """Every job read all rows one by one, and every 5 rounds they were written anew."""
    x, y = table(400, 29)
    df = frame(spark, x, y, valid=np.arange(400) % 4 == 0).cache()
    p = [replace(PLAIN, rounds=8, patience=60, bagging_fraction=0.7, bagging_freq=2), replace(PLAIN, rounds=7, num_leaves=4)]
    alone = B.fit_many(df, NAMES, p)
    seen, moved = [], []
    histograms, move = B._histograms, B._moved
    monkeypatch.setattr(B, "_histograms", lambda packs, *a: (seen.append(packs.count()), histograms(packs, *a))[1])
    monkeypatch.setattr(B, "_moved", lambda *a: (moved.append(1), move(*a))[1])
    monkeypatch.setattr(B, "LOCAL_ROWS", 0)
    for added in (B.ADDED, 0):  # by the driver, in a shuffle
        monkeypatch.setattr(B, "ADDED", added)
        by_jobs = B.fit_many(df, NAMES, p)
        assert seen and max(seen) <= 8 and not moved
        for a, b in zip(by_jobs, alone):
            assert a.curve == pytest.approx(b.curve, abs=1e-12) and len(a.trees) == len(b.trees)
            assert all(np.allclose(s.value, t.value) and (s.feature == t.feature).all() for s, t in zip(a.trees, b.trees))


@pytest.mark.parametrize("n", [5000, 300])
def test_sums_by_node_are_those_of_every_nodes_rows(n):
    r = np.random.default_rng(5)
    sizes = [65, 60, 3, 3, 3, 2, 9000, 7]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    bins = np.stack([r.integers(0, k, n) for k in sizes], 1).astype("<u2")
    g, h = r.normal(size=n), r.random(n)
    binned = B._Binned(np.asfortranarray(bins), offsets)
    for nodes in (1, 3, 40):
        node = r.integers(-1, nodes, n)
        found = binned.by_node(node, nodes, g, h)
        for k in range(nodes):
            assert np.allclose(found[:, k], binned.sums(np.nonzero(node == k)[0], g, h))


def test_known_margins_are_those_of_the_written_ones(spark, monkeypatch):
    x, y = table(300, 31)
    m = B.fit(frame(spark, x, y), NAMES, replace(PLAIN, rounds=6), validation_col=None)
    bins = np.random.default_rng(1).integers(0, 16, (50, 4)).astype("<u1")
    monkeypatch.setattr(B, "_known", {})
    start = np.full(50, m.base)

    def after(n):
        return sum((t.by_bin(bins) for t in m.trees[:n]), start.copy())
    for written, upto in ((0, 2), (0, 2), (0, 4), (0, 1), (3, 5), (3, 3), (5, 6)):  # on, again, back, behind a checkpoint
        z = after(written)
        z.flags.writeable = False
        assert np.allclose(B._current(("rows", 7, 0), written, z, m.trees[written:upto], bins), after(upto))
    monkeypatch.setattr(B, "KNOWN", 500)
    for k in range(3):
        B._current(("rows", k, 0), 0, start, m.trees, bins)
    assert list(B._known) == [("rows", 2, 0)]


@pytest.mark.parametrize("n", [300, 5000])
def test_gradients_and_curvatures_are_added_in_one_pass(n, monkeypatch):
    rng = np.random.default_rng(n)
    sizes = [65, 65, 3, 3, 40]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    bins = np.asfortranarray(np.stack([rng.integers(0, s, n) for s in sizes], 1).astype(np.uint8))
    g, h, node = rng.normal(size=n), rng.random(n), rng.integers(-1, 3, n)
    plain = np.concatenate([[np.bincount(bins[:, f], w, s) for w in (g, h, np.ones(n))] for f, s in enumerate(sizes)], 1)
    count, weighted = np.bincount, []
    monkeypatch.setattr(np, "bincount", lambda x, weights=None, minlength=0: weighted.append(weights) or count(x, weights, minlength))
    binned = B._Binned(bins, offsets)
    for found in (binned.sums(None, g, h), binned.sums(np.arange(n), g, h), binned.by_node(np.zeros(n, int), 1, g, h)[:, 0]):
        assert np.allclose(found, plain, atol=1e-9) and (found[2] == plain[2]).all()
    assert np.allclose(binned.by_node(node, 3, g, h).sum(1)[:2, :65].sum(1), [g[node >= 0].sum(), h[node >= 0].sum()])
    assert all(w is None for w in weighted)  # only rows are counted on their own


def test_auc_is_that_of_all_pairs():
    rng = np.random.default_rng(4)
    for digits in (0, 1, 12):
        y = (rng.random(400) < 0.3).astype(float)
        z = np.round(rng.normal(size=400) + y, digits)
        pairs = (z[y == 1][:, None] > z[y == 0]) + 0.5 * (z[y == 1][:, None] == z[y == 0])
        assert B._auc(z, y) == pairs.mean()
    assert B._auc(z, y * 0) is None and B._auc(z, y * 0 + 1) is None and B._auc(z[:0], y[:0]) is None


def test_auc_sorts_each_class_once(monkeypatch):
    monkeypatch.setattr(np, "unique", None)  # no pass that carries the labels through a sort
    assert B._auc(np.array([0.1, 0.4, 0.4, 0.8]), np.array([0.0, 0.0, 1.0, 1.0])) == 0.875
