import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.llm import neighbours as N
from conftest import SF01


def brute(ids, v, query, k):
    ok = [i for i in range(len(ids)) if v[i] is not None and all(x is not None and np.isfinite(x) for x in v[i]) and any(v[i])]
    out = {}
    for q in ok:
        if ids[q] % query:
            continue
        a = N.scaled(np.array([v[q]], float))[0]
        scored = []
        for c in ok:
            if ids[c] != ids[q]:
                b = N.scaled(np.array([v[c]], float))[0]
                scored.append((-(a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())), ids[c]))
        out[ids[q]] = [(i, -s) for s, i in sorted(set(scored))[:k]]
    return out


def held(df, ids, v, query, k, least=0.9):
    got = {}
    for r in sorted(N.nearest(df, F.col("vec_id") % query == 0, k).collect()):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = brute(ids, v, query, k)
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in want.items() if x}
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in got)
    assert hit >= least * sum(map(len, want.values()))
    for q in got:
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))
    return got, want


def vectors(n, dim, seed, groups=20):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(groups, dim))
    return (centre[r.integers(0, groups, n)] + 0.4 * r.normal(size=(n, dim))).astype("float32").astype(float).tolist()


SCHEMA = "vec_id long, embedding array<double>, label int, region int, rank int"


@pytest.mark.parametrize("region", [20_000, 60])
def test_recall(spark, monkeypatch, region):
    monkeypatch.setattr(N, "REGION", region)
    v = vectors(900, 24, 1)
    df = spark.createDataFrame([(i, x, 0, 1, 2) for i, x in enumerate(v)], SCHEMA)
    held(df, list(range(len(v))), v, 20, 5)


def test_awkward_vectors(spark):
    v = vectors(30, 8, 2) + [None, [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] + [0.0] * 7]
    v += [v[0]] * 9 + [[1e-200] * 8, [1e150] * 8]
    ids = list(range(len(v)))
    rows = [(i, x, 0, 1, 2) for i, x in zip(ids, v)] + [(0, v[0], 0, 1, 2), (None, v[1], 0, 1, 2), (500, [1.0, 2.0], 0, 1, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got, want = held(df, ids, v, 3, 5, least=1.0)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}


@pytest.mark.parametrize("region", [20_000, 16])
def test_scaled_copies_tie_by_id(spark, monkeypatch, region):
    monkeypatch.setattr(N, "REGION", region)
    v = vectors(40, 8, 5) + [[x * 2.0 ** (7 * (i % 9) - 30) for x in vectors(1, 8, 6)[0]] for i in range(60)]
    order = np.random.default_rng(1).permutation(100)  # ids don't follow the scale
    rows = [(int(i), x, 0, 1, 2) for i, x in zip(order, v)]
    got, want = held(spark.createDataFrame(rows, SCHEMA), [r[0] for r in rows], v, 1, 5, least=1.0)
    copies = sorted(int(i) for i in order[40:])
    for q in copies:
        assert [i for i, _ in got[q]] == [i for i in copies if i != q][:5]
    assert got == want


def test_components_of_any_magnitude(spark):
    r = np.random.default_rng(8)
    base = vectors(60, 8, 7)
    v = [[x * 10.0 ** int(e) for x in b] for b, e in zip(base, r.integers(-300, 300, 60))]
    v += [[1e300, 1e-300, 0.0, 0.0, 0.0, 0.0, 0.0, -1e300], [1e-300] * 8]
    rows = [(i, x, 0, 1, 2) for i, x in enumerate(v)]
    got, want = held(spark.createDataFrame(rows, SCHEMA), list(range(len(v))), v, 1, 5, least=1.0)
    assert all(np.isfinite(s) and abs(s) <= 1 + 1e-12 for x in got.values() for _, s in x)
    exact = [[Fraction(x) for x in w] for w in v]

    def cosine(a, b):  # in rationals up to the roots
        dot = sum(x * y for x, y in zip(a, b))
        square = dot * dot / (sum(x * x for x in a) * sum(y * y for y in b))
        return (1 if dot > 0 else -1) * math.sqrt(square)
    for q in got:
        for i, s in got[q]:
            assert s == pytest.approx(cosine(exact[q], exact[i]), abs=1e-12)


def test_regions_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(N, "REGION", 25)
    monkeypatch.setattr(N, "REGIONS", 4)
    v = vectors(600, 16, 9)
    df = spark.createDataFrame([(i, x, 0, 1, 2) for i, x in enumerate(v)], SCHEMA)
    held(df, list(range(len(v))), v, 20, 5)


def test_fewer_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0, 1, 2), (1, [0.0, 1.0], 0, 1, 2)], SCHEMA)
    got = N.nearest(df, F.col("vec_id") % 2 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 0.0)]
    assert N.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 2 == 0).count() == 0


def test_chi_square():
    assert abs(N.chi_square(np.array(5.348), 6) - 0.5) < 1e-3  # the median of six degrees
    assert abs(N.chi_square(np.array(N.stop_ratio(8, 0.95)), 8) - 0.95) < 1e-9


def test_query_on_table(spark):
    from cauce.llm.queries import QUERIES
    e = spark.read.parquet(f"{SF01}/embeddings.parquet").toPandas().sort_values("vec_id")
    v = np.stack(e.embedding).astype(float)
    n = np.sqrt((v * v).sum(1))
    got = QUERIES["op5_neighbours"](spark, SF01).toPandas()
    hit = 0
    for q in range(0, len(v), 50):
        s = (v @ v[q]) / (n * n[q])
        s[q] = -2
        hit += len(set(np.argsort(-s)[:5]) & set(got[got.query_id == e.vec_id.iloc[q]].vec_id))
    assert hit >= 0.9 * len(got) and len(got) == 5 * len(range(0, len(v), 50))
