import zlib

import numpy as np
import pytest

from cauce.llm import quality as Q
from llm.helpers import awkward, awkward_rows, frame, plain, words


def sample(n=600):
    texts = []
    for i in range(n):
        w = words(40 + i % 50, i).split()
        if i % 5 == 4:  # junk of three kinds
            w = [[x.upper() + "!!" for x in w], [w[0]] * len(w), [x + "***" for x in w]][i % 3]
        texts.append(" ".join(w))
    return texts


@pytest.fixture(scope="module")
def fitted(spark):
    texts = sample()
    docs = plain(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 5 != 4), 0, "x") for i in range(0, len(texts), 2)],
                                   "doc_id long, quality int, toxic int, text string")
    return docs, labels, Q.score(docs, labels).toPandas().sort_values("doc_id")


def test_held_out_accuracy(fitted):
    _, _, got = fitted
    truth = (got.doc_id % 5 != 4).astype(int)
    out = got.held_out
    assert (got.predicted == truth)[out].mean() > 0.95 and out.sum() > 50
    assert (got.predicted[truth == 1] == 1).all()  # clean documents stay
    assert got.score.between(0, 1).all()
    assert ((got.score >= 0.3).astype(int) == got.predicted).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()


def test_labels_of_held_out_rows_do_not_matter(spark, fitted):
    docs, labels, got = fitted
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = Q.score(docs, flipped).toPandas().sort_values("doc_id")
    assert np.allclose(got.score, again.score)


def test_risk_step_and_prior_are_brute_force(spark, fitted):
    docs, labels, _ = fitted
    table = Q.feature_table(docs, labels, 5).cache()
    rows = table.where("not held_out").toPandas()
    x = Q.expanded(np.frombuffer(b"".join(rows.f), "<f4").reshape(-1, Q.RAW))
    p = rows.positive.to_numpy(bool)
    risk = Q.Risk(table, 1e-3)
    w = np.random.default_rng(0).normal(0, 0.1, Q.DIM)
    z = x @ w
    soft = np.logaddexp(0, z)
    for prior in (0.8, 0.999):
        expected = prior * np.logaddexp(0, -z)[p].mean() + max(0, soft.mean() - prior * soft[p].mean())
        assert np.isclose(risk.value([w], prior)[0], expected + 5e-4 * (w[1:] ** 2).sum())
    s = 1 / (1 + np.exp(-z))
    grad = (s[:, None] * x).mean(0) - 0.8 * x[p].mean(0) + 1e-3 * np.r_[0, w[1:]]
    hess = (x * (s * (1 - s))[:, None]).T @ x / len(x) + np.diag(np.r_[0, np.full(Q.DIM - 1, 1e-3)] + 1e-9)
    assert np.allclose(risk.step(w, 0.8), -np.linalg.solve(hess, grad), atol=1e-6)
    prior = Q.estimate_prior(table, risk.minimise(None, 12), risk.n_p, risk.n_u)
    assert abs(prior - 0.8) < 0.12


def test_awkward_documents(spark):
    rows = awkward_rows()
    labels = spark.createDataFrame([(5, 1), (5, 1), (9, 0), (11, 1), (12, 1), (12, 0), (None, 1), (999, 1)], "doc_id long, quality int")
    got = Q.score(frame(spark, rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    empty = {r.score for r in got if r.doc_id in (0, 1, 2)}
    assert len(empty) == 1
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.predicted for r in Q.score(awkward(spark), none).collect()} == {1}
    assert Q.score(frame(spark, []), labels).count() == 0


def test_stage_keeps_columns(spark, fitted):
    docs, labels, got = fitted
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(got.doc_id[got.predicted == 1])
