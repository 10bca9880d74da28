"""Radix selection of the tie cut, and encodings without the rows' own labels."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.operators import encode, metrics as met
from test_plans import _plan

R = random.Random(3)
KEYS = {
    "long": [R.choice([-1, 1]) * R.getrandbits(R.choice([3, 20, 62])) for _ in range(300)] + [-(1 << 63), (1 << 63) - 1, 0, None],
    "int": list(range(-50, 200)) + [None, None],
    "string": ["", "a", "ab", "abc", "é", "😀", None] + ["".join(R.choice("abxyzé") for _ in range(R.randint(1, 9))) for _ in range(250)],
    "date": [dt.date(1969, 12, 1) + dt.timedelta(days=R.randint(0, 90)) for _ in range(60)],
    "timestamp": [dt.datetime(1969, 12, 31, 23) + dt.timedelta(microseconds=R.getrandbits(36)) for _ in range(60)],
    "decimal(12,2)": [__import__("decimal").Decimal(R.randint(-9999, 9999)) / 100 for _ in range(60)],
}


@pytest.mark.parametrize("kind", KEYS)
def test_positives_of_first(spark, monkeypatch, kind):
    monkeypatch.setattr(met, "DIGITS", 2)
    rows = [(k, R.randint(0, 1)) for k in KEYS[kind]]
    df = spark.createDataFrame(rows, f"k {kind}, y int").cache()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0].encode() if isinstance(r[0], str) else r[0] or 0, r[1]))
    for m in {0, 1, 2, len(rows) // 3, len(rows) - 1, len(rows)}:
        assert met.positives_of_first(df, m, "k", "y") == sum(y for _, y in order[:m]), m


def test_one_key_holds_the_cut(spark):
    df = spark.createDataFrame([(7, int(i % 3 == 0)) for i in range(90)] + [(3, 1)], "k long, y int")
    assert [met.positives_of_first(df, m, "k", "y") for m in (1, 50, 61, 62, 91)] == [1, 1, 1, 2, 31]
    with pytest.raises(TypeError):
        met.positives_of_first(df.selectExpr("cast(k as double) k", "y"), 5, "k", "y")


def test_folds_leave_out_the_own_labels(spark):
    r = np.random.default_rng(5)
    rows = [(i, None if i % 50 == 0 else f"c{int(r.integers(0, 6))}", int(r.integers(0, 2)) if i % 40 else None) for i in range(600)]
    rows.append((1000, "alone", 1))
    df = spark.createDataFrame(rows, "cliente_id long, pais_cd string, target int")
    enc = encode.TargetEncoder("pais_cd", "target", 10)
    got = {x.cliente_id: x.pais_cd_target_encoded for x in enc.out_of_fold(df, 4, seed=1).collect()}
    import hashlib

    def fold(i):
        return int(hashlib.md5(f"1:{i}".encode()).hexdigest()[:13], 16) % 4
    assert len(got) == len(rows)
    for i, c, _ in rows:
        rest = [(d, y) for j, d, y in rows if fold(j) != fold(i) and y is not None]
        overall = np.mean([y for _, y in rest])
        same = [y for d, y in rest if d == c and c is not None]
        w = 1 / (1 + np.exp(-(len(same) - 10) / 10))
        assert got[i] == pytest.approx(w * np.mean(same) + (1 - w) * overall if same else overall)


def test_noise_categories_gain_nothing_out_of_fold(spark):
    """A category of its own for every second row: encoded in-sample it gives the
    label away, out of fold it does not."""
    r = np.random.default_rng(6)
    rows = [(i, f"c{i // 2}", int(r.integers(0, 2))) for i in range(3000)]
    df = spark.createDataFrame(rows, "cliente_id long, ruido string, target int").cache()
    enc = encode.TargetEncoder("ruido", "target", 1, smoothing="none")
    inside = enc.fit(df).transform(df)
    outside = enc.out_of_fold(df, 5)
    a, b = (met.roc_auc(x, score="ruido_target_encoded").first()[0] for x in (inside, outside))
    assert a > 0.8 and b < 0.55


def test_encoder_without_any_category_keeps_its_mean(spark, tmp_path):
    df = spark.createDataFrame([(i, None, i % 4 == 0) for i in range(8)], "cliente_id long, pais_cd string, b boolean")
    df = df.withColumn("target", F.col("b").cast("int"))
    enc = encode.TargetEncoder("pais_cd").fit(df)
    enc.save(str(tmp_path / "e"))
    again = encode.TargetEncoder.load(spark, str(tmp_path / "e"), "pais_cd")
    assert again.global_mean == enc.global_mean == 0.25
    assert {x[0] for x in again.transform(df).select("pais_cd_target_encoded").collect()} == {0.25}


def test_selection_plan_has_no_sort(spark):
    df = spark.range(1000).selectExpr("id k", "cast(id % 2 as int) y")
    text = met._ordered_text("k", df.schema["k"].dataType)
    plan = _plan(df.select(text.alias("k"), "y").groupBy(F.substring("k", 1, 4)).agg(F.sum("y")), "simple")
    assert "Sort" not in plan and "rangepartitioning" not in plan
