"""Invariants and equivalences."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from cauce.functions import round_doubles
from cauce.operators import features as feat, metrics as met, segment
from cauce.plans.prefix import exact_quantiles, prefix_sums
from cauce.plans.registry import scored_a, tx_a


def _rows(df):
    return sorted(tuple(r) for r in round_doubles(df, 9).collect())


def test_fused_equals_joined(spark):
    tx = tx_a(spark, SF001)
    a = feat.feature_table(tx)
    b = feat.feature_table_joined(tx)
    assert a.columns == b.columns
    assert _rows(a) == _rows(b)


def test_input_order_does_not_matter(spark, tmp_path):
    tx = tx_a(spark, SF001)
    # a permuted physical order, stored (a rand() in the plan itself would
    # make the reference-date subquery non-deterministic)
    tx.repartition(7, F.rand(3)).sortWithinPartitions(F.rand(5)).write.parquet(str(tmp_path / "p"))
    shuffled = spark.read.parquet(str(tmp_path / "p"))
    assert _rows(feat.feature_table(tx)) == _rows(feat.feature_table(shuffled))


def test_reference_date_parameter(spark):
    tx = tx_a(spark, SF001)
    from cauce.operators import prepare
    ref = prepare.eligible_orders(tx).agg(F.max("fecha_pedido_dt")).first()[0]
    assert _rows(feat.feature_table(tx)) == _rows(feat.feature_table(tx, ref_date=ref))


def test_metric_invariants(spark):
    sc = scored_a(spark, SF001)
    auc = met.roc_auc(sc).first()[0]
    flipped = sc.withColumn("propension_digital", 1 - F.col("propension_digital"))
    assert met.roc_auc(flipped).first()[0] == pytest.approx(1 - auc, abs=1e-12)
    m = met.confusion_metrics(sc).first()
    assert sum(m[k] for k in ("true_positives", "false_positives", "true_negatives", "false_negatives")) == sc.count()


def test_segments_partition_the_base(spark):
    sc = scored_a(spark, SF001)
    s = segment.segment_customers(sc, "propension_digital", 10)
    assert s.filter(F.col("segmento_propension").isNull()).count() == 0
    assert s.count() == sc.count()
    # higher deciles never hold lower scores
    r = s.groupBy("segmento_propension").agg(F.min("propension_digital").alias("lo"),
                                             F.max("propension_digital").alias("hi")).collect()
    order = {f"D{i}": i for i in range(1, 11)}
    r = sorted(r, key=lambda x: -order[x["segmento_propension"]])
    for a, b in zip(r, r[1:]):
        assert a["hi"] < b["lo"]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.integers(0, 20, 500).astype(float), rng.normal(size=300), np.full(400, 3.0)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [i * 0.1 for i in range(10)] + [1.0]
    got = exact_quantiles(df, ["x"], probs, n_buckets=8)["x"]
    want = np.quantile(vals, probs)
    assert got == pytest.approx(list(want), abs=1e-12)


def test_prefix_sums_match_cumsum(spark):
    rng = np.random.default_rng(11)
    keys = rng.permutation(2000).astype(float)
    vals = rng.integers(0, 5, 2000)
    df = spark.createDataFrame([(float(k), int(v)) for k, v in zip(keys, vals)], "k double, v bigint")
    out, tot = prefix_sums(df, "k", ["v"], descending=True, n_buckets=16)
    got = {r["k"]: r["cum_v"] for r in out.collect()}
    order = np.argsort(-keys)
    cs = np.cumsum(vals[order])
    assert tot["v"] == int(vals.sum())
    assert all(got[keys[i]] == c for i, c in zip(order, cs))


def test_reference_date_from_recent_slice(spark):
    from cauce.operators import prepare
    from cauce.sources.fixtures import events_transactions
    for tx in (tx_a(spark, SF001), events_transactions(spark, SF001)):
        full = prepare.eligible_orders(tx).agg(F.max("fecha_pedido_dt")).first()[0]
        assert feat.historical_reference_date(tx) == full
    import datetime as dt
    # the latest month holds only last orders: the slice must widen
    rows = [(1, 1, dt.date(2023, 1, 1), "DIGITAL"), (1, 2, dt.date(2024, 6, 1), "DIGITAL"),
            (2, 3, dt.date(2023, 5, 1), "DIGITAL"), (2, 4, dt.date(2023, 6, 1), "TELEFONO"),
            (2, 5, dt.date(2024, 6, 20), "DIGITAL"), (3, 6, None, "DIGITAL"), (3, 7, dt.date(2022, 1, 1), "DIGITAL")]
    df = spark.createDataFrame(rows, "cliente_id bigint, pedido_id bigint, fecha_pedido_dt date, canal_pedido_cd string")
    assert feat.historical_reference_date(df) == dt.date(2023, 6, 1)
