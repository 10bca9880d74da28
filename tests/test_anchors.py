"""Fixture anchors measured independently (see FIXTURES.md), sf0.01."""

from pyspark.sql import functions as F

from conftest import SF01
from cauce.operators import features as feat, prepare
from cauce.operators import split as spl
from cauce.plans.registry import tx_a


def test_fixture_a_anchors(spark):
    tx = tx_a(spark, SF01)
    assert tx.count() == 15000
    assert tx.select("cliente_id").distinct().count() == 1500
    assert tx.filter(F.col("materiales_distintos_val").isNull()).count() == 257
    ft = feat.feature_table(tx)
    assert ft.count() == 1498
    assert abs(ft.agg(F.avg("target")).first()[0] - 0.396529) < 1e-6
    assert prepare.eligible_orders(tx).count() == 13500
    assert ft.select("pct_digital_historico").distinct().count() == 71
    s = spl.temporal_split(ft)
    counts = {r[0]: r[1] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 1309, "test": 189}


def test_reference_date_and_activity(spark):
    tx = tx_a(spark, SF01)
    hist = prepare.eligible_orders(tx)
    assert str(hist.agg(F.max("fecha_pedido_dt")).first()[0]) == "2001-07-26"
    t = feat.temporal_features(hist)
    assert t.count() == 93
    assert t.filter(F.col("pedidos_ultimos_30d") > 0).count() == 20
