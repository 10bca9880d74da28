"""Skew guard: customers split into ordered pieces give exactly the same
rows as the one-window plan."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from cauce.functions import round_doubles
from cauce.operators import features as feat, prepare
from cauce.sources.fixtures import events_transactions, orders_transactions
from cauce.spec import FeatureSpec


def _rows(df):
    return sorted(tuple(r) for r in round_doubles(df, 6).collect())


@pytest.mark.parametrize("adapter", [orders_transactions, events_transactions])
def test_pieces_match_plain_window(spark, adapter):
    tx = adapter(spark, SF001)
    plain = FeatureSpec(hot_rows=None)
    hot = FeatureSpec(hot_rows=3)  # every customer with > 3 orders is split
    assert _rows(feat.feature_table(tx, plain)) == _rows(feat.feature_table(tx, hot))
    a = prepare.with_positions(tx, hot_rows=None).select("pedido_id", "_rn", "_n", "_lag1", "_brk",
                                                          "dias_desde_ultimo_pedido")
    b = prepare.with_positions(tx, hot_rows=3).select("pedido_id", "_rn", "_n", "_lag1", "_brk",
                                                       "dias_desde_ultimo_pedido")
    assert _rows(a) == _rows(b)


def test_pieces_really_split(spark):
    tx = events_transactions(spark, SF001)
    n = prepare._hot_pieces(tx, prepare.COLUMNS, 3).agg(F.max("_piece")).first()[0]
    assert n >= 1


@pytest.mark.parametrize("adapter", [orders_transactions, events_transactions])
def test_lags_and_runs_pieces_match(spark, adapter):
    tx = adapter(spark, SF001)
    assert _rows(prepare.channel_lags(tx, 3, hot_rows=None)) == _rows(prepare.channel_lags(tx, 3, hot_rows=3))
    assert _rows(prepare.channel_runs(tx, hot_rows=None)) == _rows(prepare.channel_runs(tx, hot_rows=3))


def test_busy_day_is_cut(spark):
    import datetime as dt
    rows = [(7, i, dt.date(2024, 1, 1 + (i >= 40)), ["DIGITAL", "TELEFONO", None][i % 3], float(i))
            for i in range(60)] + [(8, 100, dt.date(2024, 1, 1), "DIGITAL", 1.0), (8, 101, None, "VENDEDOR", 2.0)]
    tx = (spark.createDataFrame(rows, "cliente_id bigint, pedido_id bigint, fecha_pedido_dt date, "
                                      "canal_pedido_cd string, facturacion_usd_val double")
            .withColumn("materiales_distintos_val", (F.col("pedido_id") % 4).cast("bigint"))
            .withColumn("pais_cd", F.lit("PE"))
            .withColumn("madurez_digital_cd", F.when(F.col("pedido_id") % 5 == 0, F.lit("ALTA")))
            .withColumn("frecuencia_visitas_cd", F.lit("S")))
    day1 = prepare._hot_pieces(tx, prepare.COLUMNS, 10).filter((F.col("cliente_id") == 7) & (F.col("fecha_pedido_dt") == dt.date(2024, 1, 1)))
    assert day1.select("_piece").distinct().count() > 1  # one day, several pieces
    cols = ["pedido_id", "_rn", "_n", "_lag1", "_brk", "dias_desde_ultimo_pedido"]
    assert _rows(prepare.with_positions(tx, hot_rows=None).select(*cols)) == \
        _rows(prepare.with_positions(tx, hot_rows=10).select(*cols))
    assert _rows(feat.feature_table(tx, FeatureSpec(hot_rows=None))) == \
        _rows(feat.feature_table(tx, FeatureSpec(hot_rows=10)))
    assert _rows(prepare.channel_runs(tx, hot_rows=None)) == _rows(prepare.channel_runs(tx, hot_rows=10))


def test_null_customers_stay_and_are_split(spark):
    import datetime as dt
    rows = [(None if i % 3 else 1 + i % 2, i, dt.date(2024, 1, 1) + dt.timedelta(days=i // 2) if i % 7 else None,
             ["DIGITAL", "TELEFONO", None][i % 3]) for i in range(60)]
    tx = spark.createDataFrame(rows, "cliente_id bigint, pedido_id bigint, fecha_pedido_dt date, canal_pedido_cd string")
    plain = _rows(prepare.with_order_gap(tx, hot_rows=None).select("pedido_id", "cliente_id", "dias_desde_ultimo_pedido"))
    for hot in (3, 5, 100):
        got = prepare.with_order_gap(tx, hot_rows=hot).select("pedido_id", "cliente_id", "dias_desde_ultimo_pedido")
        assert sorted(map(str, _rows(got))) == sorted(map(str, plain)) and len(plain) == 60
    pieces = prepare._hot_pieces(tx, prepare.COLUMNS, 5).filter("cliente_id is null").select("_piece").distinct()
    assert pieces.count() > 1


def test_reference_date_of_one_recent_customer(spark):
    import datetime as dt
    day = dt.date(2024, 5, 1)
    rows = [(7, i, day + dt.timedelta(days=i % 20), "DIGITAL") for i in range(400)] + [(8, 900, dt.date(2024, 6, 1), "DIGITAL")]
    schema = "cliente_id bigint, pedido_id bigint, fecha_pedido_dt date, canal_pedido_cd string"
    assert feat.historical_reference_date(spark.createDataFrame(rows, schema)) == dt.date(2024, 5, 20)
    two = [(1, 1, dt.date(2020, 1, 1), "DIGITAL"), (1, 2, None, "DIGITAL"), (2, 3, dt.date(2024, 1, 1), "DIGITAL")]
    assert feat.historical_reference_date(spark.createDataFrame(two, schema)) == dt.date(2020, 1, 1)
    same = [(1, 1, day, "DIGITAL"), (1, 2, day, "DIGITAL")]
    assert feat.historical_reference_date(spark.createDataFrame(same, schema)) == day


def _of_one_instant(spark):
    """A customer whose 400 orders share one timestamp, with ids beyond 2^53."""
    import datetime as dt
    at, first = dt.datetime(2024, 3, 1, 12), 1 << 60
    rows = [(7, first + i, at, ["DIGITAL", "TELEFONO", "VENDEDOR", None][i * 7 % 4]) for i in range(400)]
    rows += [(8, i, at + dt.timedelta(hours=i), "DIGITAL") for i in range(5)]
    return spark.createDataFrame(rows, "cliente_id bigint, pedido_id bigint, fecha_pedido_dt timestamp_ntz, "
                                       "canal_pedido_cd string").repartition(5)


def test_one_instant_is_cut_evenly(spark):
    tx = _of_one_instant(spark)
    pieces = prepare._hot_pieces(tx, prepare.COLUMNS, 50)
    sizes = {r["_piece"]: r["count"] for r in pieces.where("cliente_id = 7").groupBy("_piece").count().collect()}
    assert sum(sizes.values()) == 400 and max(sizes.values()) <= 100 and 0 not in sizes
    assert pieces.where("cliente_id = 8 and _piece = 0").count() == 5
    cols = ["pedido_id", "_rn", "_n", "_lag1", "_brk", "dias_desde_ultimo_pedido"]
    for f in (lambda h: prepare.with_positions(tx, hot_rows=h).select(*cols),
              lambda h: prepare.channel_lags(tx, 3, hot_rows=h), lambda h: prepare.channel_runs(tx, hot_rows=h)):
        assert sorted(map(str, _rows(f(None)))) == sorted(map(str, _rows(f(50))))


def test_ids_of_text_are_cut(spark):
    tx = _of_one_instant(spark).withColumn("pedido_id", F.format_string("o-%d", "pedido_id"))
    cols = ["pedido_id", "_rn", "_lag1"]
    assert _rows(prepare.with_positions(tx, hot_rows=None).select(*cols).na.fill("-")) == \
        _rows(prepare.with_positions(tx, hot_rows=50).select(*cols).na.fill("-"))
    assert prepare._hot_pieces(tx, prepare.COLUMNS, 50).select("_piece").distinct().count() > 4
