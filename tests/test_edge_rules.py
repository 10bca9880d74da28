"""Fixture D: one inline group per null/tie rule of the specification."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cauce.operators import encode, features as feat, metrics as met, prepare, profile, segment
from cauce.operators import split as spl

TX = ("cliente_id bigint, pedido_id bigint, fecha_pedido_dt date, canal_pedido_cd string, "
      "facturacion_usd_val double, materiales_distintos_val bigint, pais_cd string, "
      "madurez_digital_cd string, frecuencia_visitas_cd string")
D = dt.date


def rows():
    r = []
    # 1: single order -> not eligible
    r.append((1, 10, D(2024, 3, 1), "DIGITAL", 5.0, 1, "PE", "ALTA", "S"))
    # 2: nulls in the channel (first, middle, twice in a row); label TELEFONO
    ch = [None, "DIGITAL", None, None, "DIGITAL", "DIGITAL", "TELEFONO"]
    for i, c in enumerate(ch):
        r.append((2, 20 + i, D(2024, 1, 1) + dt.timedelta(days=10 * i), c, 10.0 + i, 2, "CO", "MEDIA", "M"))
    # 3: null date sorts last and becomes the label row
    r.append((3, 30, D(2024, 3, 10), "TELEFONO", 1.0, 1, "MX", "BAJA", None))
    r.append((3, 31, D(2024, 3, 20), "VENDEDOR", 2.0, 1, None, None, "Q"))
    r.append((3, 32, None, "DIGITAL", 3.0, 1, None, None, None))
    # 4: all billing null, never digital, unmapped maturity
    r.append((4, 40, D(2024, 3, 25), "VENDEDOR", None, None, "PE", "DESCONOCIDA", "S"))
    r.append((4, 41, D(2024, 3, 30), "TELEFONO", None, None, "PE", "DESCONOCIDA", "S"))
    r.append((4, 42, D(2024, 3, 31), "VENDEDOR", None, None, "PE", "DESCONOCIDA", "S"))
    # 5: inactive in the last 90 days
    r.append((5, 50, D(2023, 1, 1), "DIGITAL", 7.0, 3, "CL", None, None))
    r.append((5, 51, D(2023, 2, 1), "DIGITAL", 9.0, 3, "CL", None, None))
    r.append((5, 52, D(2023, 3, 1), "DIGITAL", 9.0, 3, "CL", None, None))
    # 6: active in 90 but not 30 days; equal dates broken by order id
    r.append((6, 61, D(2024, 1, 15), "DIGITAL", 4.0, 2, "EC", "ALTA", "S"))
    r.append((6, 60, D(2024, 1, 15), "TELEFONO", 4.0, 2, "EC", "ALTA", "S"))
    r.append((6, 62, D(2024, 1, 20), "DIGITAL", 4.0, 2, "EC", "ALTA", "S"))
    # null customer: dropped everywhere
    r.append((None, 99, D(2024, 3, 31), "DIGITAL", 1.0, 1, "PE", "ALTA", "S"))
    return r


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(rows(), TX)


@pytest.fixture(scope="module")
def ft(tx):
    return {r["cliente_id"]: r.asDict() for r in feat.feature_table(tx).collect()}


def test_eligibility_and_null_key(ft):
    assert set(ft) == {2, 3, 4, 5, 6}  # N16 (>= 2 orders), null key dropped


def test_null_channels(ft):
    c = ft[2]
    assert c["total_pedidos"] == 3  # N1: non-null channels among 6 historical rows
    assert c["pedidos_digitales_total"] == 3 and c["pct_digital_historico"] == 1.0
    assert c["ultimo_canal"] == "DIGITAL" and c["penultimo_canal"] == "DIGITAL"  # N12
    assert c["transicion_canal"] == "DIGITAL_TO_DIGITAL"
    assert c["racha_canal_actual"] == 2  # N13: null on either side breaks a run
    assert c["target"] == 0


def test_null_date_is_label_row(ft):
    c = ft[3]
    assert c["target"] == 1  # N15: the null-date order sorts last
    assert c["fecha_pedido_dt"] == D(2024, 3, 20)
    assert c["pais_cd"] == "MX" and c["madurez_digital_cd"] == "BAJA"  # last non-null each
    assert c["frecuencia_visitas_cd"] == "Q"


def test_all_null_billing_never_digital_unmapped(ft, tx):
    c = ft[4]
    assert c["facturacion_promedio"] == 0 and c["facturacion_total"] == 0 and c["facturacion_std"] == 0
    assert c["dias_desde_ultimo_digital"] == 999  # N9
    assert c["madurez_digital_encoded"] == 0.0  # unmapped -> 0 in the final table
    cat = {r["cliente_id"]: r for r in feat.categorical_features(tx).collect()}
    assert cat[4]["madurez_digital_encoded"] is None


def test_inactive_customer_gets_zero_temporal(ft):
    c = ft[5]
    for k in ("pct_digital_90d", "pct_digital_30d", "tendencia_digital", "pedidos_ultimos_90d",
              "pedidos_ultimos_30d", "dias_desde_ultimo_digital"):
        assert c[k] == 0, k  # N10 (0 days, not 999)
    assert c["madurez_digital_cd"] == "0" and c["pais_cd"] == "CL"  # N17


def test_active_90_not_30(ft, tx):
    hist = prepare.eligible_orders(tx)
    t = {r["cliente_id"]: r for r in feat.temporal_features(hist).collect()}
    assert t[6]["tendencia_digital"] is None and t[6]["pct_digital_30d"] == 0.0  # N8
    assert ft[6]["tendencia_digital"] == 0.0
    assert 5 not in t  # N7


def test_tie_break_by_order_id(ft, tx):
    lab = {r["cliente_id"]: r for r in prepare.label_last_order(tx).collect()}
    assert lab[6]["pedido_id"] == 62
    c = ft[6]
    assert c["ultimo_canal"] == "DIGITAL" and c["penultimo_canal"] == "TELEFONO"  # 60 before 61
    gaps = {r["pedido_id"]: r["dias_desde_ultimo_pedido"] for r in prepare.with_order_gap(tx).collect()}
    assert gaps[60] == 600 and gaps[61] == 0 and gaps[62] == 5


def test_runs_cover_all_orders(tx):
    runs = prepare.channel_runs(tx).groupBy("cliente_id").agg(F.sum("longitud_racha").alias("s"))
    n = tx.filter(F.col("cliente_id").isNotNull()).groupBy("cliente_id").count()
    assert runs.join(n, "cliente_id").filter(F.col("s") != F.col("count")).count() == 0


def test_month_end_cutoff(spark):
    df = spark.createDataFrame([(1, D(2024, 3, 31)), (2, D(2024, 2, 29)), (3, D(2024, 2, 28)), (4, None)],
                               "cliente_id bigint, fecha_pedido_dt date")
    s = {r[0]: r[1] for r in spl.temporal_split(df).select("cliente_id", "split").collect()}
    assert s == {1: "test", 2: "test", 3: "train"}  # N21: null date in neither


def scored(spark, scores, labels):
    return spark.createDataFrame([(i, int(y), float(s)) for i, (s, y) in enumerate(zip(scores, labels))],
                                 "cliente_id bigint, target int, propension_digital double")


def test_ap_reference_case(spark):
    df = scored(spark, [0.1, 0.4, 0.35, 0.8, 0.4], [0, 0, 1, 1, 1])
    assert met.roc_auc(df).first()[0] == pytest.approx(0.75)
    assert met.average_precision(df).first()[0] == pytest.approx(0.805556, abs=1e-6)


def test_single_class_and_ties(spark):
    one = scored(spark, [0.2, 0.3, 0.9], [0, 0, 0])
    assert met.roc_auc(one).first()[0] is None and met.average_precision(one).first()[0] is None  # D13
    m = met.confusion_metrics(one).first()
    assert m["true_positives"] + m["false_positives"] + m["true_negatives"] + m["false_negatives"] == 3
    eq = scored(spark, [0.5] * 6, [0, 1, 0, 1, 1, 0])
    assert met.roc_auc(eq).first()[0] == pytest.approx(0.5)


def test_lift_rules(spark):
    tiny = scored(spark, [0.1, 0.9, 0.5], [0, 1, 0])
    assert met.lift_score(tiny, 0.2).first()["lift_score"] is None  # N23: n_top = 0
    df = scored(spark, [0.9, 0.9, 0.9, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7], [0, 1, 1, 0, 0, 0, 0, 1, 0, 0])
    r = met.lift_score(df, 0.2).first()  # top 2 rows: ids 0, 1 (ties by id)
    assert r["n_top"] == 2 and r["precision_top_k"] == pytest.approx(0.5)
    assert r["lift_score"] == pytest.approx(0.5 / 0.3)


def test_segments(spark):
    df = scored(spark, [i / 20 for i in range(20)], [0] * 20)
    s = segment.segment_customers(df, "propension_digital", 10)
    got = {r["cliente_id"]: r["segmento_propension"] for r in s.collect()}
    assert got[19] == "D1" and got[0] == "D10" and None not in got.values()
    ties = scored(spark, [0.1] * 8 + [0.2, 0.3], [0] * 10)
    with pytest.raises(ValueError):
        segment.segment_customers(ties, "propension_digital", 4)  # N25
    col = segment.segment_customers(ties, "propension_digital", 4, duplicates="collapse")
    assert col.select("segmento_propension").distinct().count() < 4
    assert col.filter(F.col("segmento_propension").isNull()).count() == 0


def test_constant_column_correlation(spark):
    df = spark.createDataFrame([(1, 1.0, 0), (2, 1.0, 1), (3, 1.0, 1)], "cliente_id bigint, k double, target int")
    r = {x["feature"]: x["correlation"] for x in profile.target_correlation(df, "target", None).collect()}
    assert r["k"] is None and r["target"] == pytest.approx(1.0)


def test_encoders(spark):
    tr = spark.createDataFrame([("A", 1), ("A", 0), ("B", 1), (None, 1)], "pais_cd string, target int")
    enc = encode.TargetEncoder("pais_cd", "target", 2).fit(tr)
    te = spark.createDataFrame([("A",), ("Z",), (None,)], "pais_cd string")
    out = {r["pais_cd"]: r["pais_cd_target_encoded"] for r in enc.transform(te).collect()}
    g = 0.75
    assert out["Z"] == pytest.approx(g) and out[None] == pytest.approx(g)  # N20
    w = 1 / (1 + math.exp(0.0))
    assert out["A"] == pytest.approx(w * 0.5 + (1 - w) * g)
    v = encode.OneHotVocabulary().fit(tr, ["pais_cd", "missing_col"])
    assert v.names() == ["pais_cd_B"]  # first level dropped, absent column skipped
    oh = {r["pais_cd"]: r["pais_cd_B"] for r in v.transform(te).collect()}
    assert oh == {"A": 0, "Z": 0, None: 0}  # N19


def test_timestamp_elapsed_days(spark):
    df = spark.createDataFrame([
        (1, 1, dt.datetime(2024, 1, 1, 23, 0), "DIGITAL"), (1, 2, dt.datetime(2024, 1, 2, 1, 0), "TELEFONO"),
        (1, 3, dt.datetime(2024, 1, 4, 0, 30), "VENDEDOR")],
        "cliente_id bigint, pedido_id bigint, fecha_pedido_dt timestamp_ntz, canal_pedido_cd string")
    t = feat.temporal_features(df.withColumn("facturacion_usd_val", F.lit(1.0))).first()
    assert t["dias_desde_ultimo_digital"] == 2  # 2 days 1.5 h -> 2 (floor), N11
    gaps = [r[0] for r in prepare.with_order_gap(df).orderBy("pedido_id").select("dias_desde_ultimo_pedido").collect()]
    assert gaps == [600, 0, 1]


def test_string_dates_are_parsed_and_bad_ones_raise(spark):
    df = spark.createDataFrame([(1, 1, "2024-01-02 10:00:00", "DIGITAL", 1.0)],
                               "cliente_id bigint, pedido_id bigint, fecha_pedido_dt string, "
                               "canal_pedido_cd string, facturacion_usd_val double")
    c = prepare.conform_transactions(df)
    assert dict(c.dtypes)["fecha_pedido_dt"] == "timestamp_ntz"
    bad = spark.createDataFrame([(1, 1, "not a date", "DIGITAL", 1.0)], df.schema)
    with pytest.raises(Exception):
        prepare.conform_transactions(bad).collect()
