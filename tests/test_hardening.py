"""Ordinary edge data: empty, all-null, infinite, constant and NaN inputs; keys
of any type; concurrent logging; vocabularies of any size; staged folders."""

import datetime as dt
import math
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from cauce.operators import encode, features as feat, metrics as met, profile, segment, split
from cauce.plans import prefix
from cauce.session import materialize, release, stage_path, staging
from cauce.sources.sinks import RunLog
from cauce.spec import FeatureSpec, check_transactions

NAN, INF = float("nan"), float("inf")


def scored(spark, rows, key="bigint"):
    return spark.createDataFrame(rows, f"cliente_id {key}, target int, propension_digital double")


def test_describe_of_awkward_columns(spark):
    rows = [(None, NAN, 5.0, INF, 1.0), (None, 1.0, 5.0, -INF, None), (None, 3.0, 5.0, INF, 2.0)]
    got = {r["feature"]: r for r in profile.describe(spark.createDataFrame(
        rows, "empty double, hole double, same double, far double, `a b` double")).collect()}
    assert got["empty"]["count"] == 0 and got["empty"]["mean"] is None and got["empty"]["q50"] is None
    assert (got["hole"]["count"], got["hole"]["mean"], got["hole"]["max"], got["hole"]["q50"]) == (2, 2.0, 3.0, 2.0)
    assert (got["same"]["q25"], got["same"]["std"]) == (5.0, 0.0)
    assert got["far"]["count"] == 3 and got["a b"]["q50"] == 1.5
    none = profile.describe(spark.createDataFrame([], "a double, b int")).collect()
    assert {r["count"] for r in none} == {0} and {r["q50"] for r in none} == {None}


def test_correlation_skips_nan(spark):
    rows = [(1, 1.0), (0, 0.0), (1, NAN), (0, None)]
    got = profile.target_correlation(spark.createDataFrame(rows, "target int, x double")).collect()
    assert {r["feature"]: r["correlation"] for r in got}["x"] == pytest.approx(1.0)


@pytest.mark.parametrize("rows", [[], [(1, 1, None), (2, 0, None)], [(1, 1, NAN)], [(1, None, 0.5)]])
def test_metrics_without_scores(spark, rows):
    df = scored(spark, rows)
    m = met.metrics_all(df).first()
    assert m["roc_auc"] is None and m["true_positives"] == 0
    lift = met.lift_score(df).first()
    assert (lift["n"], lift["lift_score"]) == (0, None)
    assert met.roc_curve(df).count() == met.pr_curve(df).count() == 1
    assert {r[0] for r in segment.segment_customers(df, duplicates="collapse").select("segmento_propension").collect()} <= {None, "D1"}


def test_metrics_of_infinite_and_nan_scores(spark):
    df = scored(spark, [(1, 1, INF), (2, 0, -INF), (3, 1, NAN), (4, 0, INF)])
    assert met.roc_auc(df).first()[0] == pytest.approx(0.75)


def test_constant_score_is_one_segment(spark):
    df = scored(spark, [(i, i % 2, 0.4) for i in range(30)])
    assert {r[0] for r in segment.segment_customers(df, duplicates="collapse").select("segmento_propension").collect()} == {"D1"}
    with pytest.raises(ValueError):
        segment.fit_segments(df)


@pytest.mark.parametrize("make,key", [(lambda i: (1 << 60) + i, "bigint"), (lambda i: f"k{i:03d}", "string"),
                                      (lambda i: -i, "bigint")])
def test_lift_ranks_keys_of_any_type(spark, make, key):
    n = 200
    rows = [(make(i), int(i % 3 == 0), 0.5 if i < 150 else 0.1) for i in range(n)]
    rows = [rows[(i * 37) % n] for i in range(n)]
    got = met.lift_score(scored(spark, rows, key), 0.22).first()
    top = sorted(rows, key=lambda r: (-r[2], r[0]))[:44]
    assert got["precision_top_k"] == pytest.approx(sum(r[1] for r in top) / 44)


def test_rank_selection_writes_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefix, "materialize", lambda df: pytest.fail("a staged table"))
    df = spark.range(5000).select((F.col("id") % 977).cast("double").alias("x"), F.lit(1.0).alias("y"))
    got = prefix.exact_quantiles(df, ["x", "y"], [0.0, 0.37, 1.0], n_buckets=16)
    values = sorted(i % 977 for i in range(5000))
    at = 4999 * 0.37
    low = values[int(at)]
    assert got["x"] == [0.0, low + (values[int(at) + 1] - low) * (at - int(at)), 976.0] and got["y"] == [1.0] * 3


def test_stratified_split_of_all_classes(spark):
    df = spark.range(1000).select(F.col("id").alias("cliente_id"), F.when(F.col("id") % 10 < 3, 1)
                                  .when(F.col("id") % 10 < 9, 0).alias("target"))
    got = {r["target"]: r["n"] for r in split.stratified_split(df).filter("is_validation").groupBy("target")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {1: 60, 0: 120, None: 20}


def test_nan_amount_is_missing(spark):
    day = dt.date(2024, 1, 1)
    rows = [(1, i, day + dt.timedelta(days=i), "DIGITAL", [10.0, NAN, 20.0, 1.0][i], 2, "PE", "ALTA", "S") for i in range(4)]
    schema = ("cliente_id bigint, pedido_id bigint, fecha_pedido_dt date, canal_pedido_cd string, facturacion_usd_val double, "
              "materiales_distintos_val bigint, pais_cd string, madurez_digital_cd string, frecuencia_visitas_cd string")
    row = feat.feature_table(spark.createDataFrame(rows, schema)).first()
    assert row["facturacion_promedio"] == 15.0 and row["facturacion_total"] == 30.0
    other = feat.feature_table(spark.createDataFrame(rows, schema), FeatureSpec(channels=("DIGITAL", "TIENDA")))
    assert "facturacion_promedio_tienda" in other.columns and "facturacion_promedio_vendedor" not in other.columns
    with pytest.raises(ValueError, match="pais_cd"):
        feat.feature_table(spark.createDataFrame(rows, schema).drop("pais_cd"))
    check_transactions(spark.createDataFrame(rows, schema).drop("pais_cd"))


def test_run_log_under_concurrency(spark):
    log = RunLog(spark, stage_path(spark, "runs"), "exp", {"team": "x"})

    def one(i):
        run = log.start_run(f"r{i}")
        log.log(run, params={"i": i}, metrics={"m": i / 2})
    with ThreadPoolExecutor(4) as ex:
        list(ex.map(one, range(16)))
    rows = log.read().collect()
    assert len(rows) == 16 * 4 and len({r["run_id"] for r in rows}) == 16
    assert {r["experiment"] for r in rows} == {"exp"}


def test_one_hot_of_many_levels(spark):
    df = spark.range(4000).select(F.col("id").alias("cliente_id"), (F.col("id") % 2).cast("int").alias("target"),
                                  F.col("id").cast("double").alias("x"),
                                  F.when(F.col("id") % 1601 < 1500, F.concat(F.lit("l"), F.col("id") % 1601)).alias("many"),
                                  F.element_at(F.array(F.lit("a"), F.lit("b")), (F.col("id") % 2 + 1).cast("int")).alias("few"))
    out, names, vocab = encode.model_matrix(df, ["many", "few"])
    assert "few_b" in names and "many_onehot" in names and "few_a" not in names
    rows = out.filter("cliente_id in (0, 1, 1500)").orderBy("cliente_id").collect()
    first = sorted(f"l{i}" for i in range(1500))
    assert rows[0]["many_onehot"].size == 1499
    for r in rows[:2]:
        level = f"l{r['cliente_id']}"
        assert list(r["many_onehot"].indices) == ([first.index(level) - 1] if level != first[0] else [])
    assert list(rows[2]["many_onehot"].indices) == []  # a null level is all zeros
    unseen = vocab.transform(df.withColumn("many", F.lit("new"))).first()["many_onehot"]
    assert list(unseen.indices) == []


def test_staged_folders_go(spark):
    other = spark.newSession()
    path = spark._jvm.org.apache.hadoop.fs.Path(stage_path(other).rsplit("/", 1)[0])
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    with staging(other):
        assert materialize(other.range(5)).count() == 5
        assert fs.exists(path)
    assert not fs.exists(path)
    release(other)  # again, without anything to remove


def test_managed_tables_are_written_and_scanned(spark):
    from cauce.sources.sinks import write_table
    from cauce.sources.tables import read_table, scan_transactions
    rows = [(i % 5, i, dt.date(2024, 1, 1) + dt.timedelta(days=i), "DIGITAL", 1.0, 2, "PE", "ALTA", "S") for i in range(40)]
    tx = spark.createDataFrame(rows, "cliente_id bigint, pedido_id bigint, fecha_pedido_dt date, canal_pedido_cd string, "
                                     "facturacion_usd_val double, materiales_distintos_val bigint, pais_cd string, "
                                     "madurez_digital_cd string, frecuencia_visitas_cd string")
    try:
        write_table(tx, "cauce_test_tx", bucket_by=(4, "cliente_id"))
        back = scan_transactions(spark, "cauce_test_tx")
        assert back.count() == 40 and read_table(spark, "cauce_test_tx").columns == tx.columns
        plan = back.groupBy("cliente_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan  # the buckets serve the aggregate
        write_table(feat.feature_table(back), "cauce_test_ft")
        assert spark.table("cauce_test_ft").count() == 5
    finally:
        spark.sql("DROP TABLE IF EXISTS cauce_test_tx")
        spark.sql("DROP TABLE IF EXISTS cauce_test_ft")
