"""Physical-plan shape: one customer shuffle for the feature build, no
unpartitioned window in the ranking plans, pruned Parquet scans."""

import re

from cauce.operators import features as feat, metrics as met
from cauce.plans.registry import scored_a, tx_a
from conftest import SF001


def _plan(df, mode="formatted"):
    jvm = df.sparkSession._jvm
    m = jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(m)


def _main(plan: str) -> str:
    return plan.split("===== Subqueries =====")[0]


def _windows(plan: str):
    return [ln for ln in plan.splitlines() if re.search(r"\bWindow \[", ln)]


def test_feature_build_single_customer_exchange(spark, tmp_path):
    path = str(tmp_path / "tx")
    tx_a(spark, SF001).write.parquet(path)
    ft = feat.feature_table(spark.read.parquet(path))
    plan = _main(_plan(ft))
    ex = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", plan)
    assert len(ex) == 1 and ex[0].startswith("cliente_id"), ex
    assert all("], [], [" not in w for w in _windows(_plan(ft, "simple")))


def test_feature_scan_is_pruned(spark):
    df = feat.history_features(tx_a(spark, SF001))
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "o_comment" not in txt and "l_extendedprice" not in txt


def test_ranking_plans_have_no_global_window(spark):
    sc = scored_a(spark, SF001)
    cum, _ = met.cumulative(sc)
    for w in _windows(_plan(cum, "simple")):
        assert "], [], [" not in w, w


def test_stored_orders_need_no_exchange_and_no_sort(spark, tmp_path):
    """From the scan up to the customer aggregate nothing is shuffled or sorted,
    and the result is that of the plain build, nulls and ties included."""
    from pyspark.sql import functions as F
    from cauce.operators import prepare
    from cauce.sources import stored_transactions, write_transactions
    tx = tx_a(spark, SF001).withColumn("fecha_pedido_dt", F.expr("if(pedido_id % 11 = 0, null, fecha_pedido_dt)"))
    tx = tx.unionByName(tx.where("pedido_id % 13 = 0").withColumn("pedido_id", F.lit(None).cast("bigint")))
    try:
        write_transactions(tx, "tx_stored", 4, str(tmp_path / "stored"))
        stored = stored_transactions(spark, "tx_stored")
        plan = _main(_plan(feat.feature_table(stored, ref_date="2024-01-01")))
        assert "Window" in plan and "Exchange" not in plan and "Sort" not in plan.replace("SortAggregate", ""), plan
        keep = ["cliente_id", "pedido_id", "fecha_pedido_dt", "_rn", "_n"]
        one = tx.where("pedido_id is not null")  # rows of one key are in no defined order among themselves
        got = prepare.with_positions(stored.where("pedido_id is not null")).select(*keep).collect()
        assert sorted(map(str, got)) == sorted(map(str, prepare.with_positions(one).select(*keep).collect()))
        assert set(prepare.eligible_orders(stored).columns) == set(prepare.eligible_orders(tx).columns)
    finally:
        spark.sql("drop table if exists tx_stored")
