"""Adapters from the driver's test tables to the transaction contract.

Fixture A maps TPC-H orders to orders of customers; fixture B maps the
event stream to dense, sub-day "orders"; fixture C is a scored table
(customer, label, score) derived from the feature table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.sources.tables import read_table
from cauce.spec import COLUMNS, Columns

# Fixed adapter values (fixture definitions, see FIXTURES.md).
DIGITAL_PRIORITIES = ("1-URGENT", "2-HIGH")
PHONE_PRIORITIES = ("3-MEDIUM",)
SEGMENT_MATURITY = {"AUTOMOBILE": "ALTA", "BUILDING": "MEDIA", "FURNITURE": "BAJA",
                    "HOUSEHOLD": "DESCONOCIDA"}
EVENT_DIGITAL = ("click", "purchase")
EVENT_PHONE = ("view",)
EVENT_SELLER = ("signup", "error")
EVENT_COUNTRIES = ("PE", "CO", "MX", "CL", "EC")
EVENT_MATURITY = ("ALTA", "MEDIA", "BAJA")
EVENT_FREQUENCY = ("SEMANAL", "QUINCENAL", "MENSUAL", None)


def _pick(values, idx) -> F.Column:
    """values[idx] for a small fixed list (CASE chain, stays in codegen)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        expr = F.when(idx == i, lit) if expr is None else expr.when(idx == i, lit)
    return expr


def orders_transactions(spark: SparkSession, sf_dir: str, cols: Columns = COLUMNS) -> DataFrame:
    """Fixture A. Joins are planned by Catalyst: lineitem's two columns are
    shuffled by order once, which serves the distinct count per order and the
    join on the order key; customer/nation join on the customer key, which leaves the
    output hash-partitioned by customer for the feature windows; nation is
    25 rows and is broadcast by the size-checked auto-broadcast rule."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    # hash-partition once by order: the distinct count then needs no second
    # exchange, and the join with orders reuses this partitioning
    materials = (lines.repartition("l_orderkey").groupBy("l_orderkey")
                      .agg(F.countDistinct("l_partkey").alias("_mat")))
    cust = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")

    prio = F.col("o_orderpriority")
    canal = (F.when(prio.isin(*DIGITAL_PRIORITIES), F.lit("DIGITAL"))
             .when(prio.isin(*PHONE_PRIORITIES), F.lit("TELEFONO"))
             .otherwise(F.lit("VENDEDOR")))
    seg = F.col("c_mktsegment")
    madurez = None
    for k, v in SEGMENT_MATURITY.items():
        madurez = F.when(seg == k, F.lit(v)) if madurez is None else madurez.when(seg == k, F.lit(v))

    joined = (orders
              .join(materials, orders.o_orderkey == materials.l_orderkey, "left")
              .join(cust, orders.o_custkey == cust.c_custkey, "left"))
    return joined.select(
        F.col("o_custkey").alias(cols.cliente),
        F.col("o_orderkey").alias(cols.pedido),
        F.col("o_orderdate").cast("date").alias(cols.fecha),
        canal.alias(cols.canal),
        F.col("o_totalprice").cast("double").alias(cols.facturacion),
        F.col("_mat").cast("bigint").alias(cols.materiales),
        F.col("n_name").alias(cols.pais),
        madurez.cast("string").alias(cols.madurez),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias(cols.frecuencia),
    )


def events_transactions(spark: SparkSession, sf_dir: str, cols: Columns = COLUMNS) -> DataFrame:
    """Fixture B: sub-day TIMESTAMP_NTZ order times, no lineitem join."""
    ev = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    canal = (F.when(et.isin(*EVENT_DIGITAL), F.lit("DIGITAL"))
             .when(et.isin(*EVENT_PHONE), F.lit("TELEFONO"))
             .when(et.isin(*EVENT_SELLER), F.lit("VENDEDOR")))
    return ev.select(
        F.col("user_id").alias(cols.cliente),
        F.col("event_id").alias(cols.pedido),
        F.col("ts").cast("timestamp_ntz").alias(cols.fecha),
        canal.alias(cols.canal),
        F.col("value").cast("double").alias(cols.facturacion),
        F.get_json_object("props", "$.k").cast("bigint").alias(cols.materiales),
        _pick(EVENT_COUNTRIES, F.pmod(F.col("user_id"), F.lit(5))).alias(cols.pais),
        _pick(EVENT_MATURITY, F.pmod(F.col("user_id"), F.lit(3))).alias(cols.madurez),
        _pick(EVENT_FREQUENCY, F.pmod(F.col("event_id"), F.lit(4))).alias(cols.frecuencia),
    )


def scored_rows(features: DataFrame, score_col: str = "pct_digital_historico",
                cols: Columns = COLUMNS) -> DataFrame:
    """Fixture C: (cliente_id, target, propension_digital)."""
    return features.select(
        F.col(cols.cliente), F.col("target").cast("int").alias("target"),
        F.col(score_col).cast("double").alias("propension_digital"))
