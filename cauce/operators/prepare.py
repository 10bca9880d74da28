"""Order-level preparation: per-customer ordering, gaps, eligibility,
label row, channel lags and runs (W1-W7, J4, P4, P9, P10, P17).

All windows share one partitioning (customer) and one ordering (date
ascending with nulls last, then the order id as tiebreak), so Spark plans
them as one Exchange + one Sort, and a later groupBy on the customer
reuses that partitioning without another shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.functions import elapsed_days
from cauce.session import materialize
from cauce.spec import COLUMNS, FEATURES, FIRST_ORDER_GAP_DAYS, Columns, FeatureSpec, check_transactions

RN, N, LAG1, BRK = "_rn", "_n", "_lag1", "_brk"
LAGDATE = "_lagdate"
# A customer with more rows than this is split into ordered pieces so that
# no single task runs the window over all of its orders.
HOT_ROWS = 2_000_000
# The ids of hot customers are broadcast up to this many, else joined.
MAX_BROADCAST_HOT = 1_000_000
# Flags of undated orders and of orders without id, which a stored transaction
# table is sorted by (``cauce.sources.sinks.write_transactions``).
STORED_ORDER = ("_sin_fecha", "_sin_pedido")


def order_window(cols: Columns = COLUMNS, stored: bool = False):
    """A customer's orders by date, then id, nulls last. Over a stored
    transaction table the same order is spelled by the columns that it is
    sorted by, so that its scan gives it and nothing is sorted again."""
    w = Window.partitionBy(cols.cliente)
    if stored:
        return w.orderBy(STORED_ORDER[0], cols.fecha, STORED_ORDER[1], cols.pedido)
    return w.orderBy(F.col(cols.fecha).asc_nulls_last(), F.col(cols.pedido).asc_nulls_last())


def is_stored(df: DataFrame) -> bool:
    return set(STORED_ORDER) <= set(df.columns)


def customer_window(cols: Columns = COLUMNS):
    return Window.partitionBy(cols.cliente)


def _gap_from(prev: Column, df: DataFrame, cols: Columns) -> Column:
    dtype = df.schema[cols.fecha].dataType
    return F.coalesce(elapsed_days(prev, F.col(cols.fecha), dtype), F.lit(FIRST_ORDER_GAP_DAYS).cast("bigint"))


def customer_profile(df: DataFrame, cols: Columns = COLUMNS, hot_rows: int | None = HOT_ROWS) -> dict:
    """One pass over (customer, date): how many customers are hot (more than
    ``hot_rows`` orders), how many orders they hold, and the date bounds.
    Orders without a customer count as one customer here, as they share a
    window. Partial aggregation per customer, then one row to the driver."""
    per = (df.groupBy(cols.cliente)
             .agg(F.count(F.lit(1)).alias("c"), F.max(cols.fecha).alias("mx"), F.min(cols.fecha).alias("mn")))
    hot = F.col("c") > F.lit(hot_rows if hot_rows else (1 << 62))
    row = per.agg(F.max("mx").alias("gmax"), F.min("mn").alias("gmin"), F.count_if(hot).alias("n_hot"),
                  F.sum(F.when(hot, F.col("c"))).alias("hot_total")).collect()[0]
    return row.asDict()


def _hot_pieces(df: DataFrame, cols: Columns, hot_rows: int, profile: dict | None = None) -> DataFrame | None:
    """``df`` with ``_piece``: 0 for ordinary customers; the orders of customers
    above ``hot_rows`` rows are dealt by ranges of (customer, date, order id)
    into pieces of about ``hot_rows``, and ``_piece`` is the range's number. The
    cut is made on the whole key, whatever its types: orders of one instant and
    ids beyond the precision of a double are cut like all others, only orders
    that agree in date and id stay together. The dealt orders are written once,
    so that later passes and re-executed tasks see the same pieces. None when
    no customer is hot."""
    prof = profile if profile is not None else customer_profile(df, cols, hot_rows)
    if not prof["n_hot"]:
        return None
    hot = materialize(df.groupBy(F.col(cols.cliente).alias("_hk")).agg(F.count(F.lit(1)).alias("_c"))
                      .filter(F.col("_c") > hot_rows).select("_hk"))
    if prof["n_hot"] <= MAX_BROADCAST_HOT:
        hot = F.broadcast(hot)
    is_hot = F.col(cols.cliente).eqNullSafe(F.col("_hk"))
    n = 1 + -(-int(prof["hot_total"]) // hot_rows)
    dealt = df.join(hot, is_hot, "left_semi").repartitionByRange(
        n, F.col(cols.cliente), F.col(cols.fecha).asc_nulls_last(), F.col(cols.pedido).asc_nulls_last())
    pieces = materialize(dealt.withColumn("_piece", F.spark_partition_id() + 1))
    return df.join(hot, is_hot, "left_anti").withColumn("_piece", F.lit(0)).unionByName(pieces)


def _join_pieces(x: DataFrame, pieces: DataFrame, k: str) -> DataFrame:
    """Rows with their piece's row, null-safe on the customer."""
    p = pieces.withColumnRenamed(k, "_pk").withColumnRenamed("_piece", "_pp")
    return x.join(p, F.col(k).eqNullSafe(F.col("_pk")) & (F.col("_piece") == F.col("_pp"))).drop("_pk", "_pp")


def _sequenced(df: DataFrame, cols: Columns, hot_rows: int | None, keep_piece: bool = False,
               profile: dict | None = None):
    """Adds ``_rn``, ``_n``, ``_lag1`` (previous channel) and ``_lagdate``
    (previous date) in the (date nulls last, order id) order per customer.
    With ``keep_piece`` returns (frame with ``_piece``, split?)."""
    pieced = _hot_pieces(df, cols, hot_rows, profile) if hot_rows else None
    if pieced is None:
        w = order_window(cols, is_stored(df))
        out = (df.withColumn(RN, F.row_number().over(w))
                 .withColumn(N, F.count(F.lit(1)).over(customer_window(cols)))
                 .withColumn(LAG1, F.lag(F.col(cols.canal), 1).over(w))
                 .withColumn(LAGDATE, F.lag(F.col(cols.fecha), 1).over(w)))
        return (out.withColumn("_piece", F.lit(0)), False) if keep_piece else out
    k = cols.cliente
    w = (Window.partitionBy(k, "_piece")
         .orderBy(F.col(cols.fecha).asc_nulls_last(), F.col(cols.pedido).asc_nulls_last()))
    x = (pieced
           .withColumn("_lrn", F.row_number().over(w))
           .withColumn("_llag", F.lag(F.col(cols.canal), 1).over(w))
           .withColumn("_llagdate", F.lag(F.col(cols.fecha), 1).over(w)))
    # one row per piece: its size and last row; stitched in piece order
    pw = Window.partitionBy(k).orderBy("_piece")
    pieces = (x.groupBy(k, "_piece")
               .agg(F.count(F.lit(1)).alias("_pc"),
                    F.max_by(F.struct(F.col(cols.canal).alias("c"), F.col(cols.fecha).alias("f")),
                             F.col("_lrn")).alias("_plast"))
               .select(k, "_piece",
                       F.coalesce(F.sum("_pc").over(pw.rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)).alias("_off"),
                       F.lag("_plast").over(pw).alias("_prev"),
                       F.sum("_pc").over(Window.partitionBy(k)).alias(N)))
    first = F.col("_lrn") == 1
    out = (_join_pieces(x, pieces, k)
             .withColumn(RN, (F.col("_lrn") + F.col("_off")).cast("int"))
             .withColumn(LAG1, F.when(first, F.col("_prev.c")).otherwise(F.col("_llag")))
             .withColumn(LAGDATE, F.when(first, F.col("_prev.f")).otherwise(F.col("_llagdate")))
             .drop("_lrn", "_llag", "_llagdate", "_off", "_prev"))
    return (out, True) if keep_piece else out.drop("_piece")


def _running_sum(x: DataFrame, value: Column, out: str, cols: Columns, split: bool) -> DataFrame:
    """Running sum of ``value`` in order per customer over a frame that
    carries ``_piece``: local sums per piece plus the totals of earlier
    pieces (a per-piece table, bounded window) when customers were split."""
    k = cols.cliente
    w = (Window.partitionBy(k, "_piece")
         .orderBy(F.col(cols.fecha).asc_nulls_last(), F.col(cols.pedido).asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, 0))
    y = x.withColumn("_v", value).withColumn(out, F.sum("_v").over(w))
    if not split:
        return y.drop("_v")
    pw = Window.partitionBy(k).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offs = (y.groupBy(k, "_piece").agg(F.sum("_v").alias("_t"))
             .select(k, "_piece", F.coalesce(F.sum("_t").over(pw), F.lit(0)).alias("_o")))
    return _join_pieces(y, offs, k).withColumn(out, F.col(out) + F.col("_o")).drop("_v", "_o")


def conform_transactions(tx: DataFrame, cols: Columns = COLUMNS, date_format: str | None = None) -> DataFrame:
    """Parse a string order date (``to_timestamp``; under ANSI mode a
    malformed value raises, as the specification's parser does) and bring
    decimal billing/material columns to DOUBLE/BIGINT."""
    fields = {f.name: f.dataType for f in tx.schema.fields}
    out = tx
    if isinstance(fields.get(cols.fecha), T.StringType):
        f = F.col(cols.fecha)
        out = out.withColumn(cols.fecha, (F.to_timestamp(f, date_format) if date_format else F.to_timestamp(f))
                             .cast("timestamp_ntz"))
    if isinstance(fields.get(cols.facturacion), (T.DecimalType, T.FloatType, T.IntegralType)):
        out = out.withColumn(cols.facturacion, F.col(cols.facturacion).cast("double"))
    if isinstance(fields.get(cols.materiales), (T.DecimalType, T.FloatType, T.DoubleType)):
        out = out.withColumn(cols.materiales, F.col(cols.materiales).cast("double"))
    return out


def with_order_gap(tx: DataFrame, cols: Columns = COLUMNS, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Days since the customer's previous order, 600 for the first."""
    check_transactions(tx, cols)
    x = _sequenced(tx, cols, hot_rows)
    return x.withColumn(cols.dias_ultimo, _gap_from(F.col(LAGDATE), x, cols)).drop(
        RN, N, LAG1, LAGDATE, *STORED_ORDER)


def with_positions(tx: DataFrame, cols: Columns = COLUMNS, hot_rows: int | None = HOT_ROWS,
                   profile: dict | None = None) -> DataFrame:
    """Adds row number ``_rn``, customer row count ``_n``, previous channel
    ``_lag1`` and the run-break flag ``_brk``; fills the gap column when the
    input lacks it. Rows with a null customer are dropped (they form no
    group). Customers above ``hot_rows`` rows are windowed in pieces."""
    check_transactions(tx, cols)
    df = tx.filter(F.col(cols.cliente).isNotNull())
    x = _sequenced(df, cols, hot_rows, profile=profile)
    if cols.dias_ultimo not in df.columns:
        x = x.withColumn(cols.dias_ultimo, _gap_from(F.col(LAGDATE), x, cols))
    # a null on either side is always a break (null <=> null would not be)
    return (x.withColumn(BRK, ~F.coalesce(F.col(LAG1) == F.col(cols.canal), F.lit(False)))
             .drop(LAGDATE))


def eligible_orders(tx: DataFrame, spec: FeatureSpec = FEATURES, cols: Columns = COLUMNS,
                    keep_positions: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """J4 + P4: historical orders of customers with at least ``min_orders``
    orders, with each customer's last order removed."""
    x = with_positions(tx, cols, hot_rows)
    out = x.filter((F.col(N) >= spec.min_orders) & (F.col(RN) < F.col(N))).drop(*STORED_ORDER)
    return out if keep_positions else out.drop(RN, N, LAG1, BRK)


def label_last_order(tx: DataFrame, spec: FeatureSpec = FEATURES, cols: Columns = COLUMNS,
                     hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """W7 + P17: the last order of each eligible customer and its binary
    target (1 when that order is digital; a null channel gives 0)."""
    x = with_positions(tx, cols, hot_rows)
    return (x.filter((F.col(N) >= spec.min_orders) & (F.col(RN) == F.col(N)))
             .select(F.col(cols.cliente), F.col(cols.pedido), F.col(cols.fecha),
                     F.col(cols.canal).alias("canal_ultimo_pedido"),
                     F.coalesce(F.col(cols.canal) == spec.digital, F.lit(False)).cast("int").alias("target")))


def channel_lags(tx: DataFrame, n_lags: int = FEATURES.n_lags, cols: Columns = COLUMNS,
                 hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Channel of the 1..n previous orders of the same customer. Lag 1
    comes from the (skew-guarded) ordered frame; when customers were split,
    lags 2..n come from one equi-join on the unique (customer, row number)
    key, which no customer can skew."""
    df = tx.filter(F.col(cols.cliente).isNotNull())
    x, split = _sequenced(df, cols, hot_rows, keep_piece=True)
    base = [F.col(cols.cliente), F.col(cols.pedido), F.col(cols.fecha), F.col(cols.canal)]
    if not split:
        w = order_window(cols, is_stored(x))
        lags = [F.lag(F.col(cols.canal), i).over(w).alias(f"canal_lag_{i}") for i in range(1, n_lags + 1)]
        return x.select(*base, *lags)
    k = cols.cliente
    rows = x.select(*base, RN, F.col(LAG1).alias("canal_lag_1"))
    if n_lags < 2:
        return rows.drop(RN)
    # each row offers its channel to the rows 2..n positions later
    offers = x.select(k, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.col(RN) + i).alias("_to"))
                                             for i in range(2, n_lags + 1)])).alias("o"),
                      F.col(cols.canal).alias("_c")).select(k, "o.i", F.col("o._to").alias(RN), "_c")
    got = (offers.groupBy(k, RN)
                 .agg(*[F.max(F.when(F.col("i") == i, F.col("_c"))).alias(f"canal_lag_{i}")
                        for i in range(2, n_lags + 1)]))
    return rows.join(got, [k, RN], "left").select(*base, *[F.col(f"canal_lag_{i}") for i in range(1, n_lags + 1)])


def channel_runs(tx: DataFrame, cols: Columns = COLUMNS, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Maximal runs of consecutive orders in one channel. One row per
    (customer, run) with the run's channel, first order and length; run ids
    are the running sum of break flags (stitched across pieces for split
    customers), and the aggregate is keyed by (customer, run), so a hot
    customer's runs spread over many tasks."""
    df = tx.filter(F.col(cols.cliente).isNotNull())
    x, split = _sequenced(df, cols, hot_rows, keep_piece=True)
    brk = ~F.coalesce(F.col(LAG1) == F.col(cols.canal), F.lit(False))
    runs = _running_sum(x, brk.cast("bigint"), "grupo_racha", cols, split)
    return (runs.groupBy(cols.cliente, "grupo_racha")
                .agg(F.min_by(F.col(cols.canal), F.col(RN)).alias(cols.canal),
                     F.min_by(F.col(cols.pedido), F.col(RN)).alias("primer_pedido_id"),
                     F.count(F.lit(1)).alias("longitud_racha")))
