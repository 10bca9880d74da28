"""Customer features.

Each builder is one ``groupBy(customer).agg(...)`` of conditional
aggregates: channel filters (P2), per-channel means (A3), recent windows
(P3) and last-non-null picks (A7) are ``when`` expressions inside a single
aggregate, so there is no pivot, no per-channel regrouping and no join.
``feature_table`` fuses all four builders and the label into one aggregate
over the windowed orders: one Exchange on the customer, one Sort, one
Window stage, one HashAggregate.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.functions import elapsed_days, last_non_null, minus_days, number, ratio
from cauce.operators.prepare import BRK, LAG1, N, RN, customer_profile, with_positions
from cauce.spec import (
    CATEGORICAL_COLS, COLUMNS, FEATURES, NEVER_DIGITAL_DAYS, SEQUENCE_COLS, TEMPORAL_COLS,
    TRANSITION_SEP, UNKNOWN, Columns, FeatureSpec, check_transactions,
)


def _in(cond: Column | None, value: Column) -> Column:
    return value if cond is None else F.when(cond, value)


def _and(cond: Column | None, other: Column) -> Column:
    return other if cond is None else (cond & other)


# --------------------------------------------------------------------- history
def _history_aggs(cols: Columns, spec: FeatureSpec, cond: Column | None) -> list[Column]:
    fact = _in(cond, number(F.col(cols.facturacion)))
    mat = _in(cond, number(F.col(cols.materiales)))
    canal = F.col(cols.canal)
    out = [
        F.count(_in(cond, canal)).alias("total_pedidos"),
        F.coalesce(F.avg(fact), F.lit(0.0)).alias("facturacion_promedio"),
        F.coalesce(F.stddev_samp(fact), F.lit(0.0)).alias("facturacion_std"),
        F.coalesce(F.sum(fact), F.lit(0.0)).alias("facturacion_total"),
        F.coalesce(F.avg(mat), F.lit(0.0)).alias("materiales_promedio"),
        F.coalesce(F.stddev_samp(mat), F.lit(0.0)).alias("materiales_std"),
        F.coalesce(F.avg(_in(cond, F.col(cols.dias_ultimo).cast("double"))), F.lit(0.0)).alias("dias_ultimo_promedio"),
        F.count_if(_and(cond, canal == spec.digital)).alias("pedidos_digitales_total"),
    ]
    for ch in spec.channels:
        is_ch = _and(cond, canal == ch)
        out.append(F.coalesce(F.avg(F.when(is_ch, number(F.col(cols.facturacion)))), F.lit(0.0))
                   .alias(f"facturacion_promedio_{ch.lower()}"))
        out.append(F.coalesce(F.avg(F.when(is_ch, number(F.col(cols.materiales)))), F.lit(0.0))
                   .alias(f"materiales_promedio_{ch.lower()}"))
    return out


def _history_select(spec: FeatureSpec) -> list[Column]:
    pct = ratio(F.col("pedidos_digitales_total"), F.col("total_pedidos"), 0.0).alias("pct_digital_historico")
    return [pct if c == "pct_digital_historico" else F.col(c) for c in spec.history_columns()]


def history_features(tx: DataFrame, spec: FeatureSpec = FEATURES, cols: Columns = COLUMNS) -> DataFrame:
    """A1-A3: order count, billing/material moments, mean gap, digital share
    and per-channel means over all rows of the frame, one row per customer.
    Partial aggregation runs before the shuffle (map-side combine), so a hot
    customer costs one row per input partition, not one task of all its rows."""
    df = tx.filter(F.col(cols.cliente).isNotNull())
    if cols.dias_ultimo not in df.columns:
        df = with_positions(df, cols, spec.hot_rows)
    agg = df.groupBy(cols.cliente).agg(*_history_aggs(cols, spec, None))
    return agg.select(F.col(cols.cliente), *_history_select(spec))


# -------------------------------------------------------------------- temporal
def _temporal_aggs(cols: Columns, spec: FeatureSpec, cond: Column | None, ref: Column,
                   dtype: T.DataType) -> list[Column]:
    fecha, canal = F.col(cols.fecha), F.col(cols.canal)
    dig = canal == spec.digital
    in_long = fecha >= minus_days(ref, spec.trend_days, dtype)
    in_short = fecha >= minus_days(ref, spec.recent_days, dtype)
    return [
        F.count_if(_and(cond, in_long)).alias("_n_long"),
        F.count_if(_and(cond, in_long & dig)).alias("_d_long"),
        F.count_if(_and(cond, in_short)).alias("_n_short"),
        F.count_if(_and(cond, in_short & dig)).alias("_d_short"),
        F.max(F.when(_and(cond, dig), fecha)).alias("_last_digital"),
    ]


def _temporal_values(ref: Column, fecha_type) -> dict[str, Column]:
    n_long, n_short = F.col("_n_long"), F.col("_n_short")
    pct_long = ratio(F.col("_d_long"), n_long, 0.0)
    pct_short = ratio(F.col("_d_short"), n_short, 0.0)
    return {
        "pct_digital_90d": pct_long,
        "pct_digital_30d": pct_short,
        # not active in the short window: undefined trend (null), as the
        # index-aligned subtraction in the specification leaves it
        "tendencia_digital": F.when(n_short > 0, pct_short - pct_long),
        "pedidos_ultimos_90d": n_long,
        "pedidos_ultimos_30d": n_short,
        "dias_desde_ultimo_digital": F.coalesce(
            elapsed_days(F.col("_last_digital"), ref, fecha_type), F.lit(NEVER_DIGITAL_DAYS).cast("bigint")),
    }


def _as_literal(value, dtype) -> Column:
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit(value)
    return F.lit(value.isoformat(sep=" ")).cast(dtype)


def historical_reference_date(tx: DataFrame, cols: Columns = COLUMNS, first_span_days: int = 31,
                              profile: dict | None = None):
    """N6 for the feature table: the latest date among historical orders
    (every order but each customer's last, customers with >= 2 orders),
    without windowing all orders. With G the overall latest date, only
    orders dated >= G - span (and undated ones, which sort last) can
    decide it: a historical order in that slice has its customer's last
    order in the slice too, and positions inside the slice equal the
    positions overall. So the slice's own historical maximum is exact; if
    the slice holds none, the span grows. The slice is a pushed-down date
    filter, so only recent row groups are read, and it is counted per customer
    and date instead of windowed."""
    df = tx.filter(F.col(cols.cliente).isNotNull()).select(cols.cliente, cols.fecha, cols.pedido)
    if profile is not None:
        g, lo = profile["gmax"], profile["gmin"]
    else:
        g, lo = df.agg(F.max(cols.fecha), F.min(cols.fecha)).collect()[0]
    if g is None:
        return None
    span = first_span_days
    while True:
        d0 = g - _dt.timedelta(days=span)
        dtype = df.schema[cols.fecha].dataType
        recent = df.filter(F.col(cols.fecha).isNull() | (F.col(cols.fecha) >= _as_literal(d0, dtype)))
        # orders per customer and date (map-side combined, so no customer is
        # hot); a dated order is historical if its customer has a later or an
        # undated order, or another one on the same date
        days = recent.groupBy(cols.cliente, cols.fecha).agg(F.count(F.lit(1)).alias("_c"))
        ends = days.groupBy(F.col(cols.cliente).alias("_k")).agg(
            F.max(cols.fecha).alias("_d1"), F.max(F.col(cols.fecha).isNull()).alias("_u"))
        cand = (days.join(ends, F.col(cols.cliente) == F.col("_k"))
                .filter((F.col(cols.fecha) < F.col("_d1")) | F.col("_u") | (F.col("_c") > 1))
                .agg(F.max(cols.fecha)).collect()[0][0])
        if cand is not None or d0 <= lo:
            return cand
        span *= 4


def reference_date(tx: DataFrame, cols: Columns = COLUMNS) -> Column:
    """The frame's maximum order date as a lazy scalar subquery."""
    return tx.agg(F.max(F.col(cols.fecha)).alias("_ref")).scalar()


def temporal_features(tx: DataFrame, spec: FeatureSpec = FEATURES, cols: Columns = COLUMNS,
                      ref_date=None) -> DataFrame:
    """Digital share and order counts in the trailing long/short
    windows ending at the frame's maximum date, trend and days since the
    last digital order. Only customers with an order in the long window
    appear (N7)."""
    df = tx.filter(F.col(cols.cliente).isNotNull())
    ref = reference_date(df, cols) if ref_date is None else F.lit(ref_date).cast(df.schema[cols.fecha].dataType)
    agg = df.groupBy(cols.cliente).agg(*_temporal_aggs(cols, spec, None, ref, df.schema[cols.fecha].dataType))
    vals = _temporal_values(ref, df.schema[cols.fecha].dataType)
    return (agg.filter(F.col("_n_long") > 0)
               .select(F.col(cols.cliente), *[vals[c].alias(c) for c in TEMPORAL_COLS]))


# -------------------------------------------------------------------- sequence
def _sequence_aggs(cols: Columns, cond: Column | None) -> list[Column]:
    rn = F.col(RN)
    return [
        last_non_null(F.col(cols.canal), rn, cond).alias("_ultimo"),
        last_non_null(F.col(LAG1), rn, cond).alias("_penultimo"),
        F.count(_in(cond, F.lit(1))).alias("_rows"),
        F.max(F.when(_and(cond, F.col(BRK)), rn)).alias("_last_break"),
    ]


def _sequence_values() -> dict[str, Column]:
    ult, pen = F.col("_ultimo"), F.col("_penultimo")
    return {
        "ultimo_canal": ult,
        "penultimo_canal": F.coalesce(pen, F.lit(UNKNOWN)),
        "transicion_canal": F.coalesce(F.concat(pen, F.lit(TRANSITION_SEP), ult), F.lit(UNKNOWN)),
        "racha_canal_actual": (F.col("_rows") - F.col("_last_break") + 1).cast("bigint"),
    }


def sequence_features(tx: DataFrame, cols: Columns = COLUMNS, spec: FeatureSpec = FEATURES) -> DataFrame:
    """Last and previous channel (each the last non-null
    value), their transition and the length of the current run."""
    x = with_positions(tx, cols, spec.hot_rows)
    agg = x.groupBy(cols.cliente).agg(*_sequence_aggs(cols, None))
    vals = _sequence_values()
    return agg.select(F.col(cols.cliente), *[vals[c].alias(c) for c in SEQUENCE_COLS])


# ----------------------------------------------------------------- categorical
def _maturity_score(col: Column, scores: dict) -> Column:
    expr = None
    for k, v in scores.items():
        expr = F.when(col == k, F.lit(float(v))) if expr is None else expr.when(col == k, F.lit(float(v)))
    return expr.cast("double")


def _categorical_aggs(cols: Columns, cond: Column | None) -> list[Column]:
    rn = F.col(RN)
    return [last_non_null(F.col(c), rn, cond).alias(c) for c in (cols.pais, cols.madurez, cols.frecuencia)]


def categorical_features(tx: DataFrame, spec: FeatureSpec = FEATURES, cols: Columns = COLUMNS) -> DataFrame:
    """A7 + P16: last non-null country, maturity and visit frequency (each
    column independently) and the fixed maturity score (null if unmapped)."""
    x = with_positions(tx, cols, spec.hot_rows)
    agg = x.groupBy(cols.cliente).agg(*_categorical_aggs(cols, None))
    return agg.select(F.col(cols.cliente), F.col(cols.pais).alias("pais_cd"),
                      F.col(cols.madurez).alias("madurez_digital_cd"),
                      F.col(cols.frecuencia).alias("frecuencia_visitas_cd"),
                      _maturity_score(F.col(cols.madurez), spec.maturity_scores).alias("madurez_digital_encoded"))


# --------------------------------------------------------------- feature table
STRING_FEATURES = ("ultimo_canal", "penultimo_canal", "transicion_canal",
                   "pais_cd", "madurez_digital_cd", "frecuencia_visitas_cd")


def _final_fill(df: DataFrame) -> DataFrame:
    """Every null becomes 0, written as '0' in string columns."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in STRING_FEATURES:
            out.append(F.coalesce(c, F.lit("0")).alias(f.name))
        elif f.name in ("target",) or f.name == "fecha_pedido_dt":
            out.append(c)
        elif f.name != "cliente_id":
            out.append(F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def feature_table(tx: DataFrame, spec: FeatureSpec = FEATURES, cols: Columns = COLUMNS,
                  ref_date=None, profile: dict | None = None) -> DataFrame:
    """M15 fused: customers with >= ``min_orders`` orders; features over all
    but the last order; target from the last order; ``fecha_pedido_dt`` the
    customer's latest order date. The reference date (N6) is the maximum
    date of the historical rows, found from a recent date slice
    (``historical_reference_date``) unless ``ref_date`` is given. A
    ``customer_profile`` that is at hand can be passed, and is not computed again."""
    check_transactions(tx, cols, features=True)
    if profile is None:  # one pass: hot customers + date bounds
        profile = customer_profile(tx, cols, spec.hot_rows)
    x = with_positions(tx, cols, spec.hot_rows, profile).filter(F.col(N) >= spec.min_orders)
    hist = F.col(RN) < F.col(N)
    last = F.col(RN) == F.col(N)
    fecha_type = x.schema[cols.fecha].dataType
    if ref_date is not None:
        ref = _as_literal(ref_date, fecha_type) if not isinstance(ref_date, str) else F.lit(ref_date).cast(fecha_type)
    elif spec.min_orders <= 2:
        ref = _as_literal(historical_reference_date(tx, cols, profile=profile), fecha_type)
    else:  # eligibility needs full counts: scalar subquery over the windowed orders
        ref = x.filter(hist).agg(F.max(F.col(cols.fecha))).scalar()

    agg = x.groupBy(cols.cliente).agg(
        *_history_aggs(cols, spec, hist),
        *_temporal_aggs(cols, spec, hist, ref, fecha_type),
        *_sequence_aggs(cols, hist),
        *_categorical_aggs(cols, hist),
        F.max(F.when(last, F.col(cols.canal))).alias("_label_channel"),
        F.max(F.col(cols.fecha)).alias("_last_date"),
    )
    tvals = _temporal_values(ref, fecha_type)
    svals = _sequence_values()
    active = F.col("_n_long") > 0
    temporal = [F.when(active, tvals[c]).alias(c) for c in TEMPORAL_COLS]  # N10: inactive -> 0
    out = agg.select(
        F.col(cols.cliente),
        *_history_select(spec),
        *temporal,
        *[svals[c].alias(c) for c in SEQUENCE_COLS],
        F.col(cols.pais).alias("pais_cd"),
        F.col(cols.madurez).alias("madurez_digital_cd"),
        F.col(cols.frecuencia).alias("frecuencia_visitas_cd"),
        _maturity_score(F.col(cols.madurez), spec.maturity_scores).alias("madurez_digital_encoded"),
        F.coalesce(F.col("_label_channel") == spec.digital, F.lit(False)).cast("int").alias("target"),
        F.col("_last_date").alias("fecha_pedido_dt"),
    )
    return _final_fill(out)


def feature_table_joined(tx: DataFrame, spec: FeatureSpec = FEATURES, cols: Columns = COLUMNS) -> DataFrame:
    """M15 as four builders + label + last date joined on the customer.
    Same result as ``feature_table``; kept as the readable specification and
    for the equality test."""
    from cauce.operators.prepare import eligible_orders, label_last_order

    x = with_positions(tx, cols, spec.hot_rows)
    hist = eligible_orders(x.drop(RN, N, LAG1, BRK), spec, cols, hot_rows=spec.hot_rows)
    k = cols.cliente
    df = (history_features(hist, spec, cols)
          .join(temporal_features(hist, spec, cols), k, "left")
          .join(sequence_features(hist, cols, spec), k, "left")
          .join(categorical_features(hist, spec, cols), k, "left")
          .join(label_last_order(tx, spec, cols, spec.hot_rows).select(k, "target"), k, "left")
          .join(tx.groupBy(k).agg(F.max(F.col(cols.fecha)).alias("fecha_pedido_dt")), k, "left"))
    df = df.withColumn("target", F.coalesce(F.col("target"), F.lit(0)).cast("int"))
    return _final_fill(df.select(k, *[F.col(c) for c in spec.history_columns() + TEMPORAL_COLS
                                      + SEQUENCE_COLS + CATEGORICAL_COLS], "target", "fecha_pedido_dt"))
