"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over
the driver's tables; most have a DuckDB twin in ``ORACLE``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.functions import round_doubles
from cauce.operators import features as feat
from cauce.operators import prepare
from cauce.plans import oracle as O
from cauce.sources import stored_transactions, write_transactions
from cauce.sources.fixtures import events_transactions, orders_transactions
from cauce.spec import FeatureSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
EVENTS_SPEC = FeatureSpec(trend_days=10, recent_days=3)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir), 6)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tx_a(spark, sf_dir):
    return prepare.with_order_gap(orders_transactions(spark, sf_dir))


def tx_b(spark, sf_dir):
    return prepare.with_order_gap(events_transactions(spark, sf_dir))


def features_a(spark, sf_dir):
    # the gap is computed inside the feature build's own (skew-guarded) window
    return feat.feature_table(orders_transactions(spark, sf_dir))


# ------------------------------------------------------------------ scans, prep
@register("tx_scan", O.rounded(f"WITH {O.tx_ctes('A')} SELECT * FROM tx", ["facturacion_usd_val"]))
def q_tx_scan(spark, sf_dir):
    """S1/S3 + fixture A: the transaction table with the order gap."""
    return tx_a(spark, sf_dir)


@register("order_gap_days", f"""WITH {O.tx_ctes('A')}
SELECT cliente_id, pedido_id, fecha_pedido_dt, dias_desde_ultimo_pedido FROM tx""")
def q_order_gap(spark, sf_dir):
    """W1, P9, P10."""
    return tx_a(spark, sf_dir).select("cliente_id", "pedido_id", "fecha_pedido_dt", "dias_desde_ultimo_pedido")


@register("eligible_orders", O.rounded(f"""WITH {O.tx_ctes('A')}
SELECT cliente_id, pedido_id, fecha_pedido_dt, canal_pedido_cd, facturacion_usd_val, materiales_distintos_val,
       pais_cd, madurez_digital_cd, frecuencia_visitas_cd, dias_desde_ultimo_pedido FROM hist""",
                                     ["facturacion_usd_val"]))
def q_eligible(spark, sf_dir):
    """Historical orders of customers with >= 2 orders, last removed."""
    return prepare.eligible_orders(orders_transactions(spark, sf_dir))


@register("label_last_order", f"""WITH {O.tx_ctes('A')}
SELECT cliente_id, pedido_id, fecha_pedido_dt, canal_pedido_cd AS canal_ultimo_pedido,
       CAST(COALESCE(canal_pedido_cd = 'DIGITAL', false) AS INTEGER) AS target
FROM pos WHERE n >= 2 AND rn = n""")
def q_label(spark, sf_dir):
    """W7, P17."""
    return prepare.label_last_order(orders_transactions(spark, sf_dir))


@register("channel_lags", f"""WITH {O.tx_ctes('A')}
SELECT cliente_id, pedido_id, fecha_pedido_dt, canal_pedido_cd,
  LAG(canal_pedido_cd, 1) OVER ({O.ORDER_W}) AS canal_lag_1,
  LAG(canal_pedido_cd, 2) OVER ({O.ORDER_W}) AS canal_lag_2,
  LAG(canal_pedido_cd, 3) OVER ({O.ORDER_W}) AS canal_lag_3
FROM tx""")
def q_lags(spark, sf_dir):
    """W2."""
    return prepare.channel_lags(orders_transactions(spark, sf_dir), 3)


@register("channel_runs", f"""WITH {O.tx_ctes('A')},
g AS (SELECT *, SUM(CASE WHEN lag1 = canal_pedido_cd THEN 0 ELSE 1 END)
        OVER (PARTITION BY cliente_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS grupo_racha FROM pos)
SELECT cliente_id, CAST(grupo_racha AS BIGINT) AS grupo_racha, MAX(canal_pedido_cd) AS canal_pedido_cd,
       arg_min(pedido_id, rn) AS primer_pedido_id, COUNT(*) AS longitud_racha
FROM g GROUP BY cliente_id, grupo_racha""")
def q_runs(spark, sf_dir):
    """W4, W5, W6."""
    return prepare.channel_runs(orders_transactions(spark, sf_dir))


# --------------------------------------------------------------------- features
@register("feat_history", O.rounded(f"WITH {O.tx_ctes('A')} {O.history_sql('pos')}",
                                    [c for c in O.FEATURE_DOUBLES if c in O.HISTORY_COLS]))
def q_hist(spark, sf_dir):
    """A1, A2, A3 over all orders."""
    return feat.history_features(orders_transactions(spark, sf_dir))


@register("feat_temporal", O.rounded(f"WITH {O.tx_ctes('A')} {O.temporal_sql('pos')}",
                                     ["pct_digital_90d", "pct_digital_30d", "tendencia_digital"]))
def q_temp(spark, sf_dir):
    """A4, A5, A6, P3, P11, P13 over all orders."""
    return feat.temporal_features(orders_transactions(spark, sf_dir))


@register("feat_temporal_events", O.rounded(
    f"WITH {O.tx_ctes('B')} {O.temporal_sql('pos', 10, 3, is_date=False)}",
    ["pct_digital_90d", "pct_digital_30d", "tendencia_digital"]))
def q_temp_ev(spark, sf_dir):
    """A4-A6 on sub-day timestamps (fixture B, 10/3-day windows)."""
    return feat.temporal_features(events_transactions(spark, sf_dir), EVENTS_SPEC)


@register("feat_sequence", f"WITH {O.tx_ctes('A')} {O.sequence_sql('pos')}")
def q_seq(spark, sf_dir):
    """W3-W6, W10, P14."""
    return feat.sequence_features(orders_transactions(spark, sf_dir))


@register("feat_categorical", O.rounded(f"WITH {O.tx_ctes('A')} {O.categorical_sql('pos')}",
                                        ["madurez_digital_encoded"]))
def q_cat(spark, sf_dir):
    """A7, P16."""
    return feat.categorical_features(orders_transactions(spark, sf_dir))


@register("feature_table", O.rounded(f"WITH {O.feature_table_ctes('A')} SELECT * FROM ft", O.FEATURE_DOUBLES))
def q_feature_table(spark, sf_dir):
    """The full feature table (flagship)."""
    return features_a(spark, sf_dir)


# --------------------------------------------------------------- batch 2 helpers
from cauce.operators import encode as enc_ops  # noqa: E402
from cauce.operators import metrics as met  # noqa: E402
from cauce.operators import profile as prof  # noqa: E402
from cauce.operators import segment as seg  # noqa: E402
from cauce.operators import split as spl  # noqa: E402
from cauce.sources.fixtures import scored_rows  # noqa: E402
from cauce.sources.tables import scan_features  # noqa: E402

FD = O.FEATURE_DOUBLES


def feature_stage(spark, sf_dir):
    """The persisted feature table that modelling reads (the reference's
    hand-off table): queries running several jobs over it read it once."""
    from cauce.session import materialize
    return materialize(features_a(spark, sf_dir))


def scored_a(spark, sf_dir, score_col="pct_digital_historico"):
    """Fixture C, staged: only (customer, label, score) is written."""
    from cauce.session import materialize
    return materialize(scored_rows(features_a(spark, sf_dir), score_col))


def split_a(spark, sf_dir):
    return spl.temporal_split(feature_stage(spark, sf_dir), "fecha_pedido_dt", 1)


@register("feat_except", O.rounded(O.with_ft("SELECT * EXCLUDE (ultimo_canal) FROM ft"),
                                   [c for c in FD]))
def q_except(spark, sf_dir):
    """The feature table without ``ultimo_canal``."""
    return scan_features(features_a(spark, sf_dir))


@register("feat_preview", O.rounded(O.with_ft("SELECT * FROM ft ORDER BY cliente_id LIMIT 10"), FD))
def q_preview(spark, sf_dir):
    """10-row preview in key order."""
    return prof.preview(features_a(spark, sf_dir), 10)


@register("feat_count", O.with_ft("SELECT COUNT(1) AS n_rows FROM ft"))
def q_count(spark, sf_dir):
    """S8."""
    return prof.row_count(features_a(spark, sf_dir))


@register("schema_profile", O.schema_profile_sql())
def q_schema(spark, sf_dir):
    """Columns, types, non-null counts."""
    return prof.schema_profile(features_a(spark, sf_dir))


@register("describe_features", O.describe_sql())
def q_describe(spark, sf_dir):
    """A10: exact describe of every numeric column."""
    return prof.describe(feature_stage(spark, sf_dir))


@register("channel_counts", O.with_ft(
    "SELECT ultimo_canal, COUNT(*) AS n FROM ft WHERE ultimo_canal IS NOT NULL GROUP BY ultimo_canal"))
def q_channel_counts(spark, sf_dir):
    """Value counts of the last channel."""
    return prof.value_counts(features_a(spark, sf_dir), "ultimo_canal")


@register("top_transitions", O.with_ft(
    "SELECT transicion_canal, COUNT(*) AS n FROM ft WHERE transicion_canal IS NOT NULL "
    "GROUP BY transicion_canal ORDER BY n DESC, transicion_canal ASC LIMIT 15"))
def q_top_transitions(spark, sf_dir):
    """15 most frequent transitions."""
    return prof.top_values(features_a(spark, sf_dir), "transicion_canal", 15)


@register("trend_counts", f"""WITH {O.tx_ctes('A')}
SELECT COUNT(*) FILTER (WHERE tendencia_digital > 0.1) AS clientes_acelerando,
       COUNT(*) FILTER (WHERE tendencia_digital < -0.1) AS clientes_desacelerando
FROM ({O.temporal_sql('pos')})""")
def q_trend_counts(spark, sf_dir):
    """A12 over the temporal features of all orders."""
    return prof.trend_counts(feat.temporal_features(orders_transactions(spark, sf_dir)))


@register("target_distribution", O.rounded(O.with_ft(
    "SELECT target, COUNT(*) AS clientes, ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM ft), 2) AS porcentaje "
    "FROM ft GROUP BY target"), ["porcentaje"]))
def q_target_dist(spark, sf_dir):
    """A13."""
    return prof.target_distribution(features_a(spark, sf_dir))


@register("null_profile", O.null_profile_sql())
def q_nulls(spark, sf_dir):
    """Top-10 null counts."""
    return prof.null_profile(features_a(spark, sf_dir), 10)


@register("target_correlation", O.correlation_sql())
def q_corr(spark, sf_dir):
    """A15 + T3: top-15 correlations with the target."""
    return prof.target_correlation(features_a(spark, sf_dir), "target", 15)


@register("country_nunique", O.with_ft("SELECT COUNT(DISTINCT pais_cd) AS n_paises FROM ft"))
def q_countries(spark, sf_dir):
    """A26."""
    return prof.distinct_count(features_a(spark, sf_dir), "pais_cd", "n_paises")


@register("score_histogram", O.histogram_sql())
def q_hist50(spark, sf_dir):
    """50-bin histogram of the score."""
    return prof.histogram(scored_a(spark, sf_dir), "propension_digital", 50)


@register("score_histogram_by_class", O.histogram_sql("target"))
def q_hist_class(spark, sf_dir):
    """50-bin histograms per true class, each on its own range."""
    return prof.histogram(scored_a(spark, sf_dir), "propension_digital", 50, by="target")


@register("temporal_split", O.with_ft("SELECT cliente_id, fecha_pedido_dt, target, split FROM sp", O.SPLIT_CTE))
def q_temporal_split(spark, sf_dir):
    """M1: last month of last-order dates is the test set."""
    return split_a(spark, sf_dir).select("cliente_id", "fecha_pedido_dt", "target", "split")


@register("split_summary", O.rounded(O.with_ft(
    "SELECT split, COUNT(*) AS n_clientes, AVG(CAST(target AS DOUBLE)) AS target_mean, "
    "MIN(fecha_pedido_dt) AS fecha_min, MAX(fecha_pedido_dt) AS fecha_max FROM sp GROUP BY split",
    O.SPLIT_CTE), ["target_mean"]))
def q_split_summary(spark, sf_dir):
    """A27."""
    return spl.split_summary(split_a(spark, sf_dir))


def _train(spark, sf_dir):
    return split_a(spark, sf_dir).filter(F.col("split") == "train")


@register("target_encoding", O.encoding_sql(True, 50))
def q_target_encoding(spark, sf_dir):
    """A8 + J5 + P22: smoothed country encoding fitted on train (m=50)."""
    sp = split_a(spark, sf_dir)
    enc = enc_ops.TargetEncoder("pais_cd", "target", 50).fit(sp.filter(F.col("split") == "train"))
    return enc.transform(sp).select("cliente_id", "split", "pais_cd", "pais_cd_target_encoded")


@register("target_encoding_folds", O.fold_encoding_sql(5, 50))
def q_fold_encoding(spark, sf_dir):
    """A8 without the rows' own labels: country encoding of the training rows
    from the other four of five folds (m=50)."""
    train = split_a(spark, sf_dir).filter(F.col("split") == "train")
    out = enc_ops.TargetEncoder("pais_cd", "target", 50).out_of_fold(train, 5)
    return out.select("cliente_id", "pais_cd", "pais_cd_target_encoded")


@register("mean_encoding", O.encoding_sql(False))
def q_mean_encoding(spark, sf_dir):
    """Unsmoothed encoding fitted on train, applied to every customer."""
    ft = feature_stage(spark, sf_dir)
    train = spl.temporal_split(ft).filter(F.col("split") == "train")
    enc = enc_ops.TargetEncoder("pais_cd", "target", smoothing="none").fit(train)
    return enc.transform(ft).select("cliente_id", "pais_cd", "pais_cd_target_encoded")


@register("model_matrix", O.model_matrix_sql())
def q_model_matrix(spark, sf_dir):
    """M3 + P7 + P20: numeric + one-hot (vocabulary from train), long form."""
    full = feature_stage(spark, sf_dir)
    ft = scan_features(full)
    train = spl.temporal_split(full).filter(F.col("split") == "train")
    vocab = enc_ops.OneHotVocabulary().fit(scan_features(train), tuple(
        ["ultimo_canal", *O.MATRIX_CATS]))
    mat, names, _ = enc_ops.model_matrix(ft, vocab.columns, vocab)
    wide = mat.select("cliente_id", *[F.col(c).cast("double").alias(c) for c in names])
    return wide.unpivot("cliente_id", names, "feature", "value")


@register("confusion_metrics", O.confusion_sql())
def q_confusion(spark, sf_dir):
    """A16, A17, P25 at threshold 0.5."""
    return met.confusion_metrics(scored_a(spark, sf_dir), 0.5)


@register("roc_auc", O.rounded(O.with_ft(f"SELECT {O.AUC} AS roc_auc", O.cum_cte()), ["roc_auc"]))
def q_auc(spark, sf_dir):
    """A18."""
    return met.roc_auc(scored_a(spark, sf_dir))


@register("average_precision", O.rounded(O.with_ft(f"SELECT {O.AP} AS avg_precision", O.cum_cte()),
                                         ["avg_precision"]))
def q_ap(spark, sf_dir):
    """A19."""
    return met.average_precision(scored_a(spark, sf_dir))


@register("metrics_all", O.rounded(O.with_ft(O.metrics_all_body(), O.cum_cte()), O.METRIC_DOUBLES))
def q_metrics_all(spark, sf_dir):
    """Ten metrics in one row."""
    return met.metrics_all(scored_a(spark, sf_dir), 0.5)


@register("roc_curve", O.rounded(O.with_ft(
    "SELECT CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr "
    "UNION ALL SELECT score, cum_neg / (SELECT q FROM tt), cum_pos / (SELECT p FROM tt) FROM cu",
    O.cum_cte()), ["threshold", "fpr", "tpr"]))
def q_roc_curve(spark, sf_dir):
    """A30."""
    return met.roc_curve(scored_a(spark, sf_dir))


@register("roc_curve_thin", O.rounded(O.with_ft(
    "SELECT CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr "
    "UNION ALL SELECT score, cum_neg / (SELECT q FROM tt), cum_pos / (SELECT p FROM tt) "
    "FROM (SELECT *, ROW_NUMBER() OVER w AS i, LEAD(pos) OVER w AS np, LEAD(neg) OVER w AS nn FROM cu "
    "WINDOW w AS (ORDER BY score DESC)) WHERE i = 1 OR np IS NULL OR np <> pos OR nn <> neg",
    O.cum_cte()), ["threshold", "fpr", "tpr"]))
def q_roc_thin(spark, sf_dir):
    """A30 without the inner points of straight stretches."""
    return met.roc_curve(scored_a(spark, sf_dir), drop_intermediate=True)


@register("pr_curve", O.rounded(O.with_ft(
    "SELECT score AS threshold, CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg) AS precision, "
    "cum_pos / (SELECT p FROM tt) AS recall FROM cu "
    "UNION ALL SELECT NULL, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)", O.cum_cte()), ["threshold", "precision", "recall"]))
def q_pr_curve(spark, sf_dir):
    """A31."""
    return met.pr_curve(scored_a(spark, sf_dir))


@register("lift_top20", O.rounded(O.with_ft(O.lift_body()), ["precision_top_k", "baseline", "lift_score"]))
def q_lift(spark, sf_dir):
    """Lift in the top 20 % by score (ties by customer id)."""
    return met.lift_score(scored_a(spark, sf_dir), 0.20)


@register("segments_decile", O.rounded(O.with_ft(O.segments_select(10)), ["propension_digital"]))
def q_deciles(spark, sf_dir):
    """Deciles D10..D1."""
    return seg.segment_customers(scored_a(spark, sf_dir), "propension_digital", 10).select(
        "cliente_id", "propension_digital", "segmento_propension")


@register("segments_quartile", O.rounded(O.with_ft(O.segments_select(4)), ["propension_digital"]))
def q_quartiles(spark, sf_dir):
    """M7: quartiles S1..S4."""
    return seg.segment_customers(scored_a(spark, sf_dir), "propension_digital", 4).select(
        "cliente_id", "propension_digital", "segmento_propension")


SEG_CTE = f""",
sg AS (SELECT s.*, d.segmento_propension FROM sc s JOIN ({O.segments_select(10)}) d USING (cliente_id, propension_digital))"""


@register("segment_analysis", O.rounded(O.with_ft(
    "SELECT segmento_propension, COUNT(target) AS target_count, CAST(SUM(target) AS BIGINT) AS target_sum, "
    "ROUND(AVG(CAST(target AS DOUBLE)), 4) AS target_mean, ROUND(MIN(propension_digital), 4) AS propension_digital_min, "
    "ROUND(MAX(propension_digital), 4) AS propension_digital_max, ROUND(AVG(propension_digital), 4) AS "
    "propension_digital_mean FROM sg GROUP BY segmento_propension", SEG_CTE),
    ["target_mean", "propension_digital_min", "propension_digital_max", "propension_digital_mean"]))
def q_segment_analysis(spark, sf_dir):
    """A22 + P6."""
    s = seg.segment_customers(scored_a(spark, sf_dir), "propension_digital", 10)
    return seg.segment_analysis(s)


@register("segment_lift", O.rounded(O.with_ft(
    "SELECT segmento_propension, AVG(CAST(target AS DOUBLE)) * 100 AS tasa_conversion, "
    "AVG(CAST(target AS DOUBLE)) / (SELECT AVG(CAST(target AS DOUBLE)) FROM sg) AS lift "
    "FROM sg GROUP BY segmento_propension", SEG_CTE), ["tasa_conversion", "lift"]))
def q_segment_lift(spark, sf_dir):
    """A23 + A24."""
    s = seg.segment_customers(scored_a(spark, sf_dir), "propension_digital", 10)
    return seg.segment_lift(s)


def score_base_a(spark, sf_dir):
    ft = feature_stage(spark, sf_dir)
    base = ft.select("cliente_id", F.col("pct_digital_historico").alias("propension_digital"),
                     F.col("madurez_digital_cd").alias("madurez_digital"), "pct_digital_historico")
    return seg.segment_customers(base, "propension_digital", 10)


SCORE_BASE_SQL = """
SELECT b.cliente_id, b.propension_digital, b.madurez_digital, b.pct_digital_historico, d.segmento_propension
FROM (SELECT cliente_id, pct_digital_historico AS propension_digital, madurez_digital_cd AS madurez_digital,
             pct_digital_historico FROM ft) b
JOIN ({seg}) d USING (cliente_id)"""


@register("score_base", O.rounded(O.with_ft(SCORE_BASE_SQL.format(seg=O.segments_select(10))),
                                  ["propension_digital", "pct_digital_historico"]))
def q_score_base(spark, sf_dir):
    """M10 (oracle variant: the score is the historical digital share)."""
    return score_base_a(spark, sf_dir)


@register("scoring_summary", O.rounded(O.with_ft(
    "SELECT segmento_propension, madurez_digital, COUNT(cliente_id) AS q_clientes, AVG(propension_digital) AS prop_avg, "
    "MIN(propension_digital) AS prop_min, MAX(propension_digital) AS prop_max FROM sbase GROUP BY ALL ORDER BY ALL",
    ",\nsbase AS (" + SCORE_BASE_SQL.format(seg=O.segments_select(10)) + ")"), ["prop_avg", "prop_min", "prop_max"]))
def q_scoring_summary(spark, sf_dir):
    """A25 + T7: the report SQL over the scored base."""
    return seg.scoring_summary(score_base_a(spark, sf_dir))


# ----------------------------------------------------------- batch 3: trials, model
from cauce.operators import attribution  # noqa: E402
from cauce.operators import model as mdl  # noqa: E402
from cauce.operators import tuning as tun  # noqa: E402
from cauce.session import materialize, stage_path  # noqa: E402
from cauce.sources.sinks import RunLog, write_table  # noqa: E402


def _metric_cmp_sql() -> str:
    parts, ctes = [], ""
    for suf, score, name in (("_b", "madurez_digital_encoded", "Baseline"), ("_o", "pct_digital_historico",
                                                                              "Optimizado")):
        ctes += O.cum_cte(score, "ft", suf)
        body = O.metrics_all_body(score, "ft", suf)
        lift = O.lift_body(score, "ft")
        ctes += f",\nm{suf} AS (SELECT '{name}' AS modelo, m.*, l.lift_score FROM ({body}) m, ({lift}) l)"
    cols = list(tun.COMPARE_METRICS)
    rows = " UNION ALL ".join(
        f"SELECT modelo, {', '.join(f'ROUND({c}, 4) AS {c}' for c in cols)} FROM m{s}" for s in ("_b", "_o"))
    diff = "SELECT 'Mejora' AS modelo, " + ", ".join(
        f"ROUND(o.{c} - b.{c}, 4) AS {c}" for c in cols) + " FROM m_o o, m_b b"
    return O.rounded(O.with_ft(f"{rows} UNION ALL {diff}", ctes), cols)


@register("metric_comparison", _metric_cmp_sql())
def q_metric_comparison(spark, sf_dir):
    """The maturity score (baseline) against the historical digital
    share (tuned) on the same customers."""
    ft = feature_stage(spark, sf_dir)
    base = tun.metric_row(scored_rows(ft, "madurez_digital_encoded"), "Baseline")
    tuned = tun.metric_row(scored_rows(ft, "pct_digital_historico"), "Optimizado")
    return tun.metric_comparison(base, tuned)


def _threshold_trials_sql() -> str:
    parts = []
    for i in range(1, 10):
        t = i / 10
        c = O.confusion_select("propension_digital", "sc", f"CAST({t!r} AS DOUBLE)")
        parts.append(f"SELECT 'thresholds' AS study, {i} AS trial, CAST({t!r} AS DOUBLE) AS threshold, "
                     f"COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1_score FROM {c}")
    return ",\ntr AS (" + " UNION ALL ".join(parts) + ")"


@register("best_so_far", O.rounded(O.with_ft(
    "SELECT study, trial, threshold, f1_score, MAX(f1_score) OVER (PARTITION BY study ORDER BY trial "
    "ROWS UNBOUNDED PRECEDING) AS best_f1_score_so_far FROM tr", _threshold_trials_sql()),
    ["threshold", "f1_score", "best_f1_score_so_far"]))
def q_best_so_far(spark, sf_dir):
    """W8 over a trials table of decision thresholds scored by F1."""
    return tun.best_so_far(tun.threshold_trials(scored_a(spark, sf_dir)), "f1_score")


@register("top_trials", O.rounded(O.with_ft(
    "SELECT trial, ROUND(threshold, 4) AS threshold, ROUND(f1_score, 4) AS f1_score FROM tr "
    "ORDER BY f1_score DESC NULLS LAST, trial ASC LIMIT 10", _threshold_trials_sql()), ["threshold", "f1_score"]))
def q_top_trials(spark, sf_dir):
    """T5 + T8: the 10 best trials."""
    return tun.top_trials(tun.threshold_trials(scored_a(spark, sf_dir)), "f1_score", 10, ("threshold",))


@register("auc_by_country", O.rounded(O.with_ft("""
SELECT pais_cd, CAST(SUM(pos + neg) AS BIGINT) AS n, CAST(SUM(pos) AS BIGINT) AS positives,
       SUM(neg * (cum_pos - pos / 2.0)) / NULLIF(CAST(SUM(pos) AS DOUBLE) * SUM(neg), 0) AS roc_auc,
       SUM(pos * (CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg))) / NULLIF(SUM(pos), 0) AS avg_precision
FROM (SELECT *, SUM(pos) OVER w AS cum_pos, SUM(neg) OVER w AS cum_neg
      FROM (SELECT pais_cd, pct_digital_historico AS score, SUM(target) AS pos, SUM(1 - target) AS neg
            FROM ft GROUP BY ALL)
      WINDOW w AS (PARTITION BY pais_cd ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
GROUP BY pais_cd"""), ["roc_auc", "avg_precision"]))
def q_auc_by_country(spark, sf_dir):
    """A18 + A19 of every country, from one grouped ranking."""
    return met.ranking_metrics_by(feature_stage(spark, sf_dir), ["pais_cd"], score="pct_digital_historico")


# ---------------------------------------------------------------- rows-only queries
# The model queries run the library's defaults: early stopping ends a fit, 50 trials make a search.
def _train_test_a(spark, sf_dir):
    # the feature table is the hand-off between feature build and modelling
    # (the reference persists it too): compute it once per query
    ft = scan_features(feature_stage(spark, sf_dir))
    return spl.train_test(ft)


def _fitted(spark, sf_dir):
    tr, te = _train_test_a(spark, sf_dir)
    return mdl.train_pipeline(tr, te)


@register("stratified_split", O.stratified_sql())
def q_stratified(spark, sf_dir):
    """M2: exact stratified 80/20 hold-out of the training customers."""
    tr, _ = _train_test_a(spark, sf_dir)
    return spl.stratified_split(tr, "target", 0.2, 42).select("cliente_id", "target", "is_validation")


@register("gbt_train_score")
def q_gbt(spark, sf_dir):
    """M4 + M5: boosted trees with early stopping, test-set probabilities."""
    pm, res = _fitted(spark, sf_dir)
    return res["scored_test"].select("cliente_id", "target", "propension_digital")


@register("feature_importance")
def q_importance(spark, sf_dir):
    """M6 + T4: top-20 importances."""
    pm, res = _fitted(spark, sf_dir)
    return res["feature_importance"]


@register("permutation_importance")
def q_perm(spark, sf_dir):
    """AUC drop of every feature, permuted."""
    tr, te = _train_test_a(spark, sf_dir)
    pm, _ = mdl.train_pipeline(tr, te)
    return mdl.permutation_importance(pm, te)


@register("customer_attribution")
def q_attribution(spark, sf_dir):
    """What each feature adds to every test customer's margin."""
    tr, te = _train_test_a(spark, sf_dir)
    pm, _ = mdl.train_pipeline(tr, te)
    explained = attribution.attributions(pm.model, pm.prepare(te), ["cliente_id"])
    return attribution.long_form(explained, pm.feature_names, ["cliente_id", "base_value", "margin"])


@register("attribution_importance")
def q_attribution_importance(spark, sf_dir):
    """Mean absolute attribution of every feature over the test customers."""
    tr, te = _train_test_a(spark, sf_dir)
    pm, _ = mdl.train_pipeline(tr, te)
    return attribution.attribution_importance(pm.model, pm.prepare(te))


def _search_inputs(spark, sf_dir):
    tr, te = _train_test_a(spark, sf_dir)
    enc = enc_ops.TargetEncoder("pais_cd", "target", 50).fit(tr)
    mat, names, vocab = enc_ops.model_matrix(enc.transform(tr), mdl.MODEL.categoricals)
    mat = materialize(spl.stratified_split(mat, "target", 0.2, 42))
    test_mat = materialize(vocab.transform(enc.transform(te)))
    return mat, test_mat, names


@register("tuning_trials")
def q_tuning(spark, sf_dir):
    """M11 + M12 + W8: adaptive search of 50 trials, logged as nested runs."""
    mat, _, names = _search_inputs(spark, sf_dir)
    log = RunLog(spark, stage_path(spark, "runs"), "propension_digital")
    trials = tun.adaptive_search(mat, names, run_log=log, parent_run_id=log.start_run("search"))
    return tun.best_so_far(trials, "auc")


@register("baseline_vs_tuned")
def q_baseline_vs_tuned(spark, sf_dir):
    """M13 + M14 + A32: refit best and default configurations, compare."""
    mat, test_mat, names = _search_inputs(spark, sf_dir)
    trials = tun.adaptive_search(mat, names)
    log = RunLog(spark, stage_path(spark, "runs"), "propension_digital")
    cmp, _, _ = tun.refit_and_compare(mat, test_mat, names, tun.best_trial(trials), run_log=log,
                                      model_path=stage_path(spark, "model"))
    return cmp


@register("pipeline_full")
def q_pipeline(spark, sf_dir):
    """M8: full training pipeline with the run log; returns the metrics row."""
    tr, te = _train_test_a(spark, sf_dir)
    log = RunLog(spark, stage_path(spark, "runs"), "propension_digital")
    pm, res = mdl.train_pipeline(tr, te, run_log=log)
    m = res["metricas"]
    return spark.createDataFrame([tuple(float(m[k]) if m[k] is not None else None for k in sorted(m))],
                                 ", ".join(f"{k} double" for k in sorted(m)))


@register("score_new_customers")
def q_score_new(spark, sf_dir):
    """M9 + M10 + S5 + S10: persist the fitted model, reload it, score every
    customer, decile them, write the scored table and read it back."""
    pm, _ = _fitted(spark, sf_dir)
    path = stage_path(spark, "model")
    pm.save(path)
    loaded = mdl.PropensityModel.load(spark, path)
    scores = mdl.score_customers(loaded, scan_features(feature_stage(spark, sf_dir)))
    out = stage_path(spark, "scores")
    write_table(scores, out)
    return spark.read.parquet(out)


@register("run_log")
def q_run_log(spark, sf_dir):
    """Params, metrics and text rows of a training run, read back."""
    tr, te = _train_test_a(spark, sf_dir)
    log = RunLog(spark, stage_path(spark, "runs"), "propension_digital",
                 {"project": "cauce"})
    mdl.train_pipeline(tr, te, run_log=log)
    return log.read()


@register("feature_table_stored", ORACLE["feature_table"])
def q_feature_table_stored(spark, sf_dir):
    """M15 + S4 over orders stored by customer: the build has neither an
    exchange nor a sort of orders."""
    table = f"cauce_tx_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_transactions(orders_transactions(spark, sf_dir), table, buckets, stage_path(spark))
    return feat.feature_table(stored_transactions(spark, table))


@register("write_features", ORACLE["feature_table"])
def q_write(spark, sf_dir):
    """Write the feature table (overwrite) and read it back."""
    path = stage_path(spark, "features")
    write_table(features_a(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("schema_parity", O.parity_sql())
def q_parity(spark, sf_dir):
    """Expected model columns vs the columns built for scoring."""
    tr, te = _train_test_a(spark, sf_dir)
    _, names, vocab = enc_ops.model_matrix(tr, mdl.MODEL.categoricals)
    return mdl.schema_parity(names, vocab.transform(te).columns, spark)


@register("best_trial", O.rounded(O.with_ft(
    "SELECT trial, threshold, f1_score FROM tr ORDER BY f1_score DESC NULLS LAST, trial ASC LIMIT 1",
    _threshold_trials_sql()), ["threshold", "f1_score"]))
def q_best_trial(spark, sf_dir):
    """The trial with the best metric, as a row."""
    best = tun.best_trial(tun.threshold_trials(scored_a(spark, sf_dir)), "f1_score")
    return spark.createDataFrame([(best["trial"], best["threshold"], best["f1_score"])],
                                 "trial int, threshold double, f1_score double")


@register("score_histogram_by_segment", O.histogram_sql("segmento_propension", src="sg", extra=SEG_CTE))
def q_hist_segment(spark, sf_dir):
    """50-bin histograms per segment, each on its own range."""
    sg = seg.segment_customers(scored_a(spark, sf_dir), "propension_digital", 10)
    return prof.histogram(sg, "propension_digital", 50, by="segmento_propension")


@register("conform_dates", f"""WITH {O.tx_ctes('A')}
SELECT cliente_id, pedido_id, CAST(fecha_pedido_dt AS TIMESTAMP) AS fecha_pedido_dt,
       round(CAST(facturacion_usd_val AS DOUBLE), 6) AS facturacion_usd_val FROM tx""")
def q_conform(spark, sf_dir):
    """Dates that come as text and amounts as decimals, conformed."""
    tx = orders_transactions(spark, sf_dir)
    raw = tx.withColumn("fecha_pedido_dt", F.date_format("fecha_pedido_dt", "yyyy-MM-dd HH:mm:ss")) \
        .withColumn("facturacion_usd_val", F.col("facturacion_usd_val").cast("decimal(18,2)"))
    return prepare.conform_transactions(raw).select("cliente_id", "pedido_id", "fecha_pedido_dt", "facturacion_usd_val")
