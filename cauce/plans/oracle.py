"""DuckDB SQL for each registered query (the correctness oracle).

Written independently of the Spark code, straight from the specification:
window functions with a global ORDER BY where the Spark plan uses the
distributed prefix plan, FILTER clauses where it uses conditional
aggregates. Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

# The specification's values, written out here again on purpose: a wrong
# constant of the implementation must turn its row red.
DIGITAL_PRIORITIES = ('1-URGENT', '2-HIGH')
EVENT_COUNTRIES = ('PE', 'CO', 'MX', 'CL', 'EC')
EVENT_DIGITAL = ('click', 'purchase')
EVENT_FREQUENCY = ('SEMANAL', 'QUINCENAL', 'MENSUAL', None)
EVENT_MATURITY = ('ALTA', 'MEDIA', 'BAJA')
EVENT_PHONE = ('view',)
EVENT_SELLER = ('signup', 'error')
PHONE_PRIORITIES = ('3-MEDIUM',)
SEGMENT_MATURITY = {'AUTOMOBILE': 'ALTA', 'BUILDING': 'MEDIA', 'FURNITURE': 'BAJA', 'HOUSEHOLD': 'DESCONOCIDA'}
CHANNELS = ('DIGITAL', 'TELEFONO', 'VENDEDOR')
HISTORY_COLS = ('total_pedidos',
 'facturacion_promedio',
 'facturacion_std',
 'facturacion_total',
 'materiales_promedio',
 'materiales_std',
 'dias_ultimo_promedio',
 'pedidos_digitales_total',
 'pct_digital_historico',
 'facturacion_promedio_digital',
 'materiales_promedio_digital',
 'facturacion_promedio_telefono',
 'materiales_promedio_telefono',
 'facturacion_promedio_vendedor',
 'materiales_promedio_vendedor')
MATURITY_SCORES = {'ALTA': 0.75, 'MEDIA': 0.55, 'BAJA': 0.35}
TEMPORAL_COLS = ('pct_digital_90d',
 'pct_digital_30d',
 'tendencia_digital',
 'pedidos_ultimos_90d',
 'pedidos_ultimos_30d',
 'dias_desde_ultimo_digital')


def _q(v):
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _inlist(vals):
    return ", ".join(_q(v) for v in vals)


def _pick(values, idx_expr):
    parts = " ".join(f"WHEN {idx_expr} = {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"CAST(CASE {parts} END AS VARCHAR)"


def rounded(sql: str, double_cols) -> str:
    if not double_cols:
        return sql
    rep = ", ".join(f"round({c}, 6) AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _r"


SEG_CASE = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in SEGMENT_MATURITY.items())

TX_A_RAW = f"""
tx_raw AS (
  SELECT o.o_custkey AS cliente_id, o.o_orderkey AS pedido_id,
         CAST(o.o_orderdate AS DATE) AS fecha_pedido_dt,
         CASE WHEN o.o_orderpriority IN ({_inlist(DIGITAL_PRIORITIES)}) THEN 'DIGITAL'
              WHEN o.o_orderpriority IN ({_inlist(PHONE_PRIORITIES)}) THEN 'TELEFONO'
              ELSE 'VENDEDOR' END AS canal_pedido_cd,
         CAST(o.o_totalprice AS DOUBLE) AS facturacion_usd_val,
         CAST(m.mat AS BIGINT) AS materiales_distintos_val,
         n.n_name AS pais_cd,
         CAST(CASE c.c_mktsegment {SEG_CASE} END AS VARCHAR) AS madurez_digital_cd,
         NULLIF(o.o_orderstatus, 'P') AS frecuencia_visitas_cd
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, COUNT(DISTINCT l_partkey) AS mat FROM lineitem GROUP BY l_orderkey) m
         ON m.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey)"""

TX_B_RAW = f"""
tx_raw AS (
  SELECT user_id AS cliente_id, event_id AS pedido_id, CAST(ts AS TIMESTAMP) AS fecha_pedido_dt,
         CASE WHEN event_type IN ({_inlist(EVENT_DIGITAL)}) THEN 'DIGITAL'
              WHEN event_type IN ({_inlist(EVENT_PHONE)}) THEN 'TELEFONO'
              WHEN event_type IN ({_inlist(EVENT_SELLER)}) THEN 'VENDEDOR' END AS canal_pedido_cd,
         CAST(value AS DOUBLE) AS facturacion_usd_val,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS materiales_distintos_val,
         {_pick(EVENT_COUNTRIES, "(user_id % 5)")} AS pais_cd,
         {_pick(EVENT_MATURITY, "(user_id % 3)")} AS madurez_digital_cd,
         {_pick(EVENT_FREQUENCY, "(event_id % 4)")} AS frecuencia_visitas_cd
  FROM events)"""

ORDER_W = "PARTITION BY cliente_id ORDER BY fecha_pedido_dt ASC NULLS LAST, pedido_id ASC NULLS LAST"


def _gap(is_date: bool) -> str:
    prev = f"LAG(fecha_pedido_dt) OVER ({ORDER_W})"
    diff = f"(fecha_pedido_dt - {prev})" if is_date else f"date_sub('day', {prev}, fecha_pedido_dt)"
    return f"COALESCE(CAST({diff} AS BIGINT), 600)"


def tx_ctes(fixture: str = "A") -> str:
    raw, is_date = (TX_A_RAW, True) if fixture == "A" else (TX_B_RAW, False)
    return f"""{raw},
tx AS (SELECT *, {_gap(is_date)} AS dias_desde_ultimo_pedido FROM tx_raw),
pos AS (
  SELECT *, ROW_NUMBER() OVER ({ORDER_W}) AS rn,
         COUNT(*) OVER (PARTITION BY cliente_id) AS n,
         LAG(canal_pedido_cd) OVER ({ORDER_W}) AS lag1
  FROM tx WHERE cliente_id IS NOT NULL),
hist AS (SELECT * FROM pos WHERE n >= 2 AND rn < n)"""


def history_sql(frame: str) -> str:
    per_channel = []
    for ch in CHANNELS:
        per_channel.append(
            f"COALESCE(AVG(facturacion_usd_val) FILTER (WHERE canal_pedido_cd = '{ch}'), 0) "
            f"AS facturacion_promedio_{ch.lower()}")
        per_channel.append(
            f"COALESCE(AVG(CAST(materiales_distintos_val AS DOUBLE)) FILTER (WHERE canal_pedido_cd = '{ch}'), 0) "
            f"AS materiales_promedio_{ch.lower()}")
    pc = ",\n    ".join(per_channel)
    return f"""
  SELECT cliente_id,
    COUNT(canal_pedido_cd) AS total_pedidos,
    COALESCE(AVG(facturacion_usd_val), 0) AS facturacion_promedio,
    COALESCE(STDDEV_SAMP(facturacion_usd_val), 0) AS facturacion_std,
    COALESCE(SUM(facturacion_usd_val), 0) AS facturacion_total,
    COALESCE(AVG(CAST(materiales_distintos_val AS DOUBLE)), 0) AS materiales_promedio,
    COALESCE(STDDEV_SAMP(CAST(materiales_distintos_val AS DOUBLE)), 0) AS materiales_std,
    COALESCE(AVG(CAST(dias_desde_ultimo_pedido AS DOUBLE)), 0) AS dias_ultimo_promedio,
    COUNT(*) FILTER (WHERE canal_pedido_cd = 'DIGITAL') AS pedidos_digitales_total,
    COALESCE(CAST(COUNT(*) FILTER (WHERE canal_pedido_cd = 'DIGITAL') AS DOUBLE)
             / NULLIF(COUNT(canal_pedido_cd), 0), 0) AS pct_digital_historico,
    {pc}
  FROM {frame} GROUP BY cliente_id"""


def temporal_sql(frame: str, long_days: int = 90, short_days: int = 30, is_date: bool = True,
                 only_active: bool = True) -> str:
    r = f"(SELECT MAX(fecha_pedido_dt) FROM {frame})"
    elapsed = "date_sub('day', last_dig, r)"
    where = "WHERE n_l > 0" if only_active else ""
    return f"""
  SELECT cliente_id,
    CAST(d_l AS DOUBLE) / n_l AS pct_digital_90d,
    CASE WHEN n_s > 0 THEN CAST(d_s AS DOUBLE) / n_s ELSE CAST(0 AS DOUBLE) END AS pct_digital_30d,
    CASE WHEN n_s > 0 THEN CAST(d_s AS DOUBLE) / n_s - CAST(d_l AS DOUBLE) / n_l END AS tendencia_digital,
    n_l AS pedidos_ultimos_90d, n_s AS pedidos_ultimos_30d,
    COALESCE(CAST({elapsed} AS BIGINT), 999) AS dias_desde_ultimo_digital
  FROM (
    SELECT cliente_id, ANY_VALUE(r) AS r,
      COUNT(*) FILTER (WHERE fecha_pedido_dt >= r - INTERVAL {long_days} DAY) AS n_l,
      COUNT(*) FILTER (WHERE fecha_pedido_dt >= r - INTERVAL {long_days} DAY AND canal_pedido_cd = 'DIGITAL') AS d_l,
      COUNT(*) FILTER (WHERE fecha_pedido_dt >= r - INTERVAL {short_days} DAY) AS n_s,
      COUNT(*) FILTER (WHERE fecha_pedido_dt >= r - INTERVAL {short_days} DAY AND canal_pedido_cd = 'DIGITAL') AS d_s,
      MAX(fecha_pedido_dt) FILTER (WHERE canal_pedido_cd = 'DIGITAL') AS last_dig
    FROM (SELECT *, {r} AS r FROM {frame}) GROUP BY cliente_id) {where}"""


def sequence_sql(frame: str) -> str:
    return f"""
  SELECT a.cliente_id, a.ult AS ultimo_canal, COALESCE(a.pen, 'UNKNOWN') AS penultimo_canal,
         COALESCE(a.pen || '_TO_' || a.ult, 'UNKNOWN') AS transicion_canal,
         r.len AS racha_canal_actual
  FROM (SELECT cliente_id,
          arg_max(canal_pedido_cd, rn) FILTER (WHERE canal_pedido_cd IS NOT NULL) AS ult,
          arg_max(lag1, rn) FILTER (WHERE lag1 IS NOT NULL) AS pen,
          MAX(grp) AS last_grp
        FROM (SELECT *, SUM(CASE WHEN lag1 = canal_pedido_cd THEN 0 ELSE 1 END)
                     OVER (PARTITION BY cliente_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS grp
              FROM {frame}) GROUP BY cliente_id) a
  JOIN (SELECT cliente_id, grp, COUNT(*) AS len
        FROM (SELECT *, SUM(CASE WHEN lag1 = canal_pedido_cd THEN 0 ELSE 1 END)
                     OVER (PARTITION BY cliente_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS grp
              FROM {frame}) GROUP BY cliente_id, grp) r
    ON r.cliente_id = a.cliente_id AND r.grp = a.last_grp"""


MAT_CASE = " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in MATURITY_SCORES.items())


def categorical_sql(frame: str) -> str:
    return f"""
  SELECT cliente_id, pais_cd, madurez_digital_cd, frecuencia_visitas_cd,
         CASE madurez_digital_cd {MAT_CASE} END AS madurez_digital_encoded
  FROM (SELECT cliente_id,
          arg_max(pais_cd, rn) FILTER (WHERE pais_cd IS NOT NULL) AS pais_cd,
          arg_max(madurez_digital_cd, rn) FILTER (WHERE madurez_digital_cd IS NOT NULL) AS madurez_digital_cd,
          arg_max(frecuencia_visitas_cd, rn) FILTER (WHERE frecuencia_visitas_cd IS NOT NULL) AS frecuencia_visitas_cd
        FROM {frame} GROUP BY cliente_id)"""


FEATURE_DOUBLES = [c for c in HISTORY_COLS if c not in ("total_pedidos", "pedidos_digitales_total")] + [
    "pct_digital_90d", "pct_digital_30d", "tendencia_digital", "madurez_digital_encoded"]

STRING_FEATS = ("ultimo_canal", "penultimo_canal", "transicion_canal", "pais_cd",
                "madurez_digital_cd", "frecuencia_visitas_cd")


def feature_table_ctes(fixture: str = "A") -> str:
    """CTE chain ending in ``ft``: the full feature table, built the
    specification's way (four builders over the historical rows, left
    joins, label join, final fill)."""
    is_date = fixture == "A"
    fill = []
    for c in HISTORY_COLS:
        fill.append(f"h.{c}")
    for c in TEMPORAL_COLS:
        fill.append(f"COALESCE(t.{c}, 0) AS {c}")
    fill += ["COALESCE(s.ultimo_canal, '0') AS ultimo_canal",
             "COALESCE(s.penultimo_canal, '0') AS penultimo_canal",
             "COALESCE(s.transicion_canal, '0') AS transicion_canal",
             "COALESCE(s.racha_canal_actual, 0) AS racha_canal_actual",
             "COALESCE(k.pais_cd, '0') AS pais_cd",
             "COALESCE(k.madurez_digital_cd, '0') AS madurez_digital_cd",
             "COALESCE(k.frecuencia_visitas_cd, '0') AS frecuencia_visitas_cd",
             "COALESCE(k.madurez_digital_encoded, 0) AS madurez_digital_encoded",
             "CAST(COALESCE(l.canal_pedido_cd = 'DIGITAL', false) AS INTEGER) AS target",
             "d.fecha_pedido_dt"]
    sel = ",\n    ".join(fill)
    return f"""{tx_ctes(fixture)},
f_hist AS ({history_sql('hist')}),
f_temp AS ({temporal_sql('hist', is_date=is_date)}),
f_seq AS ({sequence_sql('hist')}),
f_cat AS ({categorical_sql('hist')}),
ft AS (
  SELECT h.cliente_id,
    {sel}
  FROM f_hist h
  LEFT JOIN f_temp t ON t.cliente_id = h.cliente_id
  LEFT JOIN f_seq s ON s.cliente_id = h.cliente_id
  LEFT JOIN f_cat k ON k.cliente_id = h.cliente_id
  LEFT JOIN (SELECT cliente_id, canal_pedido_cd FROM pos WHERE n >= 2 AND rn = n) l ON l.cliente_id = h.cliente_id
  LEFT JOIN (SELECT cliente_id, MAX(fecha_pedido_dt) AS fecha_pedido_dt FROM tx GROUP BY cliente_id) d
         ON d.cliente_id = h.cliente_id)"""


# ------------------------------------------------------------------ batch 2
FEATURE_TYPES = (
    [("cliente_id", "bigint")]
    + [(c, "bigint" if c in ("total_pedidos", "pedidos_digitales_total") else "double") for c in HISTORY_COLS]
    + [("pct_digital_90d", "double"), ("pct_digital_30d", "double"), ("tendencia_digital", "double"),
       ("pedidos_ultimos_90d", "bigint"), ("pedidos_ultimos_30d", "bigint"), ("dias_desde_ultimo_digital", "bigint")]
    + [("ultimo_canal", "string"), ("penultimo_canal", "string"), ("transicion_canal", "string"),
       ("racha_canal_actual", "bigint")]
    + [("pais_cd", "string"), ("madurez_digital_cd", "string"), ("frecuencia_visitas_cd", "string"),
       ("madurez_digital_encoded", "double")]
    + [("target", "int"), ("fecha_pedido_dt", "date")]
)
NUMERIC_FEATURES = [c for c, t in FEATURE_TYPES if t in ("bigint", "double", "int")]


def with_ft(body: str, extra: str = "") -> str:
    return f"WITH {feature_table_ctes('A')},\nsc AS (SELECT cliente_id, target, pct_digital_historico AS " \
           f"propension_digital FROM ft){extra}\n{body}"


def linspace(n: int) -> list:
    return [i * (1.0 / n) for i in range(n)] + [1.0]


def dlist(vals) -> str:
    return "[" + ", ".join(f"CAST({v!r} AS DOUBLE)" for v in vals) + "]"


def schema_profile_sql() -> str:
    parts = [f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null FROM ft"
             for i, (c, t) in enumerate(FEATURE_TYPES)]
    return with_ft(" UNION ALL ".join(parts))


def describe_sql() -> str:
    parts = []
    for c in NUMERIC_FEATURES:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS feature, COUNT({c}) AS count, AVG({x}) AS mean, STDDEV_SAMP({x}) AS std, "
            f"MIN({x}) AS min, quantile_cont({x}, 0.25) AS q25, quantile_cont({x}, 0.5) AS q50, "
            f"quantile_cont({x}, 0.75) AS q75, MAX({x}) AS max FROM ft")
    return rounded(with_ft(" UNION ALL ".join(parts)), ["mean", "std", "min", "q25", "q50", "q75", "max"])


def null_profile_sql() -> str:
    parts = [f"SELECT '{c}' AS columna, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_nulos FROM ft"
             for c, _ in FEATURE_TYPES]
    return with_ft(f"SELECT * FROM ({' UNION ALL '.join(parts)}) ORDER BY n_nulos DESC, columna ASC LIMIT 10")


def correlation_sql() -> str:
    parts = []
    for c in NUMERIC_FEATURES:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS feature, covar_pop({x}, CAST(target AS DOUBLE)) / "
                     f"NULLIF(stddev_pop({x}) * stddev_pop(CAST(target AS DOUBLE)), 0) AS correlation FROM ft")
    body = f"SELECT * FROM ({' UNION ALL '.join(parts)}) ORDER BY correlation DESC NULLS LAST, feature ASC LIMIT 15"
    return rounded(with_ft(body), ["correlation"])


def histogram_sql(by: str | None = None, bins: int = 50, src: str = "sc", extra: str = "") -> str:
    g = f"{by}, " if by else ""
    join = f"JOIN rg USING ({by})" if by else "CROSS JOIN rg"
    body = f"""
SELECT {g}bin, lo + bin * (hi - lo) / {bins} AS bin_lo, lo + (bin + 1) * (hi - lo) / {bins} AS bin_hi, COUNT(*) AS n
FROM (SELECT {g}lo, hi, CAST(LEAST(FLOOR((x - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin
      FROM (SELECT {g}CAST(propension_digital AS DOUBLE) AS x FROM {src} WHERE propension_digital IS NOT NULL) s
      {join})
GROUP BY {g}bin, lo, hi"""
    extra += f""",
rg AS (SELECT {g}CASE WHEN MIN(propension_digital) = MAX(propension_digital) THEN MIN(propension_digital) - 0.5
                    ELSE MIN(propension_digital) END AS lo,
              CASE WHEN MIN(propension_digital) = MAX(propension_digital) THEN MAX(propension_digital) + 0.5
                    ELSE MAX(propension_digital) END AS hi
       FROM {src} WHERE propension_digital IS NOT NULL {"GROUP BY " + by if by else ""})"""
    return rounded(with_ft(body, extra), ["bin_lo", "bin_hi"])


SPLIT_CTE = """,
sp AS (SELECT cliente_id, fecha_pedido_dt, target, pais_cd,
              CASE WHEN fecha_pedido_dt < (SELECT MAX(fecha_pedido_dt) FROM ft) - INTERVAL 1 MONTH THEN 'train'
                   WHEN fecha_pedido_dt >= (SELECT MAX(fecha_pedido_dt) FROM ft) - INTERVAL 1 MONTH THEN 'test'
              END AS split
       FROM ft WHERE fecha_pedido_dt IS NOT NULL)"""


def encoding_sql(smoothed: bool, m: int = 50) -> str:
    if smoothed:
        enc = (f"SELECT pais_cd, w * mean + (1 - w) * (SELECT gm FROM g) AS e FROM (SELECT *, "
               f"1 / (1 + exp(-(CAST(cnt AS DOUBLE) - {m}) / CAST({m} AS DOUBLE))) AS w FROM st)")
        cols, src, alias = "sp.cliente_id, sp.split, sp.pais_cd", "sp", "sp"
    else:
        enc = "SELECT pais_cd, mean AS e FROM st"
        cols, src, alias = "f.cliente_id, f.pais_cd", "ft f", "f"
    extra = SPLIT_CTE + f""",
tr AS (SELECT * FROM sp WHERE split = 'train'),
g AS (SELECT AVG(CAST(target AS DOUBLE)) AS gm FROM tr),
st AS (SELECT pais_cd, AVG(CAST(target AS DOUBLE)) AS mean, COUNT(target) AS cnt FROM tr
       WHERE pais_cd IS NOT NULL GROUP BY pais_cd),
enc AS ({enc})"""
    body = (f"SELECT {cols}, COALESCE(enc.e, (SELECT gm FROM g)) AS pais_cd_target_encoded "
            f"FROM {src} LEFT JOIN enc ON enc.pais_cd = {alias}.pais_cd")
    return rounded(with_ft(body, extra), ["pais_cd_target_encoded"])


MATRIX_CATS = ("penultimo_canal", "transicion_canal", "madurez_digital_cd", "frecuencia_visitas_cd")
MATRIX_NUMERIC = [c for c in NUMERIC_FEATURES if c not in ("cliente_id", "target")]


def model_matrix_sql() -> str:
    nums = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MATRIX_NUMERIC)
    unp = ", ".join(MATRIX_NUMERIC)
    parts = [f"SELECT cliente_id, feature, value FROM (SELECT cliente_id, {nums} FROM ft) "
             f"UNPIVOT (value FOR feature IN ({unp}))"]
    for c in MATRIX_CATS:
        parts.append(
            f"SELECT f.cliente_id, '{c}_' || v.lvl AS feature, "
            f"CAST(CASE WHEN f.{c} = v.lvl THEN 1 ELSE 0 END AS DOUBLE) AS value "
            f"FROM ft f JOIN (SELECT DISTINCT {c} AS lvl FROM ft JOIN sp USING (cliente_id) "
            f"WHERE sp.split = 'train' AND {c} IS NOT NULL) v ON true "
            f"WHERE v.lvl > (SELECT MIN({c}) FROM ft JOIN sp USING (cliente_id) WHERE sp.split = 'train')")
    return rounded(with_ft(" UNION ALL ".join(parts), SPLIT_CTE), ["value"])


def cum_cte(score: str = "propension_digital", src: str = "sc", suffix: str = "") -> str:
    st, cu, tt = f"st{suffix}", f"cu{suffix}", f"tt{suffix}"
    return f""",
{st} AS (SELECT CAST({score} AS DOUBLE) AS score, SUM(target) AS pos, SUM(1 - target) AS neg, COUNT(*) AS cnt
       FROM {src} WHERE {score} IS NOT NULL GROUP BY 1),
{cu} AS (SELECT *, SUM(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
                 SUM(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg FROM {st}),
{tt} AS (SELECT CAST(SUM(pos) AS DOUBLE) AS p, CAST(SUM(neg) AS DOUBLE) AS q FROM {st})"""


def auc(suffix: str = "") -> str:
    tt = f"tt{suffix}"
    return (f"(SELECT SUM(neg * (cum_pos - pos / 2.0)) / ((SELECT p FROM {tt}) * (SELECT q FROM {tt})) "
            f"FROM cu{suffix})")


def ap(suffix: str = "") -> str:
    return (f"(SELECT SUM(pos * (CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg))) / (SELECT p FROM tt{suffix}) "
            f"FROM cu{suffix})")


AUC, AP = auc(), ap()


def confusion_select(score: str = "propension_digital", src: str = "sc", t: float = 0.5) -> str:
    return f"""(SELECT tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives,
   COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS precision,
   COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS recall,
   COALESCE(CAST(tn AS DOUBLE) / NULLIF(tn + fp, 0), 0) AS specificity
 FROM (SELECT COUNT(*) FILTER (WHERE {score} >= {t} AND target = 1) AS tp,
              COUNT(*) FILTER (WHERE {score} >= {t} AND target <> 1) AS fp,
              COUNT(*) FILTER (WHERE {score} < {t} AND target <> 1) AS tn,
              COUNT(*) FILTER (WHERE {score} < {t} AND target = 1) AS fn
       FROM {src} WHERE {score} IS NOT NULL))"""


def confusion_sql() -> str:
    body = f"""SELECT *, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1_score
FROM {confusion_select()}"""
    return rounded(with_ft(body), ["precision", "recall", "specificity", "f1_score"])


def metrics_all_body(score: str = "propension_digital", src: str = "sc", suffix: str = "") -> str:
    return f"""SELECT {auc(suffix)} AS roc_auc, {ap(suffix)} AS avg_precision, precision, recall,
  COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1_score, specificity,
  true_positives, false_positives, true_negatives, false_negatives
FROM {confusion_select(score, src)}"""


METRIC_DOUBLES = ["roc_auc", "avg_precision", "precision", "recall", "f1_score", "specificity"]


def lift_body(score: str = "propension_digital", src: str = "sc", k: float = 0.2) -> str:
    return f"""SELECT n, n_top, precision_top_k, baseline,
  CASE WHEN precision_top_k IS NULL THEN NULL WHEN baseline > 0 THEN precision_top_k / baseline ELSE 0 END AS lift_score
FROM (SELECT COUNT(*) AS n, CAST(FLOOR(COUNT(*) * {k}) AS BIGINT) AS n_top,
             CAST(SUM(target) FILTER (WHERE rk <= FLOOR(n_all * {k})) AS DOUBLE) / NULLIF(FLOOR(COUNT(*) * {k}), 0)
               AS precision_top_k,
             AVG(CAST(target AS DOUBLE)) AS baseline
      FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {score} DESC, cliente_id ASC) AS rk, COUNT(*) OVER () AS n_all
            FROM {src} WHERE {score} IS NOT NULL))"""


def segments_select(n: int, score: str = "propension_digital", src: str = "sc") -> str:
    labels = ["D10", "D9", "D8", "D7", "D6", "D5", "D4", "D3", "D2", "D1"] if n == 10 else [
        f"S{i + 1}" for i in range(n)]
    whens = " ".join(f"WHEN {score} <= e[{i + 1}] THEN '{labels[i - 1]}'" for i in range(1, n))
    return (f"SELECT cliente_id, {score}, CASE {whens} ELSE '{labels[n - 1]}' END AS segmento_propension "
            f"FROM {src}, (SELECT quantile_cont({score}, {dlist(linspace(n))}) AS e FROM {src})")


def fold_encoding_sql(folds: int, m: int, seed: int = 42) -> str:
    """A8 out of fold: every training row from the sums of the other folds."""
    extra = SPLIT_CTE + f""",
tr AS (SELECT *, CAST('0x' || substr(md5('{seed}:' || cliente_id), 1, 13) AS BIGINT) % {folds} AS fold
       FROM sp WHERE split = 'train'),
g AS (SELECT fold, (SELECT AVG(CAST(o.target AS DOUBLE)) FROM tr o WHERE o.fold <> f.fold) AS gm
      FROM (SELECT DISTINCT fold FROM tr) f),
st AS (SELECT c.pais_cd, g.fold, g.gm, AVG(CAST(o.target AS DOUBLE)) AS mean, COUNT(o.target) AS cnt
       FROM (SELECT DISTINCT pais_cd FROM tr WHERE pais_cd IS NOT NULL) c CROSS JOIN g
       LEFT JOIN tr o ON o.pais_cd = c.pais_cd AND o.fold <> g.fold GROUP BY ALL),
enc AS (SELECT pais_cd, fold, w * mean + (1 - w) * gm AS e
        FROM (SELECT *, 1 / (1 + exp(-(CAST(cnt AS DOUBLE) - {m}) / CAST({m} AS DOUBLE))) AS w FROM st))"""
    body = ("SELECT tr.cliente_id, tr.pais_cd, COALESCE(enc.e, g.gm) AS pais_cd_target_encoded FROM tr "
            "JOIN g ON g.fold = tr.fold LEFT JOIN enc ON enc.pais_cd = tr.pais_cd AND enc.fold = tr.fold")
    return rounded(with_ft(body, extra), ["pais_cd_target_encoded"])


def stratified_sql(fraction: str = "0.2", seed: int = 42) -> str:
    """M2 by ranks: the first round(fraction * n) customers of each class in
    the order of the first 13 hex digits of md5('seed:id')."""
    body = f"""
SELECT cliente_id, target, r <= round({fraction} * n) AS is_validation
FROM (SELECT cliente_id, target, COUNT(*) OVER (PARTITION BY target) AS n,
             ROW_NUMBER() OVER (PARTITION BY target ORDER BY substr(md5('{seed}:' || cliente_id), 1, 13)) AS r
      FROM sp WHERE split = 'train')"""
    return with_ft(body, SPLIT_CTE)


def parity_sql() -> str:
    """Every column that scoring carries beside the model's own."""
    extra = ["cliente_id", "fecha_pedido_dt", "frecuencia_visitas_cd", "madurez_digital_cd", "pais_cd",
             "penultimo_canal", "target", "transicion_canal"]
    return " UNION ALL ".join(f"SELECT 'extra' AS kind, {_q(c)} AS column_name" for c in extra)
