"""Column contract and parameters, passed explicitly (no globals are read
inside operators; the module-level instances are only defaults)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# Channel codes, the maturity score table, the fill constants and the
# transition separator, in the reference's natural order.
CHANNEL_DIGITAL = "DIGITAL"
CHANNEL_PHONE = "TELEFONO"
CHANNEL_SELLER = "VENDEDOR"
CHANNELS = (CHANNEL_DIGITAL, CHANNEL_PHONE, CHANNEL_SELLER)
MATURITY_SCORES = {"ALTA": 0.75, "MEDIA": 0.55, "BAJA": 0.35}
FIRST_ORDER_GAP_DAYS = 600
NEVER_DIGITAL_DAYS = 999
UNKNOWN = "UNKNOWN"
TRANSITION_SEP = "_TO_"
DECILE_LABELS = ("D10", "D9", "D8", "D7", "D6", "D5", "D4", "D3", "D2", "D1")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Columns:
    """Names of the transaction columns (input contract)."""

    cliente: str = "cliente_id"
    fecha: str = "fecha_pedido_dt"
    canal: str = "canal_pedido_cd"
    facturacion: str = "facturacion_usd_val"
    materiales: str = "materiales_distintos_val"
    dias_ultimo: str = "dias_desde_ultimo_pedido"
    frecuencia: str = "frecuencia_visitas_cd"
    pais: str = "pais_cd"
    madurez: str = "madurez_digital_cd"
    # Spark rows have no input order, so equal dates need a tiebreak column.
    pedido: str = "pedido_id"


@dataclass(frozen=True)
class FeatureSpec:
    trend_days: int = 90
    recent_days: int = 30
    n_lags: int = 3
    min_orders: int = 2
    channels: tuple = CHANNELS
    digital: str = CHANNEL_DIGITAL
    maturity_scores: dict = field(default_factory=lambda: dict(MATURITY_SCORES))
    # customers above this many orders are windowed in ordered pieces
    # (skew guard); None disables the check
    hot_rows: int | None = 2_000_000

    def history_columns(self) -> tuple:
        """Output columns of the history block, with two means per channel."""
        base = HISTORY_COLS[:HISTORY_COLS.index("pct_digital_historico") + 1]
        return base + tuple(f"{m}_promedio_{ch.lower()}" for ch in self.channels for m in ("facturacion", "materiales"))


@dataclass(frozen=True)
class BoostParams:
    """The booster's parameters, with the reference's names and values."""

    rounds: int = 1000  # an upper bound: early stopping ends it
    patience: int = 50
    learning_rate: float = 0.05
    num_leaves: int = 31
    max_depth: int = -1
    feature_fraction: float = 0.8
    bagging_fraction: float = 0.8
    bagging_freq: int = 5
    min_child_samples: int = 20
    min_child_weight: float = 1e-3
    reg_alpha: float = 0.1
    reg_lambda: float = 0.1
    max_bin: int = 64
    seed: int = 42


@dataclass(frozen=True)
class ModelSpec:
    test_months: int = 1
    seed: int = 42
    threshold: float = 0.5
    top_k: float = 0.20
    validation_fraction: float = 0.2
    boost: BoostParams = BoostParams()
    categoricals: tuple = (
        "ultimo_canal",
        "penultimo_canal",
        "transicion_canal",
        "madurez_digital_cd",
        "frecuencia_visitas_cd",
    )


COLUMNS = Columns()
FEATURES = FeatureSpec()
MODEL = ModelSpec()

# Output feature row, in order (29 features between the key and the target).
HISTORY_COLS = (
    "total_pedidos", "facturacion_promedio", "facturacion_std", "facturacion_total",
    "materiales_promedio", "materiales_std", "dias_ultimo_promedio",
    "pedidos_digitales_total", "pct_digital_historico",
    "facturacion_promedio_digital", "materiales_promedio_digital",
    "facturacion_promedio_telefono", "materiales_promedio_telefono",
    "facturacion_promedio_vendedor", "materiales_promedio_vendedor",
)
TEMPORAL_COLS = (
    "pct_digital_90d", "pct_digital_30d", "tendencia_digital",
    "pedidos_ultimos_90d", "pedidos_ultimos_30d", "dias_desde_ultimo_digital",
)
SEQUENCE_COLS = ("ultimo_canal", "penultimo_canal", "transicion_canal", "racha_canal_actual")
CATEGORICAL_COLS = ("pais_cd", "madurez_digital_cd", "frecuencia_visitas_cd", "madurez_digital_encoded")
FEATURE_COLS = HISTORY_COLS + TEMPORAL_COLS + SEQUENCE_COLS + CATEGORICAL_COLS


def check_transactions(df: DataFrame, cols: Columns = COLUMNS, need_gap: bool = False,
                       features: bool = False) -> None:
    """Validate the input contract; raises ValueError naming what is wrong.
    ``features`` also asks for what only the feature builders read."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    required = [cols.cliente, cols.fecha, cols.canal, cols.pedido]
    if need_gap:
        required.append(cols.dias_ultimo)
    if features:
        required += [cols.facturacion, cols.materiales, cols.pais, cols.madurez, cols.frecuencia]
    missing = [c for c in required if c not in fields]
    if missing:
        raise ValueError(f"transaction frame lacks columns {missing}")
    if not isinstance(fields[cols.fecha], (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{cols.fecha} must be DATE or TIMESTAMP, got {fields[cols.fecha]}")
    if not isinstance(fields[cols.canal], T.StringType):
        raise ValueError(f"{cols.canal} must be STRING, got {fields[cols.canal]}")
