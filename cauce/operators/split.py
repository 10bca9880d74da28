"""Temporal and stratified splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.functions import minus_months
from cauce.plans.prefix import exact_rank_values


def temporal_split(df: DataFrame, fecha_col: str = "fecha_pedido_dt", test_months: int = 1,
                   split_col: str = "split") -> DataFrame:
    """M1: cutoff = max date - n months (month-end clamped); ``train`` before
    the cutoff, ``test`` on or after it; rows with a null date go to neither
    (N21). The max is a scalar subquery, the split one projected column."""
    ref = df.agg(F.max(F.col(fecha_col))).scalar()
    cutoff = minus_months(ref, test_months)
    fecha = F.col(fecha_col)
    split = F.when(fecha < cutoff, F.lit("train")).when(fecha >= cutoff, F.lit("test"))
    return df.withColumn(split_col, split).filter(F.col(split_col).isNotNull())


def train_test(df: DataFrame, fecha_col: str = "fecha_pedido_dt", test_months: int = 1):
    s = temporal_split(df, fecha_col, test_months, "_split")
    return (s.filter(F.col("_split") == "train").drop("_split"),
            s.filter(F.col("_split") == "test").drop("_split"))


def split_summary(split_df: DataFrame, split_col: str = "split", label: str = "target",
                  fecha_col: str = "fecha_pedido_dt") -> DataFrame:
    """Size, target mean and date range per split."""
    return split_df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_clientes"),
        F.avg(F.col(label).cast("double")).alias("target_mean"),
        F.min(F.col(fecha_col)).alias("fecha_min"),
        F.max(F.col(fecha_col)).alias("fecha_max"))


def _hash_key(key: str, seed: int):
    # the first 13 hex digits of md5('seed:key'): 52 bits, exact as a double
    # and the same in any engine
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")


def stratified_split(df: DataFrame, label: str = "target", fraction: float = 0.2, seed: int = 42,
                     key: str = "cliente_id", exact: bool = True, out_col: str = "is_validation") -> DataFrame:
    """M2: seeded stratified hold-out. Rows are ordered inside each label
    stratum by a seeded hash of the key; the first ``round(fraction * n)``
    of each stratum are validation rows. With ``exact=True`` the cut is
    found by the distributed rank selection (strata are huge, so no
    per-stratum window); ``exact=False`` keeps rows whose hash falls under
    the fraction (one pass, sizes exact only in expectation)."""
    h = _hash_key(key, seed)
    if not exact:
        return df.withColumn(out_col, h < F.lit(fraction * float(1 << 52)))
    x = df.withColumn("_h", h)
    counts = [(r[0], int(r[1])) for r in x.groupBy(label).count().collect()]  # one row per class
    own = {v: (F.col(label).isNull() if v is None else F.col(label) == F.lit(v)) for v, _ in counts}
    wanted = {f"_c{i}": (v, int(round(fraction * n)) - 1) for i, (v, n) in enumerate(counts)
              if int(round(fraction * n)) > 0}
    # one selection for all classes: a column per class, null in the others
    per_class = x.select(*[F.when(own[v], F.col("_h")).alias(c) for c, (v, _) in wanted.items()])
    found = exact_rank_values(per_class, list(wanted), {c: [k] for c, (_, k) in wanted.items()}) if wanted else {}
    cond = F.lit(False)
    for c, (v, k) in wanted.items():
        cond = F.when(own[v], F.col("_h") <= F.lit(found[c][k])).otherwise(cond)
    return x.withColumn(out_col, F.coalesce(cond, F.lit(False))).drop("_h")
