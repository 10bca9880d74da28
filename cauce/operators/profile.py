"""Profiling operators.

Each is one aggregate (or one aggregate plus an unpivot) over the frame;
results are small. Exact quartiles use the distributed rank selection;
``approx=True`` swaps in ``percentile_approx`` for a single pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.functions import number
from cauce.plans.prefix import exact_quantiles
from cauce.session import materialize


def _numeric(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def preview(df: DataFrame, n: int = 10, order_by: str = "cliente_id") -> DataFrame:
    """First n rows in key order (a top-k, planned as TakeOrdered)."""
    return df.orderBy(F.col(order_by).asc_nulls_last()).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    """``COUNT(1)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, Spark type, non-null count
    (one aggregate pass, then unpivoted)."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"c{i}").alias("non_null"))
        for i, f in enumerate(fields)]))
    return counts.select(rows.alias("r")).select("r.*")


def describe(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """A10: count, mean, sample std, min, quartiles (linear interpolation)
    and max per numeric column, in long form (one row per column)."""
    cols = cols or _numeric(df)
    base = df.agg(*[x for c in cols for x in (
        F.count(number(F.col(f"`{c}`"))).alias(f"{c}__count"),
        F.avg(number(F.col(f"`{c}`"))).alias(f"{c}__mean"),
        F.stddev_samp(number(F.col(f"`{c}`"))).alias(f"{c}__std"),
        F.min(number(F.col(f"`{c}`"))).alias(f"{c}__min"),
        F.max(number(F.col(f"`{c}`"))).alias(f"{c}__max"),
    )] + ([F.percentile_approx(number(F.col(f"`{c}`")), [0.25, 0.5, 0.75], 100000).alias(f"{c}__q")
           for c in cols] if approx else []))
    if approx:
        q = {c: [F.col(f"{c}__q")[i] for i in range(3)] for c in cols}
    else:
        base = materialize(base)  # one row; its counts also size the rank selection
        row = base.collect()[0]
        exact = exact_quantiles(df, cols, [0.25, 0.5, 0.75], counts={c: row[f"{c}__count"] for c in cols})
        q = {c: [F.lit(v).cast("double") for v in exact[c]] for c in cols}
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__count").alias("count"),
                 F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
                 F.col(f"{c}__min").alias("min"), q[c][0].alias("q25"), q[c][1].alias("q50"),
                 q[c][2].alias("q75"), F.col(f"{c}__max").alias("max"))
        for c in cols]))
    return base.select(rows.alias("r")).select("r.*")


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Counts per value, nulls excluded, most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
              .orderBy(F.col(name).desc(), F.col(col).asc()))


def top_values(df: DataFrame, col: str, k: int = 15, name: str = "n") -> DataFrame:
    """The k most frequent values (ties by value) - a bounded top-k."""
    return value_counts(df, col, name).limit(k)


def trend_counts(temporal: DataFrame, col: str = "tendencia_digital", threshold: float = 0.1) -> DataFrame:
    """Customers accelerating (> t) and decelerating (< -t); null
    trends count in neither."""
    return temporal.agg(F.count_if(F.col(col) > threshold).alias("clientes_acelerando"),
                        F.count_if(F.col(col) < -threshold).alias("clientes_desacelerando"))


def target_distribution(df: DataFrame, label: str = "target") -> DataFrame:
    """Customers per class and percentage (rounded to 2). The total is
    summed from the few class counts, so the frame is read once."""
    total = F.sum("clientes").over(Window.partitionBy(F.lit(0)))
    return (df.groupBy(label).agg(F.count(F.lit(1)).alias("clientes"))
              .withColumn("porcentaje", F.round(F.col("clientes") * 100.0 / total, 2)))


def null_profile(df: DataFrame, k: int = 10) -> DataFrame:
    """Null count per column (one aggregate + unpivot), top k."""
    fields = [f.name for f in df.schema.fields]
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(fields)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(f"c{i}").alias("n_nulos"))
                               for i, c in enumerate(fields)]))
    return (counts.select(rows.alias("r")).select("r.*")
                  .orderBy(F.col("n_nulos").desc(), F.col("columna").asc()).limit(k))


def target_correlation(df: DataFrame, label: str = "target", k: int | None = 15) -> DataFrame:
    """A15 + T3: Pearson correlation of every numeric column with the
    target, computed as covar_pop / (stddev_pop * stddev_pop) with a zero
    guard, so a constant column gives null instead of an ANSI error."""
    cols = _numeric(df)
    y = number(F.col(label))
    aggs = []
    for i, c in enumerate(cols):
        x = number(F.col(f"`{c}`"))
        aggs.append(F.try_divide(F.covar_pop(x, y), F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0)))
                    .alias(f"c{i}"))
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("correlation"))
                               for i, c in enumerate(cols)]))
    out = df.agg(*aggs).select(rows.alias("r")).select("r.*").orderBy(
        F.col("correlation").desc_nulls_last(), F.col("feature").asc())
    return out.limit(k) if k else out


def distinct_count(df: DataFrame, col: str, name: str = "n_distintos", approx: bool = False) -> DataFrame:
    """Distinct non-null values (exact, or HyperLogLog++ when approx)."""
    f = F.approx_count_distinct(F.col(col)) if approx else F.countDistinct(F.col(col))
    return df.agg(f.alias(name))


def histogram(df: DataFrame, col: str, bins: int = 50, by: str | None = None,
              max_broadcast_groups: int = 100_000) -> DataFrame:
    """Equal-width histogram between the min and max of the column
    (per group when ``by`` is given); the last bin is closed; a constant
    column uses the range [v - 0.5, v + 0.5]. Only non-empty bins are
    returned. The range is a grouped aggregate joined back on the group key
    (a scalar subquery when ungrouped)."""
    x = F.col(col).cast("double")
    src = df.filter(x.isNotNull() & ~F.isnan(x))
    keys = [by] if by else []
    rng = src.groupBy(*keys).agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    rng = rng.select(*keys,
                     F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                     F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"))
    if by:
        # one row per group; broadcast only after checking the group count
        small = rng.limit(max_broadcast_groups + 1).count() <= max_broadcast_groups
        j = src.join(F.broadcast(rng) if small else rng, by)
    else:
        j = src.select("*", rng.select("_lo").scalar().alias("_lo"), rng.select("_hi").scalar().alias("_hi"))
    b = F.least(F.floor((x - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))).cast("int"), F.lit(bins - 1))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return (j.groupBy(*keys, b.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
              .select(*keys, "bin", (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
                      (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"), "n"))
