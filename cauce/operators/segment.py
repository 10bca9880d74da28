"""Quantile segmentation and segment reports (M7, A22-A25, M10 tail).

Edges are exact linear-interpolated quantiles of the score (N24) computed
by the distributed rank selection; assignment is a right-closed ``when``
chain over the interior edges (the first bin also holds the minimum).
Equal scores always share a bin, which ``ntile`` would not guarantee.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.plans.prefix import exact_quantiles
from cauce.spec import DECILE_LABELS


def segment_labels(n: int) -> list[str]:
    """10 -> D10..D1 (D1 = highest scores); otherwise S1..Sn (S1 = lowest)."""
    return list(DECILE_LABELS) if n == 10 else [f"S{i + 1}" for i in range(n)]


@dataclass(frozen=True)
class SegmentEdges:
    edges: tuple
    labels: tuple
    score_col: str = "propension_digital"
    out_col: str = "segmento_propension"
    open_ends: bool = False  # scores beyond the fitted range fall in the first or last bin

    def transform(self, df: DataFrame) -> DataFrame:
        s = F.col(self.score_col)
        e, lab = self.edges, self.labels
        if not e:
            return df.withColumn(self.out_col, F.lit(None).cast("string"))
        outside = s.isNull() | F.isnan(s.cast("double"))
        if not self.open_ends:
            outside = outside | (s < F.lit(e[0])) | (s > F.lit(e[-1]))
        expr = F.when(outside, F.lit(None).cast("string"))
        for i in range(1, len(e) - 1):
            expr = expr.when(s <= F.lit(e[i]), F.lit(lab[i - 1]))
        expr = expr.otherwise(F.lit(lab[-1]))
        return df.withColumn(self.out_col, expr)


def fit_segments(df: DataFrame, score_col: str = "propension_digital", n: int = 10,
                 duplicates: str = "raise", out_col: str = "segmento_propension",
                 open_ends: bool = False) -> SegmentEdges:
    """Fit n quantile bins. ``duplicates='raise'`` mirrors a fixed-label
    quantile cut (equal edges are an error); ``'collapse'`` merges them and
    keeps the labels of the surviving bins. Scores outside the fitted range have
    no segment, unless ``open_ends``."""
    probs = [i / n for i in range(n + 1)]
    edges = exact_quantiles(df, [score_col], probs)[score_col]
    if any(e is None for e in edges):  # no score at all: every row stays without a segment
        return SegmentEdges((), (), score_col, out_col, open_ends)
    labels = segment_labels(n)
    uniq = []
    keep = []
    for i, e in enumerate(edges):
        if not uniq or e > uniq[-1]:
            uniq.append(e)
            if i > 0:
                keep.append(labels[i - 1])
        elif i > 0:
            pass
    if len(uniq) != len(edges):
        if duplicates == "raise":
            raise ValueError(f"bin edges must be unique: {edges}")
        # equal scores only: one bin, named as the highest
        labels = keep if len(uniq) > 1 else labels[-1:]
    return SegmentEdges(tuple(uniq), tuple(labels), score_col, out_col, open_ends)


def segment_customers(df: DataFrame, score_col: str = "propension_digital", n: int = 10,
                      duplicates: str = "raise") -> DataFrame:
    """M7: fit the edges on ``df`` and label every row."""
    return fit_segments(df, score_col, n, duplicates).transform(df)


def segment_analysis(df: DataFrame, seg_col: str = "segmento_propension", label: str = "target",
                     score: str = "propension_digital") -> DataFrame:
    """A22 + P6: per segment target count/sum/mean and score min/max/mean,
    rounded to 4 places, flattened names."""
    return df.groupBy(seg_col).agg(
        F.count(F.col(label)).alias(f"{label}_count"),
        F.sum(F.col(label)).cast("bigint").alias(f"{label}_sum"),
        F.round(F.avg(F.col(label)), 4).alias(f"{label}_mean"),
        F.round(F.min(F.col(score)), 4).alias(f"{score}_min"),
        F.round(F.max(F.col(score)), 4).alias(f"{score}_max"),
        F.round(F.avg(F.col(score)), 4).alias(f"{score}_mean"),
    )


def segment_lift(df: DataFrame, seg_col: str = "segmento_propension", label: str = "target") -> DataFrame:
    """A23 + A24: conversion rate (%) per segment and its lift over the
    overall rate (a scalar subquery, not a join)."""
    base = df.agg(F.avg(F.col(label).cast("double"))).scalar()
    rate = F.avg(F.col(label).cast("double"))
    return df.groupBy(seg_col).agg((rate * 100).alias("tasa_conversion"),
                                   F.try_divide(rate, base).alias("lift"))


def scoring_summary(df: DataFrame) -> DataFrame:
    """A25 + T7: segment x maturity counts and score stats, the report's own
    SQL (``GROUP BY ALL ORDER BY ALL``) run by Spark."""
    return df.sparkSession.sql("""
        SELECT segmento_propension, madurez_digital,
               COUNT(cliente_id) AS q_clientes,
               AVG(propension_digital) AS prop_avg,
               MIN(propension_digital) AS prop_min,
               MAX(propension_digital) AS prop_max
        FROM {scored}
        GROUP BY ALL
        ORDER BY ALL""", scored=df)
