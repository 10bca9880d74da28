"""Ranking and classification metrics.

Everything is computed from the *score table* (one row per distinct score
with positive/negative counts, built with partial aggregation) and its
global prefix sums (``cauce.plans.prefix``). Ties share one threshold, as
the definitions require. Results are small DataFrames.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.functions import ratio
from cauce.plans.prefix import grouped_prefix_sums, prefix_sums

LABEL, SCORE, KEY = "target", "propension_digital", "cliente_id"


def present(score: str) -> Column:
    """A score that counts: neither null nor NaN."""
    return F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))


def one_row(df: DataFrame, *columns: Column) -> DataFrame:
    """A one-row frame of constants."""
    return df.sparkSession.range(1).select(*columns)


def score_table(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    y = F.col(label).cast("bigint")
    return (scored.filter(present(score) & F.col(label).isNotNull())
                  .groupBy(F.col(score).cast("double").alias("score"))
                  .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"),
                       F.count(F.lit(1)).alias("cnt")))


def cumulative(scored: DataFrame, label: str = LABEL, score: str = SCORE,
               n_buckets: int | None = None) -> tuple[DataFrame, dict]:
    """Score table in descending score order with cumulative positives
    (``cum_pos`` = TP at threshold ``score``), negatives (FP) and rows."""
    return prefix_sums(score_table(scored, label, score), "score", ["pos", "neg", "cnt"],
                       descending=True, n_buckets=n_buckets)


def _auc_expr(P: int, N: int) -> Column:
    if P == 0 or N == 0:
        return F.lit(None).cast("double")
    return F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0)) / F.lit(float(P) * float(N))


def _ap_expr(P: int) -> Column:
    if P == 0:
        return F.lit(None).cast("double")
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return F.sum(F.col("pos") * prec) / F.lit(float(P))


def roc_auc(scored: DataFrame, label: str = LABEL, score: str = SCORE, ranking=None) -> DataFrame:
    """Area under the ROC curve (ties count one half); null with one class."""
    cum, tot = ranking or cumulative(scored, label, score)
    return cum.agg(_auc_expr(tot["pos"], tot["neg"]).cast("double").alias("roc_auc"))


def average_precision(scored: DataFrame, label: str = LABEL, score: str = SCORE, ranking=None) -> DataFrame:
    """Step-wise average precision, sum over thresholds of
    (recall gain) x precision; not the trapezoidal PR area."""
    cum, tot = ranking or cumulative(scored, label, score)
    return cum.agg(_ap_expr(tot["pos"]).cast("double").alias("avg_precision"))


def roc_auc_by(counts: DataFrame, groups: list[str]) -> DataFrame:
    """A18 for every group of a table of (groups, score, pos, neg) counts, whose
    rows may repeat scores: (groups, roc_auc), null with one class."""
    return _ranking_by(counts, groups).select(*groups, "roc_auc")


def ranking_metrics_by(scored: DataFrame, groups: list[str], label: str = LABEL, score: str = SCORE) -> DataFrame:
    """A18 + A19 for every group at once: (groups, n, positives, roc_auc,
    avg_precision). One ranking serves all groups and no group is one task; a
    null group is a group of its own."""
    y = F.col(label).cast("bigint")
    counts = scored.filter(present(score) & F.col(label).isNotNull()).select(
        *groups, F.col(score).cast("double").alias("score"), y.alias("pos"), (F.lit(1) - y).alias("neg"))
    return _ranking_by(counts, groups)


def _ranking_by(counts: DataFrame, groups: list[str]) -> DataFrame:
    table = counts.groupBy(*groups, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    cum = grouped_prefix_sums(table, groups, "score", ["pos", "neg"], descending=True)
    pos, neg = F.sum("pos"), F.sum("neg")
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0))
    steps = F.sum(F.col("pos") * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))))
    return cum.groupBy(*groups).agg(
        (pos + neg).alias("n"), pos.alias("positives"),
        F.try_divide(area, pos.cast("double") * neg.cast("double")).alias("roc_auc"),
        F.try_divide(steps, pos.cast("double")).alias("avg_precision"))


def _confusion_aggs(label: str, score: str, threshold: float) -> list[Column]:
    y = F.col(label) == 1
    pred = F.col(score) >= F.lit(threshold)  # P25, N22: inclusive threshold
    return [
        F.count_if(pred & y).alias("true_positives"),
        F.count_if(pred & ~y).alias("false_positives"),
        F.count_if(~pred & ~y).alias("true_negatives"),
        F.count_if(~pred & y).alias("false_negatives"),
    ]


def _derived(tp="true_positives", fp="false_positives", tn="true_negatives", fn="false_negatives"):
    precision = ratio(F.col(tp), F.col(tp) + F.col(fp), 0.0)
    recall = ratio(F.col(tp), F.col(tp) + F.col(fn), 0.0)
    f1 = ratio(2 * precision * recall, precision + recall, 0.0)
    spec = ratio(F.col(tn), F.col(tn) + F.col(fp), 0.0)
    return precision.alias("precision"), recall.alias("recall"), f1.alias("f1_score"), spec.alias("specificity")


def confusion_metrics(scored: DataFrame, threshold: float = 0.5, label: str = LABEL,
                      score: str = SCORE) -> DataFrame:
    """Confusion counts at an inclusive threshold and the derived
    precision, recall, F1 and specificity (0 when undefined)."""
    c = scored.filter(present(score) & F.col(label).isNotNull()).agg(
        *_confusion_aggs(label, score, threshold))
    return c.select("true_positives", "false_positives", "true_negatives", "false_negatives", *_derived())


def metrics_all(scored: DataFrame, threshold: float = 0.5, label: str = LABEL, score: str = SCORE,
                ranking=None) -> DataFrame:
    """The ten metrics in one row. ``ranking`` (the result of
    ``cumulative``) can be shared with the lift and curve operators."""
    cum, tot = ranking or cumulative(scored, label, score)
    ranking = cum.agg(_auc_expr(tot["pos"], tot["neg"]).cast("double").alias("roc_auc"),
                      _ap_expr(tot["pos"]).cast("double").alias("avg_precision"))
    conf = confusion_metrics(scored, threshold, label, score)
    return conf.select(
        ranking.select("roc_auc").scalar().alias("roc_auc"),
        ranking.select("avg_precision").scalar().alias("avg_precision"),
        "precision", "recall", "f1_score", "specificity",
        "true_positives", "false_positives", "true_negatives", "false_negatives")


def roc_curve(scored: DataFrame, label: str = LABEL, score: str = SCORE,
              drop_intermediate: bool = False) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, plus the
    starting point (inf, 0, 0). ``drop_intermediate`` leaves out inner points
    that lie on the line between their neighbours' steps: those whose next score
    adds as many positives and negatives as they do. The next score is found by an equi-join on
    the running number of distinct scores, not by a global window."""
    if drop_intermediate:
        cum, tot = prefix_sums(score_table(scored, label, score).withColumn("one", F.lit(1).cast("bigint")),
                               "score", ["pos", "neg", "one"], descending=True)
        nxt = cum.select((F.col("cum_one") - 1).alias("cum_one"), F.col("pos").alias("np"), F.col("neg").alias("nn"))
        kept = (F.col("cum_one") == 1) | F.col("np").isNull() | (F.col("np") != F.col("pos")) | (F.col("nn") != F.col("neg"))
        cum = cum.join(nxt, "cum_one", "left").filter(kept)
    else:
        cum, tot = cumulative(scored, label, score)
    P, N = float(tot["pos"]), float(tot["neg"])
    pts = cum.select(F.col("score").alias("threshold"),
                     (F.col("cum_neg") / F.lit(N) if N else F.lit(None).cast("double")).alias("fpr"),
                     (F.col("cum_pos") / F.lit(P) if P else F.lit(None).cast("double")).alias("tpr"))
    start = one_row(scored, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def pr_curve(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """(threshold, precision, recall) for every distinct score plus the
    end point (null, 1, 0); recall is 1 everywhere when there is no positive."""
    cum, tot = cumulative(scored, label, score)
    P = float(tot["pos"])
    pts = cum.select(F.col("score").alias("threshold"),
                     ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"), 0.0).alias("precision"),
                     (F.col("cum_pos") / F.lit(P) if P else F.lit(1.0)).alias("recall"))
    end = one_row(scored, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                  F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


#: Hex digits of a key that one pass of the selection tells apart.
DIGITS = 3


def _ordered_text(key: str, kind: T.DataType) -> Column:
    """The key as hex text in the key's own order, null first: integers and times
    with their sign bit turned, text by its bytes."""
    c = F.col(key)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        c = F.unix_date(c) if isinstance(kind, T.DateType) else F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
        c = (c * F.lit(10 ** kind.scale)).cast("decimal(38,0)")
    elif not isinstance(kind, (T.IntegralType, T.StringType, T.BinaryType)):
        raise TypeError(f"ties can't be broken by a key of type {kind.simpleString()}")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        text = F.hex(c.cast("binary"))
    else:
        text = F.lpad(F.hex(c.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.coalesce(F.concat(F.lit("1"), text), F.lit("0"))


def positives_of_first(group: DataFrame, m: int, key: str, label: str) -> int:
    """Positives among the ``m`` rows with the smallest keys (integers, times,
    text; nulls first; of rows with one key those labelled 0 first). Radix
    selection: a pass counts rows and positives by the next digits of the key,
    whole prefixes before the cut are added up, and the next pass only reads the
    prefix that holds it. Nothing is sorted, shuffled or written but one row
    per prefix and task."""
    rows = group.select(_ordered_text(key, group.schema[key].dataType).alias("k"), F.col(label).cast("bigint").alias("y"))
    ends = rows.agg(F.min("k").alias("a"), F.max("k").alias("z")).first()
    prefix = os.path.commonprefix([ends["a"] or "", ends["z"] or ""])
    need, total = m, 0
    while need > 0:
        head = F.substring("k", 1, len(prefix) + DIGITS)
        found = (rows.filter(F.col("k").startswith(prefix)).groupBy(head.alias("k"))
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p"), F.max(F.length("k")).alias("size")).collect())
        for r in sorted(found, key=lambda r: r["k"]):  # at most 16 ** DIGITS and a few shorter ones
            if r["n"] > need:
                break
            need, total = need - r["n"], total + (r["p"] or 0)
        else:
            return total
        if r["size"] == len(r["k"]):  # the cut falls among rows with one key
            return total + max(0, need - (r["n"] - (r["p"] or 0)))
        prefix = r["k"]
    return total


def lift_score(scored: DataFrame, top_k: float = 0.20, label: str = LABEL, score: str = SCORE,
               key: str = KEY, ranking=None) -> DataFrame:
    """Share of positives among the top ``int(n*k)`` rows by score
    (ties broken by ascending key of any orderable type), divided by the
    overall positive rate.

    No global sort and no ``limit``: whole score groups above the cut come
    from the prefix table; only the one group straddling the cut is ranked
    by key, by digits of the key (``positives_of_first``), at every size alike."""
    cum, tot = ranking or cumulative(scored, label, score)
    n, P = int(tot["cnt"]), int(tot["pos"])
    n_top = int(n * top_k)
    baseline = P / n if n else None
    pos_top = 0
    if n_top > 0:
        straddles = (F.col("cum_cnt") > n_top) & (F.col("cum_cnt") - F.col("cnt") < n_top)
        row = cum.agg(  # one pass: whole groups above the cut, and the group straddling it
            F.sum(F.when(F.col("cum_cnt") <= n_top, F.col("pos"))).alias("p"),
            F.max_by(F.struct("score", "cnt", "cum_cnt"), F.when(straddles, F.col("cum_cnt"))).alias("cut"),
        ).collect()[0]
        pos_top = int(row["p"] or 0)
        if row["cut"] is not None:
            s, cnt, cc = row["cut"]["score"], int(row["cut"]["cnt"]), int(row["cut"]["cum_cnt"])
            group = scored.filter((F.col(score).cast("double") == F.lit(s)) & F.col(label).isNotNull())
            pos_top += positives_of_first(group, n_top - (cc - cnt), key, label)
    prec = pos_top / n_top if n_top > 0 else None
    lift = None if prec is None else prec / baseline if baseline else 0.0
    return one_row(scored, F.lit(n).cast("bigint").alias("n"), F.lit(n_top).cast("bigint").alias("n_top"),
                   F.lit(prec).cast("double").alias("precision_top_k"),
                   F.lit(baseline).cast("double").alias("baseline"),
                   F.lit(lift).cast("double").alias("lift_score"))
