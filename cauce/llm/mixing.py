"""Mixing sources to target weights by subset-sum budget fitting.

1. Sizes (words) are counted once per document; documents are counted by
   (source, exact size), a table whose rows are bounded by the distinct sizes.
2. Targets: weighted shares of the budget, capped at ``max_epochs`` times the
   source's size, the excess reshared by weight. The shares that cap first are
   those with the smallest cap / weight, so the water level falls out of two
   windows over one row per source.
3. Each source takes whole epochs first. Of the rest, every size gives its
   proportional number of documents (error carried from size to size), and a
   bounded-knapsack dynamic programme over the counts that are left closes the
   remaining budget, a few times the largest size.
4. Documents are selected per (source, size) in seeded hash order. The order is
   cut by hash range, counted in parts of about ``PART`` rows, so that only
   the one part in which the cut falls is ranked row by row: no group of equal
   sizes is ever sorted as a whole, whatever its share of the table.

Defined results: null text has size 0 and is taken 0 words; null is a source of
its own, last in order; repeated rows count as separate documents (rows that
agree in doc_id, source and size are interchangeable); a table without any word
has targets 0; an empty table gives no rows. The same input gives the same mix.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.llm.common import ship, stage

#: Rows of one size that are ranked together at most (on average).
PART = 200
#: The knapsack programme closes this many times the largest size.
FITTED = 4
#: Sets of sums held per level when the programme is traced back.
SPLIT = 8
#: Copies of one row that a task writes at a time.
COPIES = 10_000
WORD = "[^\\x20\\x09-\\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (number of words) of every document."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
                       .cast("long").alias("size"))


def source_targets(histogram: DataFrame, weights: tuple[float, ...], share: float, max_epochs: int) -> DataFrame:
    """source, source_size, target from (source, size, n): one row per source."""
    total = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    # UTF-8 byte order is code point order
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.lit([float(x) for x in weights]).cast("array<double>"),
                     (rank % len(weights) + 1).cast("int"))
    t = total.withColumn("w", w).withColumn("cap", F.col("source_size") * float(max_epochs))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    budget = F.sum("source_size").over(every) * float(share)
    # the level if this source and all that cap later share what the earlier leave
    level = ((budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    t = t.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    first = F.first(fits, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return t.withColumn("first", first).select(
        "source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("first") * F.col("w"), F.col("cap")))
        .alias("target"))


def reachable(sizes: np.ndarray, counts: np.ndarray, budget: int) -> tuple[int, dict[int, int]]:
    """Bounded knapsack: the largest sum <= budget of at most counts[i] times
    sizes[i], and how many of each make it. Sets of sums are bit sets of
    ``budget`` bits. To trace the best sum back, the set before each step is
    needed; instead of one a step, a run of steps keeps the sets at its
    ``SPLIT`` borders and works its parts off again, last part first, so
    that SPLIT sets a level are held and log(steps) levels."""
    full = (1 << (budget + 1)) - 1
    sums, steps = 1, []
    for size, count in zip(sizes.tolist(), counts.tolist()):
        if sums >> budget & 1:
            break
        if size > budget:
            continue
        left, part = min(count, budget // size), 1
        while left and not sums >> budget & 1:  # binary splitting of the count
            take = min(part, left)
            steps.append((size, take))
            sums |= (sums << (size * take)) & full
            left, part = left - take, part * 2
    best = at = sums.bit_length() - 1
    del sums
    used: dict[int, int] = {}
    # a stack of (first step, end, sums before the first); the last is worked off
    # first, and ``at`` is the sum that the steps up to its end have to make
    work = [(0, len(steps), 1)] if steps else []
    while work:
        lo, hi, before = work.pop()
        if hi - lo == 1:
            size, take = steps[lo]
            if not before >> at & 1:
                at -= size * take
                used[size] = used.get(size, 0) + take
            continue
        width = -(-(hi - lo) // SPLIT)
        for i in range(lo, hi, width):
            end = min(i + width, hi)
            work.append((i, end, before))
            if end < hi:
                for size, take in steps[i:end]:
                    before |= (before << (size * take)) & full
    return best, used


def fit(sizes: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """How many documents of each size to take so that their sizes sum to the
    budget as nearly as they can: at most counts[i] of sizes[i]."""
    take = np.zeros(len(sizes), np.int64)
    whole = int((sizes * counts).sum())
    want = min(int(round(budget)), whole)
    if want <= 0:
        return take
    # proportional, largest sizes first; what a size can't give goes to the next
    # all but what the programme fits exactly: a few times the largest size
    owed, share = 0.0, max(0, want - FITTED * int(sizes[counts > 0].max())) / whole
    for i in np.argsort(-sizes, kind="stable"):
        owed += share * float(sizes[i]) * float(counts[i])
        take[i] = min(int(counts[i]), max(0, math.floor(owed / sizes[i] + 1e-9))) if sizes[i] else 0
        owed -= float(take[i]) * float(sizes[i])
    rest = want - int((take * sizes).sum())
    left = counts - take
    some = np.nonzero((left > 0) & (sizes > 0))[0][::-1]
    if rest > 0 and len(some):
        best, used = reachable(sizes[some], left[some], rest)
        over = sizes[some].min()
        for i in some:
            take[i] += used.get(int(sizes[i]), 0)
        if rest - best > abs(rest - best - over) and (counts - take)[some[np.argmin(sizes[some])]] > 0:
            take[some[np.argmin(sizes[some])]] += 1  # one too many is nearer than one too few
    return take


def budget_plan(histogram: DataFrame, targets: DataFrame) -> DataFrame:
    """source, size, n, source_size, target, epochs (taken by all), extra (the
    number of documents of that size that are taken once more)."""
    schema = ("source string, size long, n long, source_size long, target double, epochs long, extra long")

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        target, size = float(pdf.target.iloc[0]), int(pdf.source_size.iloc[0])
        epochs = int(target // size) if size else 0
        pdf = pdf.sort_values("size")
        sizes, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        extra = fit(sizes, counts, target - epochs * size)
        return pdf.assign(epochs=epochs, extra=extra)[[f.split()[0] for f in schema.split(", ")]]

    joined = histogram.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return joined.groupBy("source").applyInPandas(plan, schema)


def repeated(df: DataFrame, times: Column, keys: list[str]) -> DataFrame:
    """Every row as many times as it says. Rows of more than ``COPIES`` copies are
    first told apart by the number of a batch and dealt by it, so that no task
    writes all copies of one row."""
    counted = df.withColumn("_times", times.cast("long")).where("_times > 0")
    few = counted.where(F.col("_times") <= COPIES)
    many = counted.where(F.col("_times") > COPIES).withColumn(
        "_batch", F.explode(F.expr(f"sequence(0L, (_times - 1) div {COPIES})")))
    many = many.repartition(*keys, "_batch").withColumn(
        "_times", F.least(F.lit(COPIES), F.col("_times") - F.col("_batch") * COPIES)).drop("_batch")
    return few.unionByName(many).withColumn(
        "_again", F.explode(F.expr("array_repeat(0, cast(_times as int))"))).drop("_again", "_times")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2,
        seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) and
    copies (times the document is taken)."""
    ship(docs.sparkSession)
    rows = stage(sized(docs).withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "source", "size")))
    histogram = stage(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    plan = stage(budget_plan(histogram, source_targets(histogram, weights, share, max_epochs)))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / PART)).cast("long")
    key = [F.col("source").eqNullSafe(F.col("p_source")), F.col("size") == F.col("p_size")]
    renamed = plan.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "n", "source_size",
                          "target", "epochs", "extra")
    # tables with a row per source and size are merged, never broadcast
    rows = stage(rows.join(renamed.hint("merge"), key[0] & key[1]).drop("p_source", "p_size")
                 .withColumn("part", F.pmod(F.col("h"), parts)))
    # of which part the cut falls in: a running count over parts, not over rows
    counted = rows.where("extra > 0 and extra < n").groupBy("source", "size", "extra", "part") \
        .agg(F.count(F.lit(1)).alias("m"))
    run = Window.partitionBy("source", "size").orderBy("part")
    counted = counted.withColumn("before", F.sum("m").over(run) - F.col("m"))
    cut = stage(counted.where("before < extra and before + m > extra").select(
        F.col("source").alias("p_source"), F.col("size").alias("p_size"), F.col("part").alias("cut"),
        (F.col("extra") - F.col("before")).alias("need")))
    whole = counted.where("before + m <= extra").groupBy("source", "size").agg(F.max("part").alias("last"))
    last = stage(whole.select(F.col("source").alias("q_source"), F.col("size").alias("q_size"), "last"))
    plain = rows.where("extra = 0 or extra >= n").withColumn("more", (F.col("extra") > 0).cast("long"))
    some = rows.where("extra > 0 and extra < n") \
        .join(last.hint("merge"), F.col("source").eqNullSafe(F.col("q_source")) & (F.col("size") == F.col("q_size")), "left") \
        .join(cut.hint("merge"), key[0] & key[1], "left") \
        .withColumn("state", F.when(F.col("part") <= F.coalesce("last", F.lit(-1)), 1)
                    .when(F.col("part") == F.col("cut"), 2).otherwise(0))
    some = stage(some.drop("q_source", "q_size", "p_source", "p_size"))
    columns = ["doc_id", "source", "size", "source_size", "target", "epochs", "more"]
    # rows that agree are counted, not ranked, so a part's rows differ in their ids
    ids = [*columns[:-1], "need", "h"]
    edge = some.where("state = 2").groupBy(*ids).agg(F.count(F.lit(1)).alias("m"))
    order = Window.partitionBy("source", "size").orderBy("h", F.col("doc_id").asc_nulls_last())
    edge = edge.withColumn("before", F.sum("m").over(order) - F.col("m"))
    edge = edge.withColumn("k", F.greatest(F.lit(0), F.least("m", F.col("need") - F.col("before"))))
    edge = repeated(edge.withColumn("more", F.explode(F.expr("array(1L, 0L)"))),
                    F.expr("if(more = 1, k, m - k)"), ["doc_id", "source", "size"])
    picked = (plain.select(columns)
              .unionByName(some.where("state < 2").withColumn("more", F.col("state").cast("long")).select(columns))
              .unionByName(edge.select(columns)))
    copies = F.col("epochs") + F.col("more")
    return picked.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves, each as many times as the mix takes it. Rows
    are matched to their decision by a key of id, source and size. Several rows
    of one key share its copies: rows that agree in every column become one with
    a count, and the copies are dealt over the others in the order of their
    hashes, in parts of about ``PART`` rows, so that no window holds a key's
    whole rows. Columns have to be of types that Spark can
    group by and hash."""
    taken = mix(docs, **options)
    key = F.xxhash64("doc_id", "source", "size")
    chosen = stage(taken.select(key.alias("key"), "copies").groupBy("key")
                   .agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies")).where("copies > 0"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    # the row's own names stay apart in a struct
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "source", size).alias("key"))
    # one way to join at every size: texts are dealt by key once, the keys hashed
    alone = keyed.join(chosen.where("n = 1").hint("shuffle_hash"), "key")
    out = alone.withColumn("_again", F.explode(F.expr("array_repeat(0, cast(copies as int))"))).select("row")
    if chosen.where("n > 1").isEmpty():  # no key repeats: nothing to share out
        return out.select("row.*")
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / PART)).cast("long")
    several = (keyed.join(chosen.where("n > 1").hint("shuffle_hash"), "key")
               .groupBy("row", "key", "n", "copies").agg(F.count(F.lit(1)).alias("m"))
               .withColumn("h", F.xxhash64("row")).withColumn("part", F.pmod(F.col("h"), parts)))
    run = Window.partitionBy("p_key").orderBy("p_part")
    heads = several.groupBy(F.col("key").alias("p_key"), F.col("part").alias("p_part")).agg(F.sum("m").alias("rows"))
    heads = heads.withColumn("head", F.sum("rows").over(run) - F.col("rows"))
    several = several.join(heads, (F.col("key") == F.col("p_key")) & (F.col("part") == F.col("p_part")))
    order = Window.partitionBy("key", "part").orderBy("h", F.hash("row")).rowsBetween(Window.unboundedPreceding, 0)
    several = several.withColumn("before", F.col("head") + F.sum("m").over(order) - F.col("m"))
    shared = repeated(several, F.expr("m * (copies div n) + greatest(0L, least(m, copies % n - before))"), ["row"])
    return out.unionByName(shared.select("row")).select("row.*")
