"""Global order without a single-partition window.

Ranking metrics, top-k cuts, exact quantiles and exact stratified splits
need positions in one global order. ``Window.orderBy`` without a
partition would move every row into one task, so instead:

1. collapse equal keys first (``groupBy(key).count()``: partial
   aggregation, so a hot value costs one row per input partition);
2. cut the key range into buckets at approximate quantiles (literal
   edges; binary search by ``Bucketizer``). A bucket holds at most about
   n/buckets rows, hence at most that many distinct keys; a key holding a
   third of the rows collapses adjacent edges but is one row after step 1;
3. bucket totals are tiny (<= n_buckets rows): they are collected and the
   exclusive running totals computed on the driver (bounded state);
4. positions inside a bucket come from a window partitioned by bucket,
   plus the bucket's offset, from a broadcast table of one row a bucket.

Every edge is a literal once computed, so re-execution after a lost
executor reproduces the same buckets (no sampling at run time).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.session import materialize


# approximate percentiles of accuracy 10000 can't tell more buckets apart
MAX_BUCKETS = 2000


def default_buckets(df: DataFrame) -> int:
    try:
        p = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover
        p = 200
    return max(4, min(4 * p, MAX_BUCKETS))


def _clean_edges(vals) -> list[float]:
    return sorted({float(x) for x in (vals or []) if x is not None and math.isfinite(x)})


def _bucketize(df: DataFrame, cols: list[str], edges: dict, prefix: str = "_b_") -> DataFrame:
    """Bucket index per column by binary search over literal edges (Spark
    ML ``Bucketizer``: compiled JVM code, no per-row lambdas). Buckets are
    contiguous value ranges; null/NaN inputs get their own bucket."""
    from pyspark.ml.feature import Bucketizer
    inf = float("inf")
    tmp = [f"_bz_in_{i}" for i in range(len(cols))]
    x = df.withColumns({t: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for t, c in zip(tmp, cols)})
    # without an edge there is one bucket, and nothing to search
    cut = [i for i, c in enumerate(cols) if edges[c]]
    plain = {f"{prefix}{i}": F.when(F.isnan(t), 1.0).otherwise(0.0) for i, t in enumerate(tmp) if i not in cut}
    x = x.withColumns(plain) if plain else x
    if cut:
        b = Bucketizer(splitsArray=[[-inf] + edges[cols[i]] + [inf] for i in cut], inputCols=[tmp[i] for i in cut],
                       outputCols=[f"{prefix}{i}" for i in cut], handleInvalid="keep")
        x = b.transform(x)
    return x.drop(*tmp)


# --------------------------------------------------------------------------
def exact_rank_values(df: DataFrame, cols: list[str], ranks: dict, n_buckets: int | None = None) -> dict:
    """Exact value at given 0-based ascending ranks of each column.

    ``ranks`` maps column -> list of ranks (ints). Nulls and NaN are
    skipped. Returns {column: {rank: value}}. A fixed number of jobs
    regardless of the number of columns: one pass for approximate edges, one
    for rows per bucket, one that counts the values of the (few) buckets
    holding the requested ranks. Nothing is written in between.
    """
    cols = [c for c in cols if ranks.get(c)]
    if not cols:
        return {c: {} for c in ranks}
    nb = n_buckets or default_buckets(df)
    probs = [i / nb for i in range(1, nb)]
    clean = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    erow = clean.agg(*[F.percentile_approx(F.col(f"`{c}`"), probs, 10000).alias(f"e{i}")
                       for i, c in enumerate(cols)]).collect()[0]
    edges = {c: _clean_edges(erow[f"e{i}"]) for i, c in enumerate(cols)}
    bz = _bucketize(clean, cols, edges)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value"),
                 F.col(f"_b_{i}").cast("int").alias("_bucket")) for i, c in enumerate(cols)]))
    long = bz.select(stack.alias("_kv")).select("_kv.*").filter(F.col("value").isNotNull())
    # pass 1: rows per bucket (columns x buckets rows, combined map-side)
    totals = long.groupBy("feature", "_bucket").agg(F.count(F.lit(1)).alias("c")).collect()
    by_feat: dict = {}
    for r in totals:
        by_feat.setdefault(r["feature"], []).append((int(r["_bucket"]), int(r["c"])))
    # which bucket holds each requested rank; offsets are exclusive prefix sums
    need: dict = {}
    offsets: dict = {}
    for f, lst in by_feat.items():
        lst.sort()
        acc = 0
        spans = []
        for b, c in lst:
            spans.append((b, acc, acc + c))
            offsets[(f, b)] = acc
            acc += c
        for r in ranks.get(f, []):
            for b, lo, hi in spans:
                if lo <= r < hi:
                    need.setdefault((f, b), []).append(r)
                    break
    out: dict = {c: {} for c in ranks}
    if not need:
        return out
    spark = df.sparkSession
    # the buckets to open, with their offsets, and the ranks sought in each:
    # at most (columns x ranks) rows, so broadcasting them is bounded
    wanted = spark.createDataFrame([(f, b, offsets[(f, b)]) for (f, b) in need],
                                   "feature string, _bucket int, _off bigint")
    ranks_df = spark.createDataFrame([(f, b, r) for (f, b), rs in need.items() for r in sorted(set(rs))],
                                     "feature string, _bucket int, _rank bigint")
    # pass 2: only the wanted buckets' rows reach the value counts
    sub = (long.join(F.broadcast(wanted), ["feature", "_bucket"])
               .groupBy("feature", "_bucket", "_off", "value").agg(F.count(F.lit(1)).alias("c")))
    w = Window.partitionBy("feature", "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    cum = sub.withColumn("cum", F.sum("c").over(w) + F.col("_off"))
    # value at rank r = smallest value whose inclusive cumulative count exceeds r
    hit = (cum.join(F.broadcast(ranks_df), ["feature", "_bucket"])
              .filter(F.col("cum") > F.col("_rank"))
              .groupBy("feature", "_rank").agg(F.min("value").alias("v")))
    for r in hit.collect():
        out[r["feature"]][int(r["_rank"])] = r["v"]
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    n_buckets: int | None = None, counts: dict | None = None) -> dict:
    """Exact quantiles with linear interpolation between order statistics
    (the default of pandas/numpy and of DuckDB ``quantile_cont``). The
    fractional position (n - 1) * p is taken in double precision, as those
    implementations do, so edges agree bit for bit where it matters.
    Returns {column: [q(p) for p in probs]} (None for empty columns)."""
    if counts is None:  # non-null, non-NaN values per column
        counts = df.agg(*[F.count(F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`"))).alias(c)
                          for c in cols]).collect()[0].asDict()
    ranks: dict = {}
    pos: dict = {}
    for c in cols:
        n = int(counts[c] or 0)
        if n == 0:
            continue
        for p in probs:
            h = (n - 1) * p
            lo = int(math.floor(h))
            hi = min(lo + 1, n - 1)
            pos[(c, p)] = (h, lo, hi)
            ranks.setdefault(c, set()).update({lo, hi})
    vals = exact_rank_values(df, cols, {c: sorted(r) for c, r in ranks.items()}, n_buckets)
    out = {}
    for c in cols:
        if c not in ranks:
            out[c] = [None for _ in probs]
            continue
        res = []
        for p in probs:
            h, lo, hi = pos[(c, p)]
            a, b = vals[c][lo], vals[c][hi]
            t = h - lo
            res.append(a if t == 0 or a == b else a + (b - a) * t)
        out[c] = res
    return out


# --------------------------------------------------------------------------
#: Rows of one window task, and the least that a cell is cut for.
WINDOW_ROWS = 1_000_000
LEAST_ROWS = 50_000


def window_rows(df: DataFrame, rows: int) -> int:
    """Rows that one window task may get: about a task per core and a half for
    middling tables, never over ``WINDOW_ROWS``."""
    tasks = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(WINDOW_ROWS, max(LEAST_ROWS, rows // tasks)))


def _safe_key(key: str) -> Column:
    """The key as a double for cutting; nulls and NaN count as the largest."""
    return F.coalesce(F.col(f"`{key}`").cast("double"), F.lit(float("nan")))


def _finite(x: Column) -> Column:
    return F.when(F.abs(x) < float("inf"), x)


def _magnitude(x: Column) -> Column:
    """The logarithm of the distance from 0, signed, rising with x (the least
    double's is -745)."""
    size = F.log(F.abs(F.when(x == 0, F.lit(1.0)).otherwise(x))) + 746
    return F.when(x == 0, F.lit(0.0)).when(x > 0, size).otherwise(-size)


def _cell_stats(df: DataFrame, by: list, key: str, bound: int) -> list:
    """(by..., _n, _lo, _hi) of the cells with more rows than ``bound``: at most
    rows / bound of them."""
    x = _finite(_safe_key(key))
    n = F.count(F.lit(1))
    return (df.groupBy(*by).agg(n.alias("_n"), F.min(x).alias("_lo"), F.max(x).alias("_hi"))
            .filter((F.col("_n") > bound) & (F.col("_lo") < F.col("_hi"))).collect())


def cut_cells(df: DataFrame, key: str, groups: list[str], bound: int) -> tuple[DataFrame, list[int]]:
    """``_cell``: contiguous key ranges of each group that hold at most ``bound``
    rows, and the ids of the cells of cut groups in key order.

    A group or cell with more rows is cut between its own smallest and largest
    key into four times as many pieces as it holds bounds of rows: of equal widths,
    or of equal ratios where the keys span magnitudes (both rise with the key, and
    a ratio cut leaves spans that widths can cut, so a few turns do). What still
    holds more is cut again. Each turn is one partial aggregation, and the
    driver only sees the cells to be cut: at most rows / bound. Equal keys are
    never parted, so keys should be unique within a group."""
    spark = df.sparkSession
    # cell 0 is all that is not cut; not a literal, as windows by a literal count as unpartitioned
    out = df.withColumn("_cell", F.pmod(F.hash(key), F.lit(1)).cast("bigint"))
    fresh, after = 1, {}  # next free id; cells that each cut cell became
    roots: list = []
    large = _cell_stats(df, groups, key, bound)
    kinds = ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in groups)
    by_group, turns = True, 0
    while large:
        rows = []
        for r in large:
            m = 4 * -(-r["_n"] // bound)
            ids = range(fresh, fresh + m)
            fresh += m
            own = [r[g] for g in groups] if by_group else [r["_cell"]]
            if by_group:
                roots.append(ids)
            else:
                after[r["_cell"]] = ids
            small, big = sorted((abs(r["_lo"]), abs(r["_hi"])))
            wide = r["_lo"] * r["_hi"] <= 0 or big / 1024 > small
            rows.append((*own, r["_lo"], r["_hi"], wide, m, ids[0]))
        own = [f"_g{i}" for i in range(len(groups))] if by_group else ["_was"]
        shape = (kinds if by_group else "_was bigint")
        cuts = F.broadcast(spark.createDataFrame(
            rows, (shape + ", " if shape else "") + "_lo double, _hi double, _wide boolean, _m bigint, _base bigint")
            .withColumnsRenamed(dict(zip(groups, own)) if by_group else {}))
        on = F.lit(True)
        for g, o in zip(groups if by_group else ["_cell"], own):
            on = on & F.col(f"`{g}`").eqNullSafe(F.col(o))
        x = _safe_key(key)
        here, low, high = (F.when(F.col("_wide"), _magnitude(v)).otherwise(v) for v in (x, F.col("_lo"), F.col("_hi")))
        place = F.floor((here - low) / (high - low) * F.col("_m"))
        part = F.when(F.isnan(x) | (x >= F.col("_hi")), F.col("_m") - 1).when(x <= F.col("_lo"), F.lit(0)).otherwise(
            F.least(F.greatest(place, F.lit(0)), F.col("_m") - 1))
        out = (out.join(cuts, on, "left").withColumn("_cell", F.coalesce(F.col("_base") + part, F.col("_cell")))
               .drop("_lo", "_hi", "_wide", "_m", "_base", *own))
        turns += 1
        if turns > 2:  # keep the plan short
            out = materialize(out)
        large = _cell_stats(out.filter("_cell > 0"), ["_cell"], key, bound)
        large = [r for r in large if r["_cell"] not in after]
        by_group = False
    order, todo = [], [c for ids in reversed(roots) for c in reversed(ids)]
    while todo:
        c = todo.pop()
        todo.extend(reversed(after[c])) if c in after else order.append(c)
    return out, order


def grouped_prefix_sums(df: DataFrame, groups: list[str], key: str, sums: list[str], descending: bool = False,
                        bound: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Inclusive running sums of ``sums`` in ``key`` order within every group, as
    ``cum_<col>``, for all groups in one pass. ``key`` is unique within a group.
    No window task gets more than ``bound`` rows, however the rows spread over
    groups and keys: small groups are one window partition each, large ones are
    cut into cells whose totals are added as offsets."""
    if checkpoint:  # the frame feeds several passes; compute it once
        df = materialize(df)
    bound = bound or window_rows(df, df.count())
    cells, order = cut_cells(df, key, groups, bound)
    by = F.col(f"`{key}`").desc_nulls_first() if descending else F.col(f"`{key}`").asc_nulls_last()
    w = Window.partitionBy(*groups, "_cell").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    out = cells.select("*", *[F.sum(c).over(w).alias(f"cum_{c}") for c in sums])
    if order:
        found = {r["_cell"]: r for r in cells.filter("_cell > 0").groupBy("_cell", *groups).agg(
            *[F.sum(c).alias(f"_s_{c}") for c in sums]).collect()}  # one row a cell of the cut groups
        before: dict = {}
        kinds = {c: df.select(F.sum(c).alias("s")).schema["s"].dataType.simpleString() for c in sums}
        rows = []
        for c in reversed(order) if descending else order:
            if c in found:
                r = found[c]
                have = before.setdefault(tuple(r[g] for g in groups), {s: 0 for s in sums})
                rows.append((c, *[float(have[s]) if kinds[s] == "double" else have[s] for s in sums]))
                for s in sums:
                    have[s] += r[f"_s_{s}"] or 0
        shape = ", ".join(f"`_off_{c}` {kinds[c]}" for c in sums)
        offsets = F.broadcast(df.sparkSession.createDataFrame(rows, f"_cell bigint, {shape}"))  # one row a cell
        out = out.join(offsets, "_cell", "left")
        out = out.withColumns({f"cum_{c}": F.col(f"cum_{c}") + F.coalesce(F.col(f"_off_{c}"), F.lit(0)) for c in sums})
        out = out.drop(*[f"_off_{c}" for c in sums])
    return out.drop("_cell")


def prefix_sums(df: DataFrame, key: str, sums: list[str], descending: bool = False,
                n_buckets: int | None = None, checkpoint: bool = True) -> tuple[DataFrame, dict]:
    """Inclusive running sums of ``sums`` in ``key`` order over a frame whose
    ``key`` is unique (e.g. the output of ``groupBy(key)``). Returns the
    frame with ``cum_<col>`` columns and the grand totals (dict). ``n_buckets``
    asks for that many window tasks at least."""
    if checkpoint:  # the frame feeds several passes; compute it once
        df = materialize(df)
    whole = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in sums]).first()
    bound = -(-whole["_n"] // n_buckets) if n_buckets else window_rows(df, whole["_n"])
    out = grouped_prefix_sums(df, [], key, sums, descending, max(1, bound), checkpoint=False)
    return out, {c: whole[c] or 0 for c in sums}
