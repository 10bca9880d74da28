"""Approximate nearest neighbours by low-dimensional stable projections.

Unit vectors are projected by ``m`` Gaussian (2-stable) directions: given two
vectors at distance d, their squared projected distance over d**2 is chi-square
with m degrees of freedom. The projections are indexed by a kd-tree, and a
query verifies true distances in order of projected distance. It stops at
projected distance x once P(chi-square <= x**2 / d_k**2) reaches ``certainty``,
where d_k is the k-th smallest distance verified: any one nearer vector is then
still unseen with a chance of at most 1 - certainty.

Distributed, the top of the kd-tree cuts the projected space into regions (its
split values are fitted on at most ``SAMPLE`` vectors, but every vector is
indexed) and each region's task builds the tree below. A query first searches
its own region; its d_k and the regions' bounding boxes then tell by the same
test which other regions it has to visit. Equal vectors are collapsed, within a
batch before anything is shuffled, to one entry with their k + 1 smallest ids
(no query can use more), and equal queries are searched once.

Defined results: vectors that are null, zero, hold null or non-finite components
or are not of the most frequent length, and rows without id, take no part; rows
that repeat an id and vector are one; the copies of a query's id are its own;
fewer than k candidates give fewer rows; an empty table none. Among all that a
query verifies, ties go to the smaller id, and vectors of one direction (scaled
copies) are all verified. Vectors are multiplied by powers of two before products
and norms, which changes no digit, so any finite components may be scored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import ship, stage

#: Vectors that the split values are fitted on; vectors per task; regions that
#: the splits make. With more vectors each region is dealt to several tasks by hash.
SAMPLE, REGION, REGIONS = 20_000, 20_000, 4096
LEAF, STEP = 32, 512
#: Rounding of a squared distance between unit vectors, and of one between projections.
SLACK = 1e-13


def chi_square(x: np.ndarray, m: int) -> np.ndarray:
    """Chi-square distribution function for an even number m."""
    half = np.minimum(np.asarray(x, np.float64) / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, m // 2):
        term = term * half / i
        total += term
    return 1 - np.exp(-half) * total


def stop_ratio(m: int, certainty: float) -> float:
    """The x**2 / d**2 at which the distribution reaches the certainty."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(np.array(mid), m) < certainty else (low, mid)
    return high


def directions(dim: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, m))


def scaled(v: np.ndarray) -> np.ndarray:
    """Every row times the power of two that brings its largest component to
    0.5 .. 1: the same digits, but no product leaves the range of doubles."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def unit(v: np.ndarray) -> np.ndarray:
    v = scaled(v)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


class Splits:
    """The top of the kd-tree: axis and value of each inner node, as a heap."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.value = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
        groups = {1: sample}
        for node in range(1, 1 << depth):
            own = groups.pop(node)
            if len(own):
                spread = own.max(0) - own.min(0)
                self.axis[node] = int(np.argmax(spread))
                self.value[node] = float(np.median(own[:, self.axis[node]]))
            right = own[:, self.axis[node]] >= self.value[node] if len(own) else np.empty(0, bool)
            groups[2 * node], groups[2 * node + 1] = own[~right], own[right]

    def region(self, y: np.ndarray) -> np.ndarray:
        node = np.ones(len(y), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (y[np.arange(len(y)), self.axis[node]] >= self.value[node])
        return node - (1 << self.depth)


class Tree:
    """A kd-tree's leaves over projections: points in leaf order and boxes."""

    def __init__(self, y: np.ndarray):
        parts, todo = [], [np.arange(len(y))]
        while todo:
            own = todo.pop()
            if len(own) <= LEAF:
                parts.append(own)
                continue
            axis = int(np.argmax(y[own].max(0) - y[own].min(0)))
            order = own[np.argsort(y[own, axis], kind="stable")]
            todo += [order[:len(own) // 2], order[len(own) // 2:]]
        self.order = np.concatenate(parts)
        self.size = np.array([len(p) for p in parts])
        self.start = np.cumsum(self.size) - self.size
        self.low = np.stack([y[p].min(0) for p in parts])
        self.high = np.stack([y[p].max(0) for p in parts])

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Squared projected distance of a point to each leaf's box."""
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        return (gap * gap).sum(1)


def search(tree: Tree, score, qy: np.ndarray, known: float, ratio: float, ids: list, k: int) -> list[tuple[float, int]]:
    """The k nearest (-score, id) to a query, verified until the stopping test
    holds. ``known``: a squared k-th distance found elsewhere; ``score`` gives
    the measure of entries, ``ids`` their ids. Only entries that are beaten by k
    others, ties by id, are let go."""
    bounds = tree.bounds(qy)
    leaves = np.argsort(bounds, kind="stable")
    best: list[tuple[float, int]] = []
    limit, i = known, 0
    while i < len(leaves) and bounds[leaves[i]] <= ratio * (limit + SLACK):
        j, n = i, 0
        while j < len(leaves) and n < STEP and bounds[leaves[j]] <= ratio * (limit + SLACK):
            n += tree.size[leaves[j]]
            j += 1
        at = np.concatenate([tree.order[tree.start[x]:tree.start[x] + tree.size[x]] for x in leaves[i:j]])
        s = score(at)
        if len(best) == k:
            near = s >= -best[-1][0]
            at, s = at[near], s[near]
        best = sorted(best + [(-v, x) for v, a in zip(s.tolist(), at.tolist()) for x in ids[a]])[:k]
        if len(best) == k:
            limit = min(limit, max(2 + 2 * best[-1][0], 0.0))
        i = j
    return best


def clean(table: DataFrame, id_column: str, vector: str) -> tuple[DataFrame, int]:
    """(rows that take part as id, vec (32-bit or 64-bit floats as stored), dim)."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    rows = table.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & finite & some) \
        .select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    top = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = top["d"] if top else 0
    return rows.where(F.size("vec") == dim), dim


def collapsed(rows: DataFrame, dim: int, k: int) -> DataFrame:
    """vec (binary doubles) and its smallest k + 1 ids, per distinct vector."""
    def batchwise(batches):
        for b in batches:
            v = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            ids = b.column(0).to_numpy()
            order = np.argsort(ids, kind="stable")
            groups: dict[bytes, list[int]] = {}
            for i in order.tolist():
                own = groups.setdefault(v[i].tobytes(), [])
                if len(own) <= k and (not own or own[-1] != ids[i]):
                    own.append(int(ids[i]))
            yield pa.RecordBatch.from_arrays([pa.array(list(groups), pa.binary()),
                                              pa.array(list(groups.values()), pa.list_(pa.int64()))], ["vec", "ids"])

    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    return rows.mapInArrow(batchwise, "vec binary, ids array<long>").groupBy("vec").agg(ids.alias("ids"))


def _doubles(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def nearest(table: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector: str = "embedding",
            m: int = 8, certainty: float = 0.99, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest cosine found for
    every query row, among all rows but the query's own."""
    spark = table.sparkSession
    ship(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    wanted = table.where(is_query)
    rows, dim = clean(table, id_column, vector)
    if not dim:
        return empty
    base, ratio = directions(dim, m, seed), stop_ratio(m, certainty)

    entries = stage(collapsed(rows, dim, k))
    n = entries.count()
    depth = max(0, min(int(math.log2(REGIONS)), math.ceil(math.log2(max(1, n / REGION)))))
    parts = max(1, math.ceil(n / REGION / REGIONS))  # tasks to a region
    share = min(1.0, 1.5 * SAMPLE / max(1, n))
    sample = entries.where(F.abs(F.xxhash64("vec") % 1_000_000) < int(share * 1_000_000)).select("vec") \
        .limit(SAMPLE).toArrow()  # at most SAMPLE vectors
    top = Splits(unit(_doubles(sample["vec"], dim)) @ base if sample.num_rows else np.empty((0, m)), depth)

    def place(batches, dealt):
        for b in batches:
            y = unit(_doubles(b.column(0), dim)) @ base
            part = [zlib.crc32(v) % parts if dealt else 0 for v in b.column(0).to_pylist()]
            region = top.region(y) * parts + np.array(part, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(region.astype(np.int32)),
                                              pa.array([r.tobytes() for r in y], pa.binary())],
                                             [*b.schema.names, "region", "y"])

    index = stage(entries.mapInArrow(lambda bs: place(bs, True), "vec binary, ids array<long>, region int, y binary"))

    def boxes(batches):
        low, high = {}, {}
        for b in batches:
            region, y = b.column(0).to_numpy(), _doubles(b.column(1), m)
            for r in np.unique(region).tolist():
                own = y[region == r]
                low[r] = np.minimum(low.get(r, np.inf), own.min(0))
                high[r] = np.maximum(high.get(r, -np.inf), own.max(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(low), pa.int32()), pa.array([x.tolist() for x in low.values()], pa.list_(pa.float64())),
             pa.array([x.tolist() for x in high.values()], pa.list_(pa.float64()))], ["region", "low", "high"])

    per = index.select("region", "y").mapInArrow(boxes, "region int, low array<double>, high array<double>")
    box = (per.groupBy("region").agg(*[F.min(F.col("low")[i]).alias(f"l{i}") for i in range(m)],
                                     *[F.max(F.col("high")[i]).alias(f"h{i}") for i in range(m)])
           .toPandas().sort_values("region"))  # one row a task's region
    names = box["region"].to_numpy()
    lows, highs = box[[f"l{i}" for i in range(m)]].to_numpy(), box[[f"h{i}" for i in range(m)]].to_numpy()

    asked, _ = clean(wanted, id_column, vector)
    asked = asked.where(F.size("vec") == dim)

    def keyed(batches):
        for b in batches:
            v = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in v], pa.binary())], ["id", "vec"])

    asked = stage(asked.mapInArrow(keyed, "id long, vec binary").distinct())
    queries = stage(asked.select("vec").distinct()
                    .mapInArrow(lambda bs: place(bs, False), "vec binary, region int, y binary")
                    .withColumn("known", F.lit(float("inf"))))

    result = "vec binary, known double, found array<struct<score:double,id:long>>"

    def look(qs: pa.Table, es: pa.Table) -> pa.Table:
        kinds = pa.schema([("vec", pa.binary()), ("known", pa.float64()),
                           ("found", pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64())])))])
        if not qs.num_rows or not es.num_rows:
            return kinds.empty_table()
        ids, tree = es["ids"].to_pylist(), Tree(_doubles(es["y"], m))
        v = scaled(_doubles(es["vec"], dim))
        norms = np.sqrt((v * v).sum(1))
        out: list[list] = [[], [], []]
        for key, q, qy, known in zip(qs["vec"].to_pylist(), scaled(_doubles(qs["vec"], dim)), _doubles(qs["y"], m),
                                     qs["known"].to_pylist()):
            own = np.sqrt((q * q).sum())
            pairs = search(tree, lambda at: (v[at] * q).sum(1) / (norms[at] * own), qy, known, ratio, ids, k + 1)
            out[0].append(key)
            out[1].append(max(2 + 2 * pairs[k][0], 0.0) if len(pairs) > k else float("inf"))
            out[2].append([{"score": -s, "id": i} for s, i in pairs])
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, kinds.types)], schema=kinds)

    def visit(to: DataFrame) -> DataFrame:
        return to.select("region", "vec", "y", "known").groupBy("region").cogroup(
            index.groupBy("region")).applyInArrow(look, result)

    home = stage(visit(queries))

    def others(batches):
        for b in batches:
            vec, own, y, known = b.column(0), b.column(1).to_numpy(), _doubles(b.column(2), m), b.column(3).to_numpy()
            cols: list[list] = [[], [], [], []]
            for i in range(b.num_rows):
                gap = np.maximum(np.maximum(lows - y[i], y[i] - highs), 0)
                go = names[((gap * gap).sum(1) <= ratio * (known[i] + SLACK)) & (names != own[i])]
                cols[0] += go.tolist()
                cols[1] += [vec[i].as_py()] * len(go)
                cols[2] += [y[i].tobytes()] * len(go)
                cols[3] += [known[i]] * len(go)
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["region", "vec", "y", "known"])

    # a query whose region has no entry at all still visits the others
    bound = queries.drop("known").join(home.select("vec", "known"), "vec", "left") \
        .select("vec", "region", "y", F.coalesce("known", F.lit(float("inf"))).alias("known"))
    away = visit(bound.mapInArrow(others, "region int, vec binary, y binary, known double"))
    both = home.unionByName(away).groupBy("vec").agg(F.flatten(F.collect_list("found")).alias("found"))

    def ranked(batches):
        for b in batches:
            cols: list[list] = [[], [], [], []]
            for query, found in zip(*(c.to_pylist() for c in b.columns)):
                seen = {query}
                for f in sorted(found, key=lambda f: (-f["score"], f["id"])):
                    if f["id"] not in seen and len(seen) <= k:
                        seen.add(f["id"])
                        for col, v in zip(cols, (query, len(seen) - 1, f["id"], f["score"])):
                            col.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["query_id", "rank", "vec_id", "score"])

    return asked.join(both, "vec").select("id", "found").mapInArrow(
        ranked, "query_id long, rank int, vec_id long, score double")
