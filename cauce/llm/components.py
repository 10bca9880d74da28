"""Connected components of a distributed edge table.

Alternating large-star / small-star rounds (Kiveris et al., 2014): every round
is two group-bys with map-side minima, hub nodes only ever pass on their
minimum, and the edges end as stars (node, smallest node of its component).
Each round's edges are written under the shared checkpoint folder, which cuts
the lineage. Node ids may be of any orderable type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a")
    return (linked.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b; a <> b):
    the component is named by its smallest node."""
    kind = edges.schema["a"].dataType
    edges = stage(edges.select("a", "b").where("a <> b"))
    before = None
    while True:
        nxt = stage(_small_star(_large_star(edges)))
        # the edge set is a fixed point once count and content digest repeat
        now = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        edges, before = nxt, now
    star = nxt.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = nxt.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return star.unionByName(roots).select(F.col("node").cast(kind), F.col("component").cast(kind))
