"""Small helpers that the operators share."""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.session import materialize

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers that were started
    without it on their path (the package travels as a zip with the job)."""
    import cauce
    root = os.path.dirname(os.path.dirname(os.path.abspath(cauce.__file__)))
    app = spark.sparkContext.applicationId
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if app in _SHIPPED or root in on_path or not os.path.isdir(os.path.join(root, "cauce")):
        return
    d = tempfile.mkdtemp(prefix="cauce-code-")  # read by the driver's file server until the session ends
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(d, "cauce"), "zip", root, "cauce"))
    _SHIPPED.add(app)


def stage(df: DataFrame) -> DataFrame:
    """Write a frame once under the shared checkpoint folder and reread it."""
    return materialize(df)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_cuts(df: DataFrame, key: str, n: int) -> list[int]:
    """At most ``n - 1`` ascending cut values of an integer column, from one
    approximate-quantile pass over that column alone (driver holds < n values)."""
    if n < 2:
        return []
    got = df.approxQuantile(key, [i / n for i in range(1, n)], 0.25 / n)
    return sorted({int(x) for x in got})


def bucket_of(key: Column, cuts: list[int]) -> Column:
    """Ascending range bucket 0..len(cuts) of an integer key: the number of cuts
    <= key, by binary search. Null keys fall in bucket 0."""
    if not cuts:
        return F.lit(0)
    edges = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def bucket(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(np.int64), "right"))

    return bucket(F.coalesce(key.cast("long"), F.lit(-(1 << 63))))
