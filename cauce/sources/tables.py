"""Table scans (S1, S2, S3, S7). Column pruning and filter pushdown are left
to Catalyst: callers select what they need and the Parquet scan's
ReadSchema / PushedFilters shrink accordingly."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, source: str, name: str | None = None) -> DataFrame:
    """``source`` is a catalog table name, a Parquet path, or a folder that
    holds ``<name>.parquet``."""
    if name is not None:
        return spark.read.parquet(os.path.join(source, f"{name}.parquet"))
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def scan_transactions(spark: SparkSession, source: str) -> DataFrame:
    """The transaction fact table, one row per order."""
    return read_table(spark, source)


def stored_transactions(spark: SparkSession, table: str) -> DataFrame:
    """S1 over a table of ``sinks.write_transactions``. Spark reports the order
    within a bucket only with the session setting that is switched on here; it
    holds as long as a bucket is one file. After appends a build sorts within
    its tasks again, but still shuffles nothing."""
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    return spark.table(table)


def scan_features(df_or_source, spark: SparkSession | None = None,
                  exclude: tuple = ("ultimo_canal",)) -> DataFrame:
    """Feature table without the excluded columns (``SELECT * EXCEPT``)."""
    df = df_or_source if isinstance(df_or_source, DataFrame) else read_table(spark, df_or_source)
    return df.drop(*exclude)
