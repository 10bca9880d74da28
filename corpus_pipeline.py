"""The corpus pipeline: documents through quality, near-duplicate, secret,
mixing and packing stages. Each stage's frame is written as Parquet under the
shared checkpoint folder and reread as the next stage's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cauce.llm import mixing, packing, quality, secret_scan, simhash
from cauce.llm.common import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with every secret replaced by a mark."""
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix to target weights takes them."""
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Harmonic packing of what is left into sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [("quality", good_quality), ("near_duplicates", distinct), ("secrets", without_secrets),
          ("mixing", mixed), ("packing", packed)]

#: A trained classifier and a seeded subset are not SQL; tests hold every
#: stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES in order to the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs)
    return docs
