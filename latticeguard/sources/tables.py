"""Readers for the driver's parquet tables and the repo's own sinks.

Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so
callers select only what they use.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


def spread(df: DataFrame) -> DataFrame:
    """Spread CPU-heavy per-row work (text splitting, regexes, scoring) over all cores
    when the scan yields fewer partitions than the cluster has task slots (a few large
    files). A large input already scans as many partitions, and then this is a no-op:
    the text is never shuffled at scale. Callers select their columns first."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
