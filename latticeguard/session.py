"""Spark session helpers: one place for the settings every job relies on."""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "latticeguard") -> SparkSession:
    """Session for tests / bench. On a cluster, use the cluster's own session;
    the settings below are the ones the jobs assume (UTC, ANSI, AQE)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LG_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (spark.checkpoint.dir).

    Only a single-machine session (tests, bench) may leave it unset; it then gets a scratch folder
    of its own. On a cluster, a machine-local folder would lose rows, so an unset one is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="lg-ckpt-", dir=os.environ.get("LG_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as parquet under the shared checkpoint folder and read it back.

    For results that are read more than once: the read-back plan is a plain scan with a known
    size, so later steps neither recompute nor depend on a cache match, and the files survive
    executor loss. `release` deletes them.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._materialized_path = path
    return back


def release(df: DataFrame) -> None:
    """Delete the files behind a `materialize` result that nothing reads any more."""
    path = getattr(df, "_materialized_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
        df._materialized_path = None
