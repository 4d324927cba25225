"""Reading versioned exports: the newest complete snapshot, or the one that held at a time.

A snapshot is all folders <prefix>_<version>_<stamp> of one stamp. It is complete if every one of them
has its writer's success mark. Only folder names reach the driver; the rows stay on Spark.
"""
from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = "schema_version"
_NULL = "__HIVE_DEFAULT_PARTITION__"


def _names(spark: SparkSession, path: str) -> list[str]:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def snapshots(spark: SparkSession, root: str, prefix: str = "features") -> dict[str, list[str]]:
    """Folders of each complete snapshot, by stamp, oldest first."""
    root, found, broken = root.rstrip("/"), {}, set()
    for name in _names(spark, root):
        match = re.fullmatch(rf"{re.escape(prefix)}_(.+)_([0-9]{{8}}T[0-9]{{6}}[^_]*)", name)
        if match:
            found.setdefault(match[2], []).append(f"{root}/{name}")
            if "_SUCCESS" not in _names(spark, f"{root}/{name}"):
                broken.add(match[2])
    return {stamp: found[stamp] for stamp in sorted(found) if stamp not in broken}


def read_snapshot(spark: SparkSession, root: str, as_of: str | None = None, prefix: str = "features") -> DataFrame:
    """The newest complete snapshot, or the newest whose time (YYYYMMDDTHHMMSS) is not after `as_of`.

    Versions may differ in their columns: a column that a version lacks is null in its rows. The version is the
    text it was written under ("1.10" is not 1.1). No such snapshot is an error.
    """
    held = {stamp: paths for stamp, paths in snapshots(spark, root, prefix).items() if as_of is None or stamp[:15] <= as_of}
    if not held:
        raise FileNotFoundError(f"no complete snapshot of {prefix} under {root}" + (f" as of {as_of}" if as_of else ""))
    rows = None
    for path in held[max(held)]:
        for name in _names(spark, path):
            if name.startswith(f"{PARTITION}="):
                value = unquote(name.split("=", 1)[1])
                part = spark.read.parquet(f"{path}/{name}").withColumn(
                    PARTITION, F.lit(None if value == _NULL else value).cast("string"))
                rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    if rows is None:
        raise FileNotFoundError(f"the snapshot {max(held)} under {root} holds no rows")
    return rows
