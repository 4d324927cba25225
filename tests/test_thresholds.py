"""Thresholds / buckets: the reference's cases plus NaN/NULL traps."""
import math

import pytest
from pyspark.sql import functions as F

from latticeguard.config import Thresholds
from latticeguard.functions.exprs import clip01, priority_bucket, priority_rank


def _bucket(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s double")
    return [r["p"] for r in df.select("i", priority_bucket(F.col("s")).alias("p")).orderBy("i").collect()]


def test_default_table_loads():
    t = Thresholds()
    assert t.priorities == ["CRITICAL", "HIGH", "MEDIUM", "LOW"]


def test_boundaries_inclusive(spark):
    assert _bucket(spark, [0.9, 0.75, 0.6, 0.3, 0.0]) == ["CRITICAL", "CRITICAL", "HIGH", "MEDIUM", "LOW"]


def test_nan_null_negative(spark):
    assert _bucket(spark, [float("nan"), None, -0.1]) == ["LOW", None, "LOW"]


def test_rank_order_and_unknown():
    t = Thresholds()
    assert [t.rank(p) for p in t.priorities] == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        t.rank("URGENT")


def test_unknown_priority_raises_in_spark(spark):
    df = spark.createDataFrame([("URGENT",)], "p string")
    with pytest.raises(Exception):
        df.select(priority_rank(F.col("p"))).collect()


def test_out_of_order_and_empty_rejected():
    with pytest.raises(ValueError):
        Thresholds((("LOW", 0.0), ("CRITICAL", 0.75)))
    with pytest.raises(ValueError):
        Thresholds(())


def test_clip_keeps_nan_and_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, -0.5), (4, 1.5), (5, 0.3)], "i int, x double")
    out = [r["c"] for r in df.select("i", clip01(F.col("x")).alias("c")).orderBy("i").collect()]
    assert math.isnan(out[0]) and out[1] is None and out[2:] == [0.0, 1.0, 0.3]
