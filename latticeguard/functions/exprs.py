"""Column-expression library: NaN/NULL-safe clip, bucketing, keyed randomness.

All functions return native Spark expressions (no Python UDFs), so they stay
inside whole-stage codegen and give the same answer under any partitioning.
"""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Thresholds


def clip01(x: Column) -> Column:
    """Clamp to [0, 1] keeping NaN as NaN and NULL as NULL (not greatest/least)."""
    return (
        F.when(F.isnan(x), x)
        .when(x < F.lit(0.0), F.lit(0.0))
        .when(x > F.lit(1.0), F.lit(1.0))
        .otherwise(x)
    )


def priority_bucket(score: Column, thresholds: Thresholds = Thresholds()) -> Column:
    """First bucket with score >= min_score; NaN falls to the last bucket; NULL stays NULL."""
    last = thresholds.buckets[-1][0]
    chain = F.when(score.isNull(), F.lit(None).cast("string")).when(F.isnan(score), F.lit(last))
    for priority, min_score in thresholds.buckets:
        chain = chain.when(score >= F.lit(float(min_score)), F.lit(priority))
    return chain.otherwise(F.lit(last))


def priority_rank(priority: Column, thresholds: Thresholds = Thresholds()) -> Column:
    """0 = most urgent; an unknown priority raises at execution time."""
    chain = F.when(priority.isNull(), F.lit(None).cast("int"))
    for i, name in enumerate(thresholds.priorities):
        chain = chain.when(priority == F.lit(name), F.lit(i))
    return chain.otherwise(
        F.raise_error(F.concat(F.lit("unknown priority "), priority)).cast("int")
    )


def hash_uniform(key: Column, seed: int, tag: str) -> Column:
    """Keyed uniform in (0, 1): first 32 bits of md5('seed:tag:key'), centred in its cell."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(tag), key.cast("string")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)


def hash_normal(key: Column, seed: int, tag: str = "", std: float = 1.0) -> Column:
    """Keyed normal by Box-Muller from two keyed uniforms (tags '<tag>a', '<tag>b')."""
    u1 = hash_uniform(key, seed, tag + "a")
    u2 = hash_uniform(key, seed, tag + "b")
    return F.lit(float(std)) * F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def sort_hash(key: Column, seed: int) -> Column:
    """Deterministic shuffle order: md5 hex of 'seed:key' (a total order with the key as tie-break)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def epoch_millis_to_ts(x: Column) -> Column:
    """Epoch milliseconds given as number or text; garbage gives NULL."""
    return F.timestamp_millis(x.cast("string").try_cast("bigint"))

