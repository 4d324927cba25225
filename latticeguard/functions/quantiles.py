"""Exact order statistics and row numbers without a global sort or one-task window.

* `order_statistics` finds exact k-th smallest values by histogram refinement:
  each pass is one partial-aggregated group-by over (window, bin) and returns a
  bounded histogram (windows x bins rows) to the driver; a hot value (one value
  holding a third of the rows) resolves immediately because its bin has
  min == max. Only a bin with at most `small` rows is ever fetched.
* `hashed_row_number` gives the exact row_number() over (partition by g order
  by h) for a uniform hex hash h: counts per (g, hash prefix) form a bounded
  table; the final window is partitioned by (g, prefix), so no single task sees
  a whole group.
* `rows_before` turns a count table into offsets with two-level prefix sums, so that
  even an unpartitioned running sum never has all its rows in one task.
"""
from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rows_before(counts: DataFrame, group_cols: list[str], bucket_col: str, count_col: str, out_col: str,
                coarse: int = 4096) -> DataFrame:
    """`counts` (one row per group and bucket, an integer) with the running sum of `count_col` over lower buckets.

    Buckets are summed by range first; the running sum over the ranges sees one row per
    range, and the sum inside a range at most `coarse` rows.
    """
    rng = F.floor(F.col(bucket_col) / F.lit(coarse)).cast("long")
    c = counts.withColumn("_range", rng)
    per_range = c.groupBy(*group_cols, "_range").agg(F.sum(count_col).alias("_in_range"))
    earlier = Window.partitionBy(*group_cols).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offs = per_range.select(*group_cols, "_range", F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_ranges"))
    inside = Window.partitionBy(*group_cols, "_range").orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("_inside", F.coalesce(F.sum(count_col).over(inside), F.lit(0)))
    return c.join(offs, [*group_cols, "_range"]).withColumn(out_col, F.col("_ranges") + F.col("_inside")) \
        .drop("_range", "_ranges", "_inside")


def _values(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))


def order_statistics(df: DataFrame, col: str, ranks: list[int], bins: int = 1024,
                     small: int = 4096, _prepared: tuple | None = None) -> dict[int, float]:
    """Exact 0-based order statistics of the non-null, non-NaN values of `col`."""
    if _prepared is None:
        x = _values(df, col).persist(StorageLevel.MEMORY_AND_DISK)
        n, lo, hi = x.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    else:
        x, n, lo, hi = _prepared
    try:
        return _select(x, n, lo, hi, ranks, bins, small)
    finally:
        if _prepared is None:
            x.unpersist()


def _select(x: DataFrame, n: int, lo: float, hi: float, ranks: list[int], bins: int, small: int) -> dict[int, float]:
    if not n:
        return {}
    for r in ranks:
        if r < 0 or r >= n:
            raise ValueError(f"rank {r} outside [0, {n})")
    # window -> (base rank, count, target ranks)
    windows: dict[tuple[float, float], tuple[int, int, set[int]]] = {(lo, hi): (0, n, set(ranks))}
    result: dict[int, float] = {}
    while windows:  # a window's ends fall into different bins, so every pass narrows it
        # windows with a single value resolve without touching the data
        for w in [w for w in windows if w[0] == w[1]]:
            for r in windows.pop(w)[2]:
                result[r] = w[0]
        if not windows:
            return result
        small_w = {w: v for w, v in windows.items() if v[1] <= small}
        big_w = {w: v for w, v in windows.items() if v[1] > small}
        if small_w:
            cond = None
            for (a, b) in small_w:
                c = (F.col("v") >= F.lit(a)) & (F.col("v") <= F.lit(b))
                cond = c if cond is None else (cond | c)
            vals = sorted(r[0] for r in x.where(cond).collect())  # bounded: <= small per window
            for (a, b), (base, cnt, targets) in small_w.items():
                inside = [v for v in vals if a <= v <= b]
                for r in targets:
                    result[r] = inside[r - base]
        if not big_w:
            return result
        wid, binc = None, None
        for i, (a, b) in enumerate(big_w):
            inw = (F.col("v") >= F.lit(a)) & (F.col("v") <= F.lit(b))
            bi = F.least(F.floor((F.col("v") / 2 - F.lit(a / 2)) / F.lit(b / 2 - a / 2) * F.lit(float(bins))),
                         F.lit(bins - 1)).cast("int")
            wid = F.when(inw, F.lit(i)) if wid is None else wid.when(inw, F.lit(i))
            binc = F.when(inw, bi) if binc is None else binc.when(inw, bi)
        hist = (
            x.select(wid.alias("w"), binc.alias("b"), "v").where(F.col("w").isNotNull())
            .groupBy("w", "b").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("mn"), F.max("v").alias("mx"))
            .collect()
        )  # bounded: len(big_w) * bins rows
        by_w: dict[int, list] = {}
        for row in hist:
            by_w.setdefault(row["w"], []).append(row)
        new_windows: dict[tuple[float, float], tuple[int, int, set[int]]] = {}
        for i, ((a, b), (base, cnt, targets)) in enumerate(big_w.items()):
            cum = base
            for row in sorted(by_w.get(i, []), key=lambda r: r["b"]):
                hit = {r for r in targets if cum <= r < cum + row["c"]}
                if hit:
                    key = (row["mn"], row["mx"])
                    prev = new_windows.get(key)
                    new_windows[key] = (cum, row["c"], (prev[2] if prev else set()) | hit)
                cum += row["c"]
        windows = new_windows
    return result


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    """Linear-interpolated quantiles (same rule as SQL quantile_cont): lo + (hi - lo) * frac."""
    x = _values(df, col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, lo, hi = x.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
        if n == 0:
            return [None for _ in probs]
        pos = [(n - 1) * p for p in probs]
        needed = sorted({int(math.floor(h)) for h in pos} | {int(math.ceil(h)) for h in pos})
        stats = order_statistics(df, col, needed, _prepared=(x, n, lo, hi))
    finally:
        x.unpersist()
    out = []
    for h in pos:
        lo_i, hi_i = int(math.floor(h)), int(math.ceil(h))
        a, b = stats[lo_i], stats[hi_i]
        out.append(a + (b - a) * (h - lo_i))
    return out


def qcut_column(v: Column, edges: list[float]) -> Column:
    """pandas.qcut codes for given edges: duplicates dropped, right-closed, lowest included;
    fewer than two distinct edges gives NULL (no bin)."""
    d = sorted(set(e for e in edges if e is not None))
    if len(d) < 2:
        return F.lit(None).cast("int")
    chain = F.when(v.isNull() | F.isnan(v), F.lit(None).cast("int"))
    chain = chain.when(v < F.lit(d[0]), F.lit(None).cast("int")).when(v > F.lit(d[-1]), F.lit(None).cast("int"))
    for i, e in enumerate(d[1:]):
        chain = chain.when(v <= F.lit(e), F.lit(i))
    return chain


def hashed_row_number(df: DataFrame, group_cols: list[str], hash_col: str, prefix_len: int = 3,
                      out_col: str = "rn", count_col: str | None = None) -> DataFrame:
    """Exact row_number() over (partition by group_cols order by hash_col, hex hash).

    Assumes `hash_col` is unique within a group (md5 of a unique key), so the order is
    total. The (group, prefix) count table has at most 16**prefix_len rows per group; Spark
    broadcasts it if it is small and joins it by key otherwise.
    """
    d = df.withColumn("_pfx", F.substring(F.col(hash_col), 1, prefix_len))
    counts = d.groupBy(*group_cols, "_pfx").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*group_cols).orderBy("_pfx").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("_c").over(Window.partitionBy(*group_cols)).alias(count_col)] if count_col else []
    offs = counts.select(*group_cols, "_pfx", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_before"), *extra)
    j = d.join(offs, [*group_cols, "_pfx"], "inner")
    wr = Window.partitionBy(*group_cols, "_pfx").orderBy(hash_col)
    return j.withColumn(out_col, F.col("_before") + F.row_number().over(wr)).drop("_pfx", "_before")
