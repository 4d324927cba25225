"""Quantile strata, stratified split, shuffled split and k-fold assignment.

Randomness is a keyed hash (md5 of seed:key), so every assignment is a pure
function of (seed, key) and identical under any partitioning. Sizes are exact:
test = ceil(fraction * n), strata get floor(fraction * n_s) plus the remainder by
largest fractional part (ties by stratum number).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import sort_hash
from ..functions.quantiles import exact_quantiles, hashed_row_number, qcut_column

QUARTILES = [0.0, 0.25, 0.5, 0.75, 1.0]


def quantile_edges(df: DataFrame, col: str, q: int = 4) -> list[float]:
    return exact_quantiles(df, col, [i / q for i in range(q + 1)])


def label_strata(df: DataFrame, label_col: str = "risk_score", q: int = 4, out_col: str = "stratum") -> DataFrame:
    """qcut(label, q, duplicates='drop') codes (0-based)."""
    edges = quantile_edges(df, label_col, q)  # q + 1 numbers on the driver
    return df.withColumn(out_col, qcut_column(F.col(label_col), edges))


def _allocation(sizes: DataFrame, group_col: str, fraction: float) -> DataFrame:
    """Largest-remainder allocation over the (small) per-stratum size table."""
    n_total = F.sum("n_s").over(Window.partitionBy())
    s = sizes.select(
        group_col, "n_s",
        F.floor(F.lit(fraction) * F.col("n_s")).cast("long").alias("base"),
        (F.lit(fraction) * F.col("n_s") - F.floor(F.lit(fraction) * F.col("n_s"))).alias("frac"),
        F.ceil(F.lit(fraction) * n_total).cast("long").alias("n_test"),
    )
    s = s.withColumn("rem", F.col("n_test") - F.sum("base").over(Window.partitionBy()))
    order = Window.partitionBy().orderBy(F.col("frac").desc(), F.col(group_col).asc())
    return s.select(
        group_col, "n_s",
        (F.col("base") + F.when(F.row_number().over(order) <= F.col("rem"), 1).otherwise(0)).alias("n_alloc"),
    )


def stratified_split(df: DataFrame, key: str = "asset_id", label_col: str = "risk_score", fraction: float = 0.2,
                     seed: int = 42, q: int = 4) -> DataFrame:
    """Adds `stratum` and `split` ('test' / 'train')."""
    st = label_strata(df, label_col, q).withColumn("_h", sort_hash(F.col(key), seed))
    st = st.withColumn("_g", F.coalesce(F.col("stratum"), F.lit(-1)))
    sizes = st.groupBy("_g").agg(F.count(F.lit(1)).alias("n_s"))
    alloc = _allocation(sizes, "_g", fraction)  # one row per stratum (<= q + 1 rows)
    numbered = hashed_row_number(st, ["_g"], "_h")
    return (
        numbered.join(F.broadcast(alloc.select("_g", "n_alloc")), "_g", "inner")
        .withColumn("split", F.when(F.col("rn") <= F.col("n_alloc"), F.lit("test")).otherwise(F.lit("train")))
        .drop("_g", "_h", "rn", "n_alloc")
    )


def shuffled_split(df: DataFrame, key: str = "asset_id", fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Plain seeded split with n_test = ceil(fraction * n)."""
    d = df.withColumn("_h", sort_hash(F.col(key), seed))
    numbered = hashed_row_number(d, [], "_h", count_col="_n")
    return numbered.withColumn(
        "split",
        F.when(F.col("rn") <= F.ceil(F.lit(fraction) * F.col("_n")), F.lit("test")).otherwise(F.lit("train")),
    ).drop("_h", "rn", "_n")


def kfold(df: DataFrame, key: str = "asset_id", k: int = 5, seed: int = 42, out_col: str = "fold") -> DataFrame:
    """Shuffled K-fold (0-based fold ids); the first n % k folds get one extra row."""
    d = df.withColumn("_h", sort_hash(F.col(key), seed))
    numbered = hashed_row_number(d, [], "_h", count_col="_n")
    n, rn = F.col("_n"), F.col("rn")
    q, r = F.floor(n / k), n % k
    big = r * (q + 1)
    fold = F.when(rn <= big, F.floor((rn - 1) / (q + 1))).otherwise(r + F.floor((rn - 1 - big) / q))
    return numbered.withColumn(out_col, fold.cast("int")).drop("_h", "rn", "_n")
