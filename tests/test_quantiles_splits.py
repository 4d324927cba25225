"""Exact quantiles, bucketed row numbers, strata and splits: against brute force and invariance."""
import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from latticeguard.functions.exprs import sort_hash
from latticeguard.functions.quantiles import exact_quantiles, hashed_row_number, order_statistics, qcut_column
from latticeguard.operators.planner import bucketed_row_number
from latticeguard.operators.splits import kfold, shuffled_split, stratified_split


def _lin(vals, p):
    v = sorted(vals)
    h = (len(v) - 1) * p
    lo, hi = int(np.floor(h)), int(np.ceil(h))
    return v[lo] + (v[hi] - v[lo]) * (h - lo)


@pytest.mark.parametrize("kind", ["continuous", "ties", "hot", "zero_heavy"])
def test_exact_quantiles_match_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    n = 20000
    if kind == "continuous":
        vals = rng.normal(size=n)
    elif kind == "ties":
        vals = rng.integers(0, 7, size=n).astype(float)
    elif kind == "hot":  # a third of the rows hold one value
        vals = np.where(rng.random(n) < 0.34, 0.5, rng.random(n))
    else:
        vals = np.where(rng.random(n) < 0.6, 0.0, rng.random(n))
    df = spark.createDataFrame([(float(x),) for x in vals], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, "v", probs)
    want = [_lin(vals, p) for p in probs]
    assert got == pytest.approx(want, abs=1e-12)


def test_order_statistics_small_windows(spark):
    vals = [float(x) for x in [5, 1, 4, 1, 3, 9, 2, 6]]
    df = spark.createDataFrame([(x,) for x in vals], "v double")
    got = order_statistics(df, "v", list(range(len(vals))), bins=4, small=2)
    assert [got[i] for i in range(len(vals))] == sorted(vals)


def test_qcut_constant_column_gives_no_bin(spark):
    df = spark.createDataFrame([(1.0,)] * 10, "v double")
    edges = exact_quantiles(df, "v", [0, 0.25, 0.5, 0.75, 1])
    assert df.select(qcut_column(F.col("v"), edges).alias("b")).distinct().collect()[0]["b"] is None


def test_hashed_row_number_equals_window(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("g"))
    df = df.withColumn("h", sort_hash(F.col("id"), 9))
    got = hashed_row_number(df, ["g"], "h").select("id", "rn")
    want = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy("h")).alias("rn"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_bucketed_row_number_equals_window(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 2).alias("p"), ((F.col("id") * 37) % 101).alias("s"))
    df = df.withColumn("_b", F.floor(F.col("s") / 10))
    got = bucketed_row_number(df, ["p"], "_b", [F.col("s").asc(), F.col("id").asc()]).select("id", "rn")
    want = df.select("id", F.row_number().over(Window.partitionBy("p").orderBy("s", "id")).alias("rn"))
    assert got.exceptAll(want).count() == 0


def _labelled(spark, n=1000):
    return spark.range(n).select(F.col("id").alias("asset_id"),
                                 ((F.col("id") * 7919) % 1000 / 1000.0).alias("risk_score"))


def test_split_sizes_and_partition_invariance(spark):
    df = _labelled(spark)
    a = stratified_split(df.coalesce(1))
    b = stratified_split(df.repartition(16))
    assert a.where("split = 'test'").count() == 200
    assert sorted(a.select("asset_id", "split").collect()) == sorted(b.select("asset_id", "split").collect())
    per = {r["stratum"]: r["n"] for r in a.where("split='test'").groupBy("stratum").agg(F.count("*").alias("n")).collect()}
    assert per == {0: 50, 1: 50, 2: 50, 3: 50}
    s = shuffled_split(df)
    assert s.where("split = 'test'").count() == 200


def test_kfold_sizes(spark):
    f = kfold(_labelled(spark, 1003), k=5)
    sizes = sorted(r["n"] for r in f.groupBy("fold").agg(F.count("*").alias("n")).collect())
    assert sizes == [200, 200, 201, 201, 201]
