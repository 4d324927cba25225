"""Concurrent CV gives CrossValidator's numbers (fold column, MAE, population std)."""
import numpy as np


def test_cv_matches_crossvalidator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.tuning import CrossValidator
    from pyspark.sql import functions as F

    from latticeguard.operators import training as trn
    from latticeguard.operators.splits import kfold
    from latticeguard.plans.inventory import Inventory
    from latticeguard.schemas import FEATURE_NAMES

    inv = Inventory(spark, "/root/testdata/sf0.001", persist=False)
    train = trn.training_frame(inv.train)
    grid = ((4, 2, 0.1), (6, 3, 0.05))
    got = trn.cross_validate(train, grid=grid, folds=3).cv_results.orderBy("grid_index").collect()

    data = kfold(train, k=3, seed=42).withColumn("fold", F.col("fold").cast("int"))
    data = trn._sized(VectorAssembler(inputCols=FEATURE_NAMES, outputCol="features").transform(data)
                      .select("features", "risk_score", "fold"))
    gbt = trn._gbt(42)
    cv = CrossValidator(estimator=gbt, estimatorParamMaps=[{gbt.maxIter: n, gbt.maxDepth: d, gbt.stepSize: lr}
                                                           for n, d, lr in grid],
                        evaluator=RegressionEvaluator(labelCol="risk_score", predictionCol="raw_prediction",
                                                      metricName="mae"),
                        foldCol="fold", numFolds=3, seed=42).fit(data)
    assert np.allclose([r["cv_mae_mean"] for r in got], cv.avgMetrics, atol=1e-12)
    assert np.allclose([r["cv_mae_std"] for r in got], cv.stdMetrics, atol=1e-12)


def test_configs_that_differ_in_trees_only_share_a_fit(spark, monkeypatch):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    from pyspark.sql import functions as F

    from latticeguard.operators import training as trn
    from latticeguard.operators.splits import kfold
    from latticeguard.schemas import FEATURE_NAMES

    rows = [(i, *((i * (2 * j + 3)) % (5 + j) * 1.0 for j in range(len(FEATURE_NAMES))), (i * 37 % 101) / 101 + 0.1 * (i % 5))
            for i in range(400)]
    train = spark.createDataFrame(rows, ["asset_id", *FEATURE_NAMES, "risk_score"])
    grid = ((5, 2, 0.1), (3, 2, 0.1), (4, 3, 0.05))
    fits, plain = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, df: (fits.append(self.getMaxIter()), plain(self, df))[1])
    got = trn.cross_validate(train, grid=grid, folds=3)
    # two fits a fold; the last fit is the chosen configuration's, inside a Pipeline
    assert sorted(fits[:6]) == [4, 4, 4, 5, 5, 5] and len(fits) == 7

    data = trn._sized(VectorAssembler(inputCols=FEATURE_NAMES, outputCol="features").transform(kfold(train, k=3, seed=42))
                      .select("features", "risk_score", "fold")).cache()
    mae = RegressionEvaluator(labelCol="risk_score", predictionCol="raw_prediction", metricName="mae")
    for r, (n, d, lr) in zip(got.cv_results.orderBy("grid_index").collect(), grid, strict=True):
        each = [mae.evaluate(trn._gbt(42).setMaxIter(n).setMaxDepth(d).setStepSize(lr).fit(data.where(F.col("fold") != f))
                             .transform(data.where(F.col("fold") == f))) for f in range(3)]
        assert np.allclose([r["cv_mae_mean"], r["cv_mae_std"]], [np.mean(each), np.std(each)], atol=1e-12)


def test_a_fit_has_a_partition_for_every_core_if_it_has_the_rows(spark):
    from latticeguard.operators.training import _sized

    cores = spark.sparkContext.defaultParallelism
    assert _sized(spark.range(0, 24_999, 1, 6)).rdd.getNumPartitions() == 1
    assert _sized(spark.range(0, 100_000, 1, 1)).rdd.getNumPartitions() == min(cores, 4)  # before: 1
    assert _sized(spark.range(0, 100_000, 1, 1), rows_per_partition=10_000).rdd.getNumPartitions() == 10


def test_only_as_many_fits_run_at_once_as_memory_holds(spark, monkeypatch):
    import threading

    from pyspark.ml.regression import GBTRegressor

    from latticeguard.operators import training as trn
    from latticeguard.schemas import FEATURE_NAMES

    rows = [(i, *((i * (2 * j + 3)) % (5 + j) * 1.0 for j in range(len(FEATURE_NAMES))), (i * 37 % 101) / 101) for i in range(200)]
    train = spark.createDataFrame(rows, ["asset_id", *FEATURE_NAMES, "risk_score"])
    lock, plain, now, most = threading.Lock(), GBTRegressor.fit, [0], [0]

    def counted(self, df):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        try:
            return plain(self, df)
        finally:
            with lock:
                now[0] -= 1

    monkeypatch.setattr(GBTRegressor, "fit", counted)
    grid = ((2, 2, 0.1), (2, 2, 0.2))
    free = trn.cross_validate(train, grid=grid, folds=3)
    assert most[0] > 1
    most[0] = 0
    monkeypatch.setattr(trn, "_storage_bytes", lambda _: 1, raising=False)
    bounded = trn.cross_validate(train, grid=grid, folds=3)
    assert most[0] == 1  # before: all six
    assert bounded.cv_results.collect() == free.cv_results.collect() and bounded.best == free.best


def test_fits_share_the_cores_and_the_memory(spark):
    from latticeguard.operators import training as trn

    assert trn._storage_bytes(spark) > 1e8
    assert trn._fits_at_once(spark, 1_000, 5, 20) == 20 and trn._fits_at_once(spark, 10**12, 5, 20) == 1
    assert trn._sized(spark.range(0, 100_000, 1, 6), spread=2).rdd.getNumPartitions() == 2
