"""Model train / tune / score with Spark ML.

The learner is Spark's distributed GBTRegressor; the 4-configuration grid is
cross-validated over the keyed fold column (W4), so fold membership does not
depend on partitioning. Configurations that differ in their number of trees only share one fit per
fold, as the first n trees of a longer fit are the fit with n trees; the fits run as concurrent jobs. Scoring is `transform` plus the
NaN/NULL-safe clip and the threshold bucket: no Python on the row path.
"""
from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PARAM_GRID, Thresholds
from ..functions.exprs import clip01, priority_bucket
from ..schemas import FEATURE_NAMES, SCHEMA_VERSION
from .features import encode_features, impute, require_rows


@dataclass(frozen=True)
class TrainResult:
    model: PipelineModel
    cv_results: DataFrame
    best: tuple[int, int, float]


def _gbt(seed: int) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol="risk_score", predictionCol="raw_prediction", seed=seed)


def training_frame(labelled: DataFrame, key: str = "asset_id", medians: dict[str, float] | None = None) -> DataFrame:
    """Lenient encode (training mode) + label. Missing numbers take the training median (P16); any other
    row that can't be encoded is an error: no row ever leaves training silently."""
    require_rows(labelled, "training data")
    enc = encode_features(impute(labelled, medians or {}), "lenient", keep=(key, "risk_score"))
    bad = enc.where(F.col("encode_error").isNotNull()).groupBy("encode_error").count().orderBy(F.desc("count")).take(5)
    if bad:
        raise ValueError("training rows can't be encoded: " + "; ".join(f"{r['encode_error']} ({r['count']} rows)" for r in bad))
    return enc.drop("encode_error")


def _sized(df: DataFrame, rows_per_partition: int = 200_000, least: int = 25_000, rows: int | None = None,
           spread: int | None = None) -> DataFrame:
    """Partition count proportional to the data: tree learners run one job per level,
    so tiny inputs spread over many partitions only add task overhead. Larger ones get
    a partition for every core (or `spread` of them), as long as that leaves `least` rows to each."""
    n = df.count() if rows is None else rows
    cores = spread or df.sparkSession.sparkContext.defaultParallelism
    target = max(1, -(-n // rows_per_partition), min(cores, n // least))
    current = df.rdd.getNumPartitions()
    return df.coalesce(target) if target < current else df.repartition(target)


#: Bytes of a row in a fit's caches (its binned point, two or three predictions with errors, a residual) and in the shared table.
FIT_ROW, SHARED_ROW = 300, 200


def _storage_bytes(spark: SparkSession) -> int:
    """Memory that the executors have for cached blocks; the driver's counts only if there is no other."""
    sc = spark.sparkContext._jsc.sc()
    own = sc.env().blockManager().blockManagerId()
    held, each = {}, sc.getExecutorMemoryStatus().iterator()
    while each.hasNext():
        entry = each.next()
        held[entry._1()] = entry._2()._1()
    others = [b for name, b in held.items() if name != f"{own.host()}:{own.port()}"]
    return sum(others or held.values())


def _fits_at_once(spark: SparkSession, rows: int, folds: int, most: int) -> int:
    """As many concurrent fits as the executors hold in memory, at least one: a fit reads its caches once per level
    of each tree, so blocks that don't fit would be written, dropped and read again thousands of times."""
    free = 0.8 * _storage_bytes(spark) - SHARED_ROW * rows
    return int(max(1, min(most, free // max(1, FIT_ROW * rows * (folds - 1) // folds))))


def cross_validate(train: DataFrame, seed: int = 42, folds: int = 5, grid=PARAM_GRID,
                   parallelism: int = 20) -> TrainResult:
    """M2-M4: CV over the explicit 4-config list; best = min mean MAE (ties by grid order).

    Same result as CrossValidator with a fold column (train on fold != f, MAE on
    fold == f; mean and population std over folds), but fits are submitted from driver
    threads, so the cluster runs up to `parallelism` of them at once (a boosted-tree fit
    is a chain of small jobs), and a fold's configurations of one depth and rate are read
    off one fit with the most trees, in one pass over the fold. Each fit caches its own
    copy of the training set, so only as many run at once as the executors' memory holds;
    a fit has its share of the cores in partitions, since tasks of the others fill the rest.
    """
    from concurrent.futures import ThreadPoolExecutor

    import numpy as np

    from .splits import kfold

    spark = train.sparkSession
    chains: dict[tuple[int, float], list[int]] = {}
    for gi, (_, d, lr) in enumerate(grid):
        chains.setdefault((d, lr), []).append(gi)
    n = train.count()
    at_once = _fits_at_once(spark, n, folds, min(parallelism, folds * len(chains)))
    data = kfold(train, k=folds, seed=seed).withColumn("fold", F.col("fold").cast("int"))
    assembler = VectorAssembler(inputCols=FEATURE_NAMES, outputCol="features")
    data = _sized(assembler.transform(data).select("features", "risk_score", "fold"), rows_per_partition=500_000, rows=n,
                  spread=-(-2 * spark.sparkContext.defaultParallelism // at_once)).cache()

    def run(job: tuple[int, tuple[int, float]]) -> tuple[int, dict[int, float]]:
        f, (d, lr) = job
        members = chains[d, lr]
        most = max(grid[gi][0] for gi in members)
        model = _gbt(seed).setMaxIter(most).setMaxDepth(d).setStepSize(lr).fit(data.where(F.col("fold") != f))
        errors = model.evaluateEachIteration(data.where(F.col("fold") == f), "absolute")  # after 1, 2, ... trees
        return f, {gi: float(errors[grid[gi][0] - 1]) for gi in members}

    # the longest fits first, so that none of them is left to run alone
    jobs = sorted(((f, c) for f in range(folds) for c in chains),
                  key=lambda job: -max(grid[gi][0] for gi in chains[job[1]]) * job[1][0])
    metrics = np.zeros((folds, len(grid)))
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        for f, found in pool.map(run, jobs):
            for gi, m in found.items():
                metrics[f, gi] = m
    data.unpersist()
    means, stds = metrics.mean(axis=0), metrics.std(axis=0)
    rows = [
        (i, n, d, float(lr), float(m), float(sd))
        for i, ((n, d, lr), m, sd) in enumerate(zip(grid, means, stds))
    ]
    schema = "grid_index int, n_estimators int, max_depth int, learning_rate double, cv_mae_mean double, cv_mae_std double"
    res = spark.createDataFrame(rows, schema)
    best_row = min(rows, key=lambda r: (r[4], r[0]))
    best = (best_row[1], best_row[2], best_row[3])
    model = fit(_sized(train, rows=n), best, seed)
    return TrainResult(model=model, cv_results=res, best=best)


def fit(train: DataFrame, params: tuple[int, int, float], seed: int = 42, scaled: bool = False) -> PipelineModel:
    """M1: final fit on the full training set. P17: `scaled` puts a fitted scaler, saved with the pipeline,
    before the learner (off by default, as trees don't need it)."""
    n, d, lr = params
    gbt = _gbt(seed).setMaxIter(n).setMaxDepth(d).setStepSize(lr)
    scale = [StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)] if scaled else []
    vector = VectorAssembler(inputCols=FEATURE_NAMES, outputCol="raw_features" if scaled else "features")
    return Pipeline(stages=[vector, *scale, gbt]).fit(train)


def feature_importance(model: PipelineModel) -> list[tuple[str, float]]:
    """M5/K2: importances by name, descending (ties by name); 16 numbers."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return sorted(zip(FEATURE_NAMES, [float(x) for x in imp]), key=lambda t: (-t[1], t[0]))


def score(model: PipelineModel, encoded: DataFrame, key: str = "asset_id",
          thresholds: Thresholds = Thresholds()) -> DataFrame:
    """M7: predict -> clip -> bucket; returns (key, risk_score, priority) keyed, not positional."""
    pred = model.transform(encoded)
    s = clip01(F.col("raw_prediction").cast("double"))
    return pred.select(key, s.alias("risk_score")).withColumn("priority", priority_bucket(F.col("risk_score"), thresholds))


def score_all(model: PipelineModel, encoded: DataFrame, key: str = "asset_id",
              thresholds: Thresholds = Thresholds()) -> DataFrame:
    """M7: every row of a strictly encoded batch: (key, risk_score, priority, encode_error); a row that
    can't be encoded keeps its error and has no score."""
    good = score(model, encoded.where(F.col("encode_error").isNull()).drop("encode_error"), key, thresholds)
    bad = encoded.where(F.col("encode_error").isNotNull()).select(
        key, F.lit(None).cast("double").alias("risk_score"), F.lit(None).cast("string").alias("priority"), "encode_error")
    return good.withColumn("encode_error", F.lit(None).cast("string")).unionByName(bad)


def with_provenance(scores: DataFrame, model_name: str, model_version: str, run_id: str,
                    scored_at: str) -> DataFrame:
    """M8: score write-back rows."""
    return scores.select(
        "asset_id", "risk_score", "priority",
        F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"),
        F.lit(run_id).alias("run_id"), F.lit(scored_at).cast("timestamp").alias("scored_at"),
    )


def manifest(thresholds: Thresholds = Thresholds()) -> dict:
    return {
        "n_features": len(FEATURE_NAMES),
        "feature_columns": FEATURE_NAMES,
        "schema_version": SCHEMA_VERSION,
        "thresholds": [{"priority": p, "min_score": m} for p, m in thresholds.buckets],
    }


def save(model: PipelineModel, path: str, spark: SparkSession, thresholds: Thresholds = Thresholds()) -> None:
    """M6: model + manifest (feature list, count, schema version, thresholds) side by side."""
    model.write().overwrite().save(f"{path}/model")
    doc = json.dumps(manifest(thresholds))
    spark.createDataFrame([(doc,)], "manifest string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def load(path: str, spark: SparkSession) -> tuple[PipelineModel, Thresholds]:
    """M9: load a saved model and check its manifest against this schema."""
    doc = json.loads(spark.read.text(f"{path}/manifest").first()[0])
    if doc["feature_columns"] != FEATURE_NAMES or doc["n_features"] != len(FEATURE_NAMES):
        raise ValueError("saved model's feature columns differ from the current schema")
    model = PipelineModel.load(f"{path}/model")
    th = Thresholds.from_mapping({"buckets": doc["thresholds"]})
    return model, th


def reload_equivalence(model: PipelineModel, path: str, encoded: DataFrame, key: str = "asset_id") -> DataFrame:
    """Predictions of the reloaded model equal the in-memory ones (max |diff| = 0)."""
    spark = encoded.sparkSession
    loaded, _ = load(path, spark)
    a = model.transform(encoded).select(key, F.col("raw_prediction").alias("a"))
    b = loaded.transform(encoded).select(key, F.col("raw_prediction").alias("b"))
    return a.join(b, key, "full").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.abs(F.col("a") - F.col("b"))).alias("max_abs_diff"),
        F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("unmatched"),
    )


IMPORTANCE_SCHEMA = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
