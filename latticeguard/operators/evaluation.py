"""Evaluation: regression metrics, buckets, confusion, macro F1, calibration,
threshold sweep, ROC-AUC, error sets (A1-A14, A19, P10, P11, M11).

Inputs are a DataFrame with a label column `y` and a prediction column `p`.
All scalar metrics are computed in one aggregate pass; nothing is collected
except bounded summaries (quantile edges, the 16-cell confusion matrix).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions.exprs import priority_bucket, priority_rank
from ..functions.quantiles import exact_quantiles, qcut_column


def with_buckets(df: DataFrame, y: str = "risk_score", p: str = "predicted_score",
                 thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Test prediction table with actual/predicted priority and rank."""
    return (
        df.withColumn("actual_priority", priority_bucket(F.col(y), thresholds))
        .withColumn("predicted_priority", priority_bucket(F.col(p), thresholds))
        .withColumn("actual_rank", priority_rank(F.col("actual_priority"), thresholds))
        .withColumn("predicted_rank", priority_rank(F.col("predicted_priority"), thresholds))
    )


def regression_metrics(df: DataFrame, y: str = "risk_score", p: str = "predicted_score") -> DataFrame:
    """A1-A4 in one pass. R2 on constant y: 1.0 if SSE = 0 else 0.0; Pearson on constant input: NULL."""
    Y, P = F.col(y).cast("double"), F.col(p).cast("double")
    a = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(Y - P)).alias("mae"),
        F.avg((Y - P) * (Y - P)).alias("mse"),
        F.sum((Y - P) * (Y - P)).alias("sse"),
        (F.var_pop(Y) * F.count(F.lit(1))).alias("sst"),
        F.covar_pop(Y, P).alias("cov"),
        F.stddev_pop(Y).alias("sy"),
        F.stddev_pop(P).alias("sp"),
    )
    return a.select(
        "n", "mae",
        F.sqrt("mse").alias("rmse"),
        F.when(F.col("sst") > 0, F.lit(1.0) - F.col("sse") / F.col("sst"))
        .when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("r2"),
        F.when((F.col("sy") > 0) & (F.col("sp") > 0), F.col("cov") / (F.col("sy") * F.col("sp"))).alias("pearson_r"),
    )


def baseline_mae(test: DataFrame, fit_on: DataFrame, y: str = "risk_score") -> DataFrame:
    """MAE on `test` of always predicting the mean of `fit_on` (a scalar, joined as a literal)."""
    mean = fit_on.agg(F.avg(F.col(y).cast("double")).alias("m")).first()["m"]
    return test.agg(F.avg(F.abs(F.col(y) - F.lit(mean))).alias("baseline_mae"))


def label_stats(df: DataFrame, y: str = "risk_score") -> DataFrame:
    """Count, mean and sample std of the label, rounded half-to-even to 4 places."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.bround(F.avg(y), 4).alias("label_mean"),
        F.bround(F.stddev_samp(y), 4).alias("label_std"),
    )


def confusion_matrix(df: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Dense |P| x |P| matrix in priority order, zero cells included (16-row spine, broadcast)."""
    spark = df.sparkSession
    pr = thresholds.priorities
    spine = spark.createDataFrame(
        [(a, i, b, j) for i, a in enumerate(pr) for j, b in enumerate(pr)],
        "actual_priority string, actual_rank int, predicted_priority string, predicted_rank int",
    )
    counts = df.groupBy("actual_priority", "predicted_priority").agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, ["actual_priority", "predicted_priority"], "left").select(
        "actual_priority", "predicted_priority", "actual_rank", "predicted_rank",
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
    )


def per_label_f1(confusion: DataFrame) -> DataFrame:
    """Per-label precision/recall/F1 with zero_division = 0, from the (small) confusion table."""
    tp = F.sum(F.when(F.col("actual_priority") == F.col("predicted_priority"), F.col("n")).otherwise(0))
    by_actual = confusion.groupBy(F.col("actual_priority").alias("priority")).agg(
        F.sum("n").alias("support"), tp.alias("tp"))
    by_pred = confusion.groupBy(F.col("predicted_priority").alias("priority")).agg(F.sum("n").alias("predicted"))
    j = by_actual.join(by_pred, "priority")
    return j.select(
        "priority", "support", "tp", "predicted",
        F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0).alias("precision"),
        F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0).alias("recall"),
        F.when(F.col("support") + F.col("predicted") > 0,
               2.0 * F.col("tp") / (F.col("support") + F.col("predicted"))).otherwise(0.0).alias("f1"),
    )


def macro_f1(confusion: DataFrame) -> DataFrame:
    """A10: mean F1 over all labels of the threshold table."""
    return per_label_f1(confusion).agg(F.avg("f1").alias("bucket_macro_f1"))


def error_counts(df: DataFrame) -> DataFrame:
    """under/over-scored counts, under pct (half-even, 2 places), exact-match rate."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("actual_rank") < F.col("predicted_rank")).alias("under_scored_count"),
        F.count_if(F.col("actual_rank") > F.col("predicted_rank")).alias("over_scored_count"),
    ).select(
        "rows", "under_scored_count", "over_scored_count",
        F.bround(F.col("under_scored_count") / F.col("rows") * 100.0, 2).alias("under_scored_pct"),
    )


def bucket_match_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.avg((F.col("actual_priority") == F.col("predicted_priority")).cast("double"))
                  .alias("bucket_match_rate"))


def under_scored(df: DataFrame) -> DataFrame:
    """P10: the dangerous miss (model said less urgent than reality)."""
    return df.where(F.col("actual_rank") < F.col("predicted_rank"))


def over_scored(df: DataFrame) -> DataFrame:
    """P11."""
    return df.where(F.col("actual_rank") > F.col("predicted_rank"))


DECILES = [i / 10 for i in range(11)]


def calibration_deciles(df: DataFrame, y: str = "risk_score", p: str = "predicted_score") -> DataFrame:
    """qcut(pred, 10, duplicates='drop'); mean predicted / actual per non-empty bin."""
    edges = exact_quantiles(df, p, DECILES)  # 11 numbers
    return (
        df.withColumn("bin", qcut_column(F.col(p), edges))
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.avg(p).alias("mean_predicted"), F.avg(y).alias("mean_actual"), F.count(F.lit(1)).alias("n"))
    )


def threshold_sweep(df: DataFrame, y: str = "risk_score", p: str = "predicted_score",
                    thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Precision / recall / F1 / Brier of 'score >= cut-off' for every positive cut-off.

    One aggregate pass with one set of conditional sums per cut-off (cut-offs are
    literals), then unpivoted; no join of rows to cut-offs.
    """
    cuts = [m for _, m in thresholds.buckets if m > 0]
    aggs = []
    for i, c in enumerate(cuts):
        act, pred = F.col(y) >= F.lit(c), F.col(p) >= F.lit(c)
        aggs += [
            F.count_if(act & pred).alias(f"tp{i}"),
            F.count_if(~act & pred).alias(f"fp{i}"),
            F.count_if(act & ~pred).alias(f"fn{i}"),
            F.avg((F.col(p) - act.cast("double")) * (F.col(p) - act.cast("double"))).alias(f"br{i}"),
        ]
    wide = df.agg(*aggs)
    stack = ", ".join(f"{float(c)}D, tp{i}, fp{i}, fn{i}, br{i}" for i, c in enumerate(cuts))
    long = wide.selectExpr(f"stack({len(cuts)}, {stack}) AS (cutoff, tp, fp, fn, brier)")
    return long.select(
        "cutoff", "tp", "fp", "fn",
        F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0).alias("precision"),
        F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0).alias("recall"),
        F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0,
               2.0 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(0.0).alias("f1"),
        "brier",
    )


def roc_auc(df: DataFrame, y: str = "risk_score", p: str = "predicted_score",
            thresholds: Thresholds = Thresholds()) -> DataFrame:
    """ROC-AUC of the score for each binary event 'label >= cut-off' (ties count half; NULL with one class).

    One ranking of the scores (average ranks, no one-task window) serves every cut-off: with R
    the sum of the positives' ranks from the top, R - pos (pos + 1) / 2 pairs are the wrong way
    round. One aggregate holds the sums of all cut-offs.
    """
    from .planner import average_rank_desc

    cuts = [m for _, m in thresholds.buckets if m > 0]
    ranked = average_rank_desc(df.where(F.col(p).isNotNull()), y, p)
    hit = lambda c: F.col(y).cast("double") >= F.lit(float(c))
    sums = [a for i, c in enumerate(cuts) for a in (
        F.count_if(hit(c)).alias(f"pos{i}"), F.count_if(~hit(c)).alias(f"neg{i}"),
        F.sum(F.when(hit(c), F.col("avg_rank"))).alias(f"r{i}"))]
    stack = ", ".join(f"{float(c)}D, pos{i}, neg{i}, r{i}" for i, c in enumerate(cuts))
    rows = ranked.agg(*sums).selectExpr(f"stack({len(cuts)}, {stack}) AS (cutoff, n_pos, n_neg, r)")
    pos, neg = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    auc = F.when((pos > 0) & (neg > 0), F.lit(1.0) - (F.col("r") - pos * (pos + 1) / 2) / F.nullif(pos * neg, F.lit(0.0)))
    return rows.select("cutoff", auc.alias("auc"), "n_pos", "n_neg")


# --- expert-judged frame (M13, A20, M14) -------------------------------------------

def expert_frame(scored: DataFrame, expert: DataFrame, train: DataFrame, p: str = "predicted_score",
                 expert_col: str = "risk_score", thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Scored held-out rows joined to the expert score (evaluation only).

    `in_train` flags rows whose asset is also a training row; the expert set must be
    disjoint from training, so `expert_evaluation` reports the count (expected 0).
    """
    e = scored.select("asset_id", F.col(p).alias("predicted_score")).join(
        expert.select("asset_id", F.col(expert_col).alias("expert_score")), "asset_id")
    t = train.select("asset_id", F.lit(1).alias("in_train"))
    e = e.join(t, "asset_id", "left").withColumn("in_train", F.coalesce(F.col("in_train"), F.lit(0)))
    return (e.withColumn("expert_priority", priority_bucket(F.col("expert_score"), thresholds))
            .withColumn("predicted_priority", priority_bucket(F.col("predicted_score"), thresholds)))


def expert_evaluation(frame: DataFrame) -> DataFrame:
    """MAE / RMSE / bucket exact-match of the system against the expert score, one pass."""
    Y, P = F.col("expert_score").cast("double"), F.col("predicted_score").cast("double")
    return frame.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("in_train").cast("long").alias("n_in_train"),
        F.avg(F.abs(Y - P)).alias("mae"),
        F.sqrt(F.avg((Y - P) * (Y - P))).alias("rmse"),
        F.avg((F.col("expert_priority") == F.col("predicted_priority")).cast("double")).alias("bucket_match_rate"),
    )


def agreement_rate(frame: DataFrame, category: str = "expert_priority",
                   system: str = "predicted_priority", expert: str = "expert_priority") -> DataFrame:
    """Share of judged items whose system answer agrees with the expert's, per category."""
    return frame.groupBy(F.col(category).alias("category")).agg(
        F.count(F.lit(1)).alias("n_judged"),
        F.count_if(F.col(system) == F.col(expert)).alias("n_agree"),
        F.avg((F.col(system) == F.col(expert)).cast("double")).alias("agreement_rate"),
    )
