"""The model queries' own results: real columns in their order, within the targets at sf0.01."""
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from latticeguard.config import Thresholds
from latticeguard.functions.exprs import priority_bucket
from latticeguard.plans import queries as q
from latticeguard.schemas import FEATURE_NAMES

SF = "/root/testdata/sf0.01"


def rows(spark, name):
    return [r.asDict() for r in entry.queries()[name](spark, SF).collect()]


def test_importances_come_with_numbers_highest_first(spark):
    got = [(-r["importance"], r["feature"]) for r in rows(spark, "feature_importance_values")]
    assert got == sorted(got) and {f for _, f in got} == set(FEATURE_NAMES)
    assert -sum(i for i, _ in got) == pytest.approx(1.0) and got[0][0] < got[-1][0]


def test_scores_and_priorities_of_assets(spark):
    table = entry.queries()["batch_scores_values"](spark, SF).withColumn("bucket", priority_bucket(F.col("risk_score"), Thresholds()))
    got = [r.asDict() for r in table.collect()]
    errors = {r["asset_id"]: r["encode_error"] for r in rows(spark, "batch_scores")}
    assert {r["asset_id"]: r["encode_error"] for r in got} == errors and len(got) == len(errors)
    scored = [r for r in got if r["encode_error"] is None]
    assert len({r["risk_score"] for r in scored}) > 10
    assert all(0 <= r["risk_score"] <= 1 and r["priority"] == r["bucket"] for r in scored)
    assert all(r["risk_score"] is None and r["priority"] is None for r in got if r["encode_error"] is not None)


def test_metrics_follow_from_the_test_table(spark):
    table = rows(spark, "test_predictions_values")
    (m,) = rows(spark, "model_quality_values")
    miss = [r["risk_score"] - r["predicted_score"] for r in table]
    assert m["n"] == len(table) and m["mae"] == pytest.approx(sum(map(abs, miss)) / len(miss))
    assert m["rmse"] == pytest.approx((sum(x * x for x in miss) / len(miss)) ** 0.5)
    match = sum(r["actual_priority"] == r["predicted_priority"] for r in table) / len(table)
    assert m["bucket_match_rate"] == pytest.approx(match) and match >= 0.75
    assert m["mae"] * 2 <= m["baseline_mae"] and m["model_worse_than_baseline"] is False


def test_agreement_has_a_rate_and_it_is_high(spark):
    (e,) = rows(spark, "expert_evaluation_values")
    got = rows(spark, "agreement_rate_values")
    judged, agreed = sum(r["n_judged"] for r in got), sum(r["n_agree"] for r in got)
    assert (judged, e["n_in_train"]) == (e["n"], 0) and agreed / judged == pytest.approx(e["bucket_match_rate"])
    assert agreed / judged >= 0.75 and 0 < e["mae"] <= e["rmse"]
    assert all(r["agreement_rate"] == pytest.approx(r["n_agree"] / r["n_judged"]) for r in got)


def test_cv_results_have_mean_and_std_best_first(spark, monkeypatch):
    made = [(0, 40, 2, 0.1, 0.3, 0.02), (1, 80, 2, 0.1, 0.1, 0.03), (2, 80, 3, 0.1, 0.2, 0.01), (3, 80, 3, 0.05, 0.1, 0.04)]
    table = spark.createDataFrame(made, "grid_index int, n_estimators int, max_depth int, learning_rate double, "
                                  "cv_mae_mean double, cv_mae_std double")
    monkeypatch.setattr(q, "inventory", lambda *_: SimpleNamespace(trained=SimpleNamespace(cv_results=table, best=(80, 2, 0.1))))
    got = [tuple(r) for r in entry.queries()["cv_results_values"](spark, SF).collect()]
    assert got == [(*made[i], i == 1) for i in (1, 3, 2, 0)]
