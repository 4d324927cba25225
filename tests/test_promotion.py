"""Promotion: comparison, gates and decisions on literal ledgers (the reference's cases and more)."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from latticeguard.config import Policy
from latticeguard.config import DEPLOYMENT
from latticeguard.functions.exprs import epoch_millis_to_ts
from latticeguard.operators import promotion as pm

NOW = dt.datetime(2026, 8, 21, 12, 0, 0)


def policy(floors=None, regressions=None, margin=0.0, max_age=30, interval=0, primary="neg_test_mae"):
    return Policy({"revision": "t", "environments": {"local": {
        "defaults": {"max_eval_age_days": max_age, "min_promotion_interval_hours": interval, "on_pass": "approve"},
        "deployments": {"dep": {"primary_metric": primary, "min_primary_margin": margin,
                                "floors": floors or {}, "max_regressions": regressions or {}}}}}})


def decide(spark, champion, candidate, pol, last_promoted=None, bootstrap=False):
    """champion/candidate: (dataset_id, evaluated_at, {metric: value}) or None."""
    runs, metrics, params, versions, aliases = [], [], [], [], []
    for alias, version, ev in (("champion", 1, champion), ("candidate", 2, candidate)):
        if ev is None:
            continue
        run = f"run-{alias}"
        ds, at, ms = ev
        runs.append((run, at))
        if ds is not None:
            params.append((run, "dataset_id", ds))
        metrics += [(run, k, float(v), at, 0) for k, v in ms.items()]
        versions.append(("m", version, run))
        aliases.append(("m", alias, version))
    S = spark.createDataFrame
    runs_df = S(runs, "run_id string, end_time timestamp")
    met_df = S(metrics, "run_id string, key string, value double, ts timestamp, step long")
    par_df = S(params, "run_id string, key string, value string")
    ver_df = S(versions, "model string, version int, run_id string")
    ali_df = S(aliases, "model string, alias string, version int")
    now = F.lit(NOW).cast("timestamp")
    resolved = pm.resolve_aliases(ali_df, ver_df).withColumn("deployment", F.lit("dep"))
    latest = pm.latest_metrics(met_df)
    pairs = pm.metric_pairs(resolved, latest)
    comp = pm.comparability(resolved, pm.evaluations(runs_df, par_df, now), pairs)
    lp = None
    if last_promoted is not None:
        lp = S([("local", "m", last_promoted)], "environment string, model string, promoted_at timestamp")
    ledger = pm.gate_ledger(comp, pairs, pol, now, lp)
    d = pm.decisions(comp, ledger, pol, bootstrap=bootstrap).first()
    return d, ledger.orderBy("gate_order", "metric").collect(), pairs


def ev(metrics, ds="ds-1", age_days=0):
    return (ds, NOW - dt.timedelta(days=age_days), metrics)


def test_missing_champion_parks(spark):
    d, ledger, _ = decide(spark, None, ev({"f1": 0.9}), policy())
    assert d["outcome"] == "park" and d["gate"] == "comparability"
    assert d["reason"] == "the champion has no evaluation record, so there is nothing to compare"


def test_missing_champion_bootstrap_approves(spark):
    d, _, _ = decide(spark, None, ev({"f1": 0.9}), policy(), bootstrap=True)
    assert d["outcome"] == "approve"


def test_dataset_mismatch_parks(spark):
    d, _, _ = decide(spark, ev({"f1": 0.9}, ds="ds-1"), ev({"f1": 0.9}, ds="ds-2"), policy(primary="f1"))
    assert d["outcome"] == "park" and "different datasets" in d["reason"]


def test_gap(spark):
    _, _, pairs = decide(spark, ev({"f1": 0.80}), ev({"f1": 0.85}), policy(primary="f1"))
    assert pairs.first()["gap"] == pytest.approx(0.05, abs=1e-9)


def test_floor_rejects(spark):
    d, _, _ = decide(spark, ev({"f1": 0.60}), ev({"f1": 0.50}), policy(floors={"f1": 0.55}, primary="f1", margin=-1))
    assert d["outcome"] == "reject" and d["gate"] == "absolute floor"
    assert d["reason"] == "f1 is 0.5000, must be above 0.5500 for this environment"


@pytest.mark.parametrize("allowed,outcome", [(0.02, "approve"), (0.005, "reject")])
def test_regression_small_vs_large(spark, allowed, outcome):
    d, _, _ = decide(spark, ev({"f1": 0.70}), ev({"f1": 0.69}), policy(regressions={"f1": allowed}, primary="f1",
                                                                        margin=-1))
    assert d["outcome"] == outcome
    if outcome == "reject":
        assert d["reason"] == "f1 is 0.0100 less than in the champion. it can lose at most 0.0050"


def test_too_old_parks(spark):
    d, _, _ = decide(spark, ev({"f1": 0.70}), ev({"f1": 0.71}, age_days=45), policy(primary="f1"))
    assert d["outcome"] == "park" and d["gate"] == "age"
    assert d["reason"].startswith("the candidate's evaluation is 45 days old; policy allows at most 30 days")


def test_approve_path(spark):
    d, ledger, _ = decide(spark, ev({"neg_test_mae": -0.10, "bucket_macro_f1": 0.60}),
                          ev({"neg_test_mae": -0.08, "bucket_macro_f1": 0.62}),
                          policy(floors={"bucket_macro_f1": 0.55}, regressions={"bucket_macro_f1": 0.02}))
    assert d["outcome"] == "approve" and ledger == []


def test_rate_limited(spark):
    d, _, _ = decide(spark, ev({"f1": 0.70}), ev({"f1": 0.71}), policy(primary="f1", interval=1),
                     last_promoted=NOW - dt.timedelta(minutes=30))
    assert d["outcome"] == "park" and d["gate"] == "environment gating"
    assert d["reason"] == "local last promoted a model too recently; policy requires waiting until 2026-08-21 12:30:00 UTC"


def test_one_sided_metric_parks_champion_side_first(spark):
    d, _, _ = decide(spark, ev({"a": 1.0, "z": 1.0}), ev({"b": 1.0, "z": 1.0}), policy(primary="z"))
    assert d["outcome"] == "park"
    assert d["reason"] == "metric `a` is included in the champion but not the other side"


def test_no_metrics_parks(spark):
    d, _, _ = decide(spark, ev({}), ev({}), policy(primary="f1"))
    assert d["reason"] == "neither side has any metrics"


def test_metric_not_evaluated(spark):
    d, _, _ = decide(spark, ev({"f1": 0.7}), ev({"f1": 0.8}), policy(floors={"recall": 0.5}, primary="f1"))
    assert d["outcome"] == "reject" and d["gate"] == "absolute floor"
    assert d["reason"] == "metric `recall` is referenced by policy but is not in the comparison"


def test_nan_regression_passes_and_first_failure_wins(spark):
    d, ledger, _ = decide(spark, ev({"f1": 0.7, "g": float("nan")}), ev({"f1": 0.5, "g": 0.1}),
                          policy(floors={"f1": 0.6}, regressions={"g": 0.01}, primary="f1", margin=0.1))
    gates = [r["gate"] for r in ledger]
    assert "regression" not in gates  # NaN loss compares false, as in IEEE
    assert gates == ["absolute floor", "relative improvement"]
    assert d["gate"] == "absolute floor" and d["n_failures"] == 2


def test_unknown_datasets_compare_equal(spark):
    d, _, _ = decide(spark, ev({"f1": 0.7}, ds=None), ev({"f1": 0.8}, ds=None), policy(primary="f1"))
    assert d["outcome"] == "approve"


def test_policy_parse_and_unknowns():
    p = Policy()
    r = p.rules("minikube", DEPLOYMENT)
    assert (r.max_eval_age_days, r.min_promotion_interval_hours, r.min_primary_margin) == (14, 1, 0.005)
    assert dict(r.floors) == {"bucket_macro_f1": 0.60}
    with pytest.raises(ValueError, match="unknown environment 'prod'"):
        p.rules("prod", DEPLOYMENT)
    with pytest.raises(ValueError, match="unknown deployment of environment local 'other'"):
        p.rules("local", "other")
    bad = {"revision": "x", "environments": {}, "extra": 1}
    with pytest.raises(ValueError, match="unknown field"):
        Policy(bad)


def test_epoch_millis(spark):
    df = spark.createDataFrame([("1787313000000",), ("not-a-number",)], "x string")
    out = [r[0] for r in df.select(epoch_millis_to_ts(F.col("x"))).collect()]
    assert out[0] == dt.datetime(2026, 8, 21, 11, 50, 0) and out[1] is None
    n = spark.createDataFrame([(1787313000000,)], "x long").select(epoch_millis_to_ts(F.col("x"))).first()[0]
    assert n == dt.datetime(2026, 8, 21, 11, 50, 0)
    assert not math.isnan(0.0)
