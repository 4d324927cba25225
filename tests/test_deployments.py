"""Priorities under a table of bars, against a plain loop."""
import math
import random

from latticeguard.operators.deployments import priority_by_deployment


def test_bars_of_each_deployment(spark):
    rnd = random.Random(4)
    bars = [(d, f"p{i}", rnd.choice([0.0, 0.25, 0.5, 0.75, 0.9])) for d in ("a", "b", "c") for i in range(4)]
    values = [None, float("nan"), -1.0, 0.0, 0.25, 0.5, 0.8, 2.0]
    rows = [(d, v) for d in ("a", "b", "c", "none", None) for v in values] * 2
    got = priority_by_deployment(spark.createDataFrame(rows, "deployment string, risk_score double"), spark.createDataFrame(
        [*bars, ("a", None, 0.1), ("b", "x", None)], "deployment string, priority string, min_score double")).collect()
    assert len(got) == len(rows)
    for r in got:
        mine = sorted((-m, p) for d, p, m in bars if d == r["deployment"])
        want = None
        if mine and r["risk_score"] is not None:
            reached = [p for m, p in mine if not math.isnan(r["risk_score"]) and r["risk_score"] >= -m]
            want = (reached or [mine[-1][1]])[0]
        assert r["priority"] == want, r
