"""Distributed inversion counting against all pairs."""
import random
from itertools import combinations

import pytest

from latticeguard.operators import agreement as ag


def average_ranks(scores):
    order = sorted(scores)
    return [(order.index(s) + 1 + order.index(s) + order.count(s)) / 2 for s in scores]


def brute(a, b):
    con = dis = tied = comparable = 0
    for i, j in combinations(range(len(a)), 2):
        if b[i] == b[j]:
            continue
        comparable += 1
        way = (a[i] - a[j]) * (b[i] - b[j])
        con, dis, tied = con + (way > 0), dis + (way < 0), tied + (way == 0)
    return [len(a), comparable, con, dis, tied, (con + tied / 2) / comparable if comparable else None]


def frame(spark, ranks):
    return spark.createDataFrame(list(enumerate(ranks)), "asset_id long, rank double")


CASES = {
    "no ties": lambda r, n: (r.sample(range(n), n), r.sample(range(n), n)),
    "same order": lambda r, n: (list(range(n)), list(range(n))),
    "reverse": lambda r, n: (list(range(n)), list(range(n, 0, -1))),
    "few values": lambda r, n: ([r.randint(0, 3) for _ in range(n)], [r.randint(0, 5) for _ in range(n)]),
    "a third tied": lambda r, n: ([0 if i % 3 else i for i in range(n)], [r.choice((7, r.random())) for _ in range(n)]),
    "all tied": lambda r, n: ([1] * n, [1] * n),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_counts_equal_all_pairs(spark, monkeypatch, case):
    monkeypatch.setattr(ag, "DIGIT_BITS", 3)  # several levels
    monkeypatch.setattr(ag, "CHUNK", 5)
    rnd = random.Random(2)
    ours, truth = CASES[case](rnd, 120)
    other, _ = CASES["few values"](rnd, 120)
    ours, truth, other = (average_ranks(x) for x in (ours, truth, other))
    out = ag.pairwise_agreement({"one": frame(spark, ours), "two": frame(spark, other)}, frame(spark, truth), "asset_id")
    got = {r["system"]: [r["n"], *(int(x) for x in r[2:6]), r["agreement"]] for r in out.collect()}
    assert got["one"] == pytest.approx(brute(ours, truth)) if got["one"][-1] is not None else got["one"] == brute(ours, truth)
    assert got["two"][:5] == brute(other, truth)[:5]


def test_default_digits_and_missing_items(spark):
    rnd = random.Random(3)
    n = 1500
    ours, truth = average_ranks([rnd.randint(0, 900) for _ in range(n)]), average_ranks([rnd.random() for _ in range(n)])
    extra = spark.createDataFrame([(n + 5, 3.0), (n + 6, None)], "asset_id long, rank double")
    out = ag.pairwise_agreement({"one": frame(spark, ours).union(extra)}, frame(spark, truth), "asset_id")
    row = out.first()
    assert [row["n"], *(int(x) for x in row[2:6])] == brute(ours, truth)[:5]
    empty = frame(spark, ours).limit(0)
    assert ag.pairwise_agreement({"one": empty}, frame(spark, truth), "asset_id").collect() == []


def test_plan_has_no_pair_join(spark):
    points = spark.range(1000).selectExpr("0 AS s", "id AS x", "999 - id AS y", "1L AS m")
    plan = ag.agreeing_pairs(points, 1000)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ag.agreeing_pairs(points, 1000).first()["pairs"] == 0
