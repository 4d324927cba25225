"""Dependency levels: longest path, cycle detection."""
import pytest

from latticeguard.operators.planner import dependency_levels


def test_levels_longest_path(spark):
    assets = spark.createDataFrame([(i,) for i in range(5)], "asset_id long")
    edges = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (3, 2), (4, 0)], "src long, dst long")
    got = {r["asset_id"]: r["level"] for r in dependency_levels(assets, edges).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 1}


def test_cycle_raises(spark):
    assets = spark.createDataFrame([(i,) for i in range(3)], "asset_id long")
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "src long, dst long")
    with pytest.raises(ValueError, match="cycle"):
        dependency_levels(assets, edges)


def test_self_loop_and_nodes_behind_a_cycle_raise(spark):
    assets = spark.createDataFrame([(i,) for i in range(5)], "asset_id long")
    edges = spark.createDataFrame([(0, 0), (1, 0), (2, 3)], "src long, dst long")
    with pytest.raises(ValueError, match="cycle: 2 nodes"):
        dependency_levels(assets, edges)


def test_a_deep_chain_is_no_cycle(spark):
    n = 105
    assets = spark.createDataFrame([(i,) for i in range(n + 1)], "asset_id long")
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(n, 0)], "src long, dst long")
    got = {r["asset_id"]: r["level"] for r in dependency_levels(assets, edges).collect()}
    assert got == {i: i for i in range(n + 1)}


def test_the_edge_table_is_written_again_only_when_half_of_it_is_closed(spark, monkeypatch):
    from latticeguard.operators import planner

    written = []
    monkeypatch.setattr(planner, "materialize", lambda df, name, real=planner.materialize: written.append(name) or real(df, name))
    n = 24
    assets = spark.createDataFrame([(i,) for i in range(n + 1)] + [(0,), (5,), (None,)], "asset_id long")
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] * 2 + [(n, 0), (n, 7), (9, 1)], "src long, dst long")
    got = sorted((r["level"], r["asset_id"]) for r in dependency_levels(assets, edges).collect() if r["asset_id"] is not None)
    assert got == sorted([(i, i) for i in range(n + 1)] + [(0, 0)])
    assert written.count("level-edges") <= 6  # a chain of n closes one edge a round


def test_offsets_over_more_ranges_than_one(spark):
    from latticeguard.functions.quantiles import rows_before

    counts = spark.createDataFrame([(g, b, (b * 7 + g) % 5 + 1) for g in range(2) for b in range(0, 300, 3)],
                                   "g int, b long, c long")
    got = {(r["g"], r["b"]): r["before"] for r in rows_before(counts, ["g"], "b", "c", "before", coarse=16).collect()}
    for g in range(2):
        total = 0
        for b in range(0, 300, 3):
            assert got[g, b] == total
            total += (b * 7 + g) % 5 + 1


def test_average_rank_matches_pandas_with_hot_ties(spark):
    import numpy as np
    import pandas as pd

    from latticeguard.operators.planner import average_rank_desc

    rng = np.random.default_rng(3)
    n = 3000
    scores = np.round(rng.random(n), 3)
    scores[: n // 3] = 0.5  # one score held by a third of all rows
    scores[5] = 1.0
    scores[6] = 0.0
    pdf = pd.DataFrame({"asset_id": np.arange(n), "s": scores})
    got = average_rank_desc(spark.createDataFrame(pdf), "asset_id", "s", buckets=64).toPandas()
    got = got.set_index("asset_id")["avg_rank"].sort_index()
    want = pdf.set_index("asset_id")["s"].rank(method="average", ascending=False).sort_index()
    assert np.allclose(got.to_numpy(), want.to_numpy())


def test_expert_set_is_disjoint_and_agreement_sums(spark):
    from latticeguard.operators import evaluation as ev
    from latticeguard.plans.inventory import shared_inventory

    inv = shared_inventory(spark, "/root/testdata/sf0.001")
    frame = ev.expert_frame(inv.standin_predictions, inv.rule_labelled, inv.train)
    e = ev.expert_evaluation(frame).first()
    assert e["n_in_train"] == 0 and e["n"] > 0
    a = ev.agreement_rate(frame).collect()
    assert sum(r["n_judged"] for r in a) == e["n"]
    assert abs(sum(r["n_agree"] for r in a) / e["n"] - e["bucket_match_rate"]) < 1e-9


def test_score_row_number_matches_sort_with_hot_score(spark):
    import numpy as np
    import pandas as pd

    from latticeguard.operators.planner import score_row_number

    rng = np.random.default_rng(11)
    n = 5000
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "asset_id": rng.permutation(n * 7)[:n],
                        "score": np.round(rng.random(n), 4)})
    pdf.loc[: n // 3, "score"] = 0.25  # a third of all rows share one score
    pdf.loc[5, "score"] = 1.0
    pdf.loc[6, "score"] = 0.0
    got = score_row_number(spark.createDataFrame(pdf), ["g"], "score", "asset_id", "rn", buckets=16,
                           id_range=64).toPandas()
    want = pdf.sort_values(["g", "score", "asset_id"], ascending=[True, False, True])
    want["rn"] = want.groupby("g").cumcount() + 1
    m = got.merge(want, on=["g", "asset_id"], suffixes=("", "_want"))
    assert len(m) == n and (m["rn"] == m["rn_want"]).all()


def test_sides_with_a_row_per_item_are_joined_by_key(spark):
    from latticeguard.operators.planner import score_row_number, weighted_plan

    rows = [(i, 0.5 if i % 3 else i / 100, "HIGH" if i % 2 else "LOW", 0, 1, 0) for i in range(90)]
    items = spark.createDataFrame(rows, "asset_id long, risk_score double, migration_complexity string, financial_data int, customer_data int, regulated_system int")
    levels = spark.createDataFrame([(i, i % 2) for i in range(90)], "asset_id long, level int")
    ranked = score_row_number(items, ["migration_complexity"], "risk_score", "asset_id")
    assert "strategy=merge" in ranked._jdf.queryExecution().optimizedPlan().toString()
    want = {}
    for kind in ("HIGH", "LOW"):
        mine = sorted((r for r in rows if r[2] == kind), key=lambda r: (-r[1], r[0]))
        want |= {r[0]: i + 1 for i, r in enumerate(mine)}
    assert {r["asset_id"]: r["rn"] for r in ranked.collect()} == want
    plan = weighted_plan(items, levels, cap=5)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("strategy=merge") == 2 and plan.count() == 90
