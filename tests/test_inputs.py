"""Input checks, imputation, JSON instances, asset resolution, upsert, exports."""
import datetime
import json
import uuid

import pytest
from pyspark.sql import functions as F

from latticeguard.operators import features as ft
from latticeguard.operators import graph as gr
from latticeguard.operators import ingest, reports
from latticeguard.operators import training as trn
from latticeguard.schemas import FEATURE_NAMES
from latticeguard.session import checkpoint_dir
from test_encode_graph_vectors import GOOD


def test_json_instances_are_typed_by_their_json(spark):
    cases = {
        "good": (GOOD, None), "extra": ({**GOOD, "other": [1]}, None), "float": ({**GOOD, "key_size": 2048.5}, None),
        "text": ({**GOOD, "key_size": "2048"}, "feature key_size must be a number"),
        "bool": ({**GOOD, "customer_data": True}, "feature customer_data must be a number"),
        "null": ({**GOOD, "criticality": None}, "missing feature criticality"),
        "gone": ({k: v for k, v in GOOD.items() if k != "loc_estimate"}, "missing feature loc_estimate"),
        "case": ({**GOOD, "criticality": "critical"}, "unknown category for criticality: critical"),
        "number": ({**GOOD, "network_zone": 1}, "feature network_zone must be a known string"),
        "two": ({**GOOD, "network_zone": "?", "key_size": []}, "feature key_size must be a number; unknown category for network_zone: ?"),
    }
    rows = [(name, json.dumps(instance)) for name, (instance, _) in cases.items()]
    rows += [("list", "[1]"), ("broken", "{"), ("none", None)]
    df = spark.createDataFrame(rows, "asset_id string, instance string")
    got = {r["asset_id"]: r for r in ft.encode_instances(df, "instance").collect()}
    assert {k: got[k]["encode_error"] for k in cases} == {k: e for k, (_, e) in cases.items()}
    assert {got[k]["encode_error"] for k in ("list", "broken", "none")} == {"instance is not a JSON object"}
    assert got["good"]["key_size"] == 2048.0 and got["good"]["criticality"] == 3.0 and got["float"]["key_size"] == 2048.5


def test_empty_input_and_bad_training_rows_are_errors(spark):
    schema = "asset_id long, risk_score double, " + ", ".join(
        f"{c} {'string' if isinstance(GOOD[c], str) else 'int'}" for c in FEATURE_NAMES)
    row = lambda i, **odd: (i, 0.5, *({**GOOD, **odd}[c] for c in FEATURE_NAMES))
    good = spark.createDataFrame([row(1), row(2, asset_age_days=100), row(3, asset_age_days=None)], schema)
    with pytest.raises(ValueError, match="is empty"):
        trn.training_frame(good.limit(0))
    with pytest.raises(ValueError, match=r"missing feature asset_age_days \(1 rows\)"):
        trn.training_frame(good)
    medians = ft.fit_medians(good)
    assert medians == {"asset_age_days": 250.0}
    assert [r["asset_age_days"] for r in trn.training_frame(good, medians=medians).orderBy("asset_id").collect()] == [400, 100, 250]
    bad = spark.createDataFrame([row(1, criticality="?")], schema)
    with pytest.raises(ValueError, match="unknown category"):
        trn.training_frame(bad, medians=medians)


def test_a_number_missing_only_in_the_test_part_takes_the_training_median(spark):
    from latticeguard.plans.inventory import Inventory

    schema = "asset_id long, risk_score double, split string, " + ", ".join(
        f"{c} {'string' if isinstance(GOOD[c], str) else 'int'}" for c in FEATURE_NAMES)
    row = lambda i, part, **odd: (i, 0.5, part, *({**GOOD, **odd}[c] for c in FEATURE_NAMES))
    inv = Inventory(spark, "/nowhere", persist=False)
    inv.split = spark.createDataFrame([row(1, "train"), row(2, "train", asset_age_days=100), row(3, "train", asset_age_days=200),
                                       row(4, "test", asset_age_days=None), row(5, "test")], schema)
    assert inv.medians == {"asset_age_days": 200.0}
    assert {r["asset_id"]: r["asset_age_days"] for r in inv.test_encoded.collect()} == {4: 200.0, 5: 400.0}
    assert {r["asset_id"]: r["asset_age_days"] for r in inv.train_encoded.collect()} == {1: 400.0, 2: 100.0, 3: 200.0}


def test_rollup_sorts_rows_without_finding_ids_and_still_names_the_primary_one(spark):
    rows = [(1, 10, 1, 5), (1, 10, 2, 5), (1, 9, 3, 5), (1, 11, 1, 4), (2, 7, None, 1), (2, 7, 1, 0)]
    findings = spark.createDataFrame(rows, "asset_id long, order_key long, line_no int, day int").select(
        "asset_id", "order_key", "line_no", F.concat_ws("-", "order_key", "line_no").alias("finding_id"),
        F.timestamp_seconds(F.col("day")).alias("discovered_at"), F.lit("RSA").alias("algorithm"), F.lit(2048).alias("key_size"),
        F.lit("tls_scan").alias("source"), F.lit(True).alias("quantum_vulnerable"))
    rolled = ft.finding_rollup(findings)
    got = {r["asset_id"]: r for r in rolled.collect()}
    assert {k: (r["primary"]["finding_id"], r["n_findings"]) for k, r in got.items()} == {1: ("10-2", 4), 2: ("7", 2)}
    plan = rolled._jdf.queryExecution().optimizedPlan().toString()
    assert "finding_id" not in plan[plan.index("Aggregate"):]


def test_asset_resolution_by_either_hint(spark):
    assets = spark.createDataFrame([(1, "h1", "r1"), (2, "h2", "r2")], "asset_id long, hostname string, repo string")
    hints = [("a", "h1", None), ("b", None, "r2"), ("c", "h2", "r1"), ("d", "hx", "r1"), ("e", "hx", "rx"), ("f", "hx", None), ("g", None, None)]
    f = spark.createDataFrame(hints, "finding_id string, hostname string, repo string").select(
        "finding_id", F.struct("hostname", "repo").alias("asset_hint"))
    got = {r["finding_id"]: (r["resolved_asset"], r["matched_by"]) for r in ingest.resolve_assets(f, assets).collect()}
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert got == {"a": ("1", "hostname"), "b": ("2", "repo"), "c": ("2", "hostname"), "d": ("1", "repo"),
                   "e": (md5("hx"), "created"), "f": (md5("hx"), "created"), "g": (None, "created")}


def test_plans_of_resolution_and_downstream(spark):
    from latticeguard.plans.inventory import shared_inventory

    inv = shared_inventory(spark, "/root/testdata/sf0.001")
    plan = ingest.resolve_assets(inv.findings, inv.assets)._jdf.queryExecution().optimizedPlan().toString()
    hint_joins = {line.split("Join LeftOuter, ")[1].split("#")[0] for line in plan.splitlines() if "Join LeftOuter, ((kind" in line}
    assert hint_joins == {"((kind"}  # one join of hints with keys (its second reader reuses the exchange), on (kind, key)
    plan = gr.downstream_of_certificates(inv.graph[1])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [alg" in plan


def test_upsert_takes_the_newest_whole_row(spark):
    schema = "k int, a string, b int"
    now = spark.createDataFrame([(1, "old", 1), (2, "kept", 2)], schema)
    batch = spark.createDataFrame([(1, "newer", None, 5), (1, "older", 9, 4), (3, "x", 3, 1), (3, "y", None, 1)], schema + ", seen int")
    want = {(1, "newer", None), (2, "kept", 2), (3, "y", None)}
    for parts in (1, 4):
        once = gr.upsert(now, batch.repartition(parts), ["k"], recency="seen")
        assert {tuple(r) for r in once.collect()} == want
        assert {tuple(r) for r in gr.upsert(once, batch, ["k"], recency="seen").collect()} == want


def test_csv_and_json_exports(spark):
    base = f"{checkpoint_dir(spark).rstrip('/')}/test-io-{uuid.uuid4().hex}"
    df = spark.createDataFrame([(1, "a,b\"c", None), (2, None, 2.5)], "id int, s string, x double").withColumn("schema_version", F.lit("1"))
    rows = df.drop("schema_version")
    assert sorted(reports.read_csv(spark, reports.write_csv(rows, f"{base}/csv"), rows.schema).collect()) == sorted(rows.collect())
    with pytest.raises(Exception, match="(?i)header|column"):
        reports.read_csv(spark, f"{base}/csv", rows.select("s", "id", "x").schema).collect()
    path = reports.export_versioned(df, base, "t", fmt="json")
    assert sorted(r["id"] for r in spark.read.json(path).collect()) == [1, 2]
    with pytest.raises(Exception, match="(?i)exists"):
        reports.export_versioned(df, base, "t", fmt="json")


def test_created_assets_get_new_ids_once(spark):
    assets = spark.createDataFrame([(7, "a", "LOW"), (9, "b", "HIGH")], "asset_id long, hostname string, criticality string")
    new = spark.createDataFrame([("c", "LOW"), ("b", "LOW"), ("d", "LOW"), ("c", "LOW")], "hostname string, criticality string")
    got = reports.create_assets(assets, new)
    assert sorted((r["hostname"], r["asset_id"] > 9) for r in got.collect()) == [("a", False), ("b", False), ("c", True), ("d", True)]
    assert sorted(r["asset_id"] for r in got.collect()) == [7, 9, 10, 11]
    assert [r["hostname"] for r in reports.lookup_asset(got, 7).collect()] == ["a"]


def test_lines_are_shuffled_once_for_dedupe_and_orders(spark):
    import re
    from types import SimpleNamespace

    from latticeguard.sources import inventory as src

    line = "l_orderkey long, l_linenumber int, l_shipdate date, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string"
    day = [datetime.date(2000, 1, d) for d in range(1, 4)]
    lines = [(1, 1, day[0], 9, 9, 9.0, "R"), (1, 1, day[1], 3, 1, 1.0, "N"), (1, 1, day[1], 3, 1, 1.0, None), (1, 2, None, 4, 1, 1.0, "A"),
             (1, None, day[0], 6, 2, 1.0, "A"), (2, 1, day[2], None, 2, 1.0, "A"), (2, 1, day[2], 5, None, 1.0, "R"),
             (None, 1, day[0], 1, 1, 1.0, "A"), (7, 1, day[0], 1, 1, 1.0, "A")]
    orders = [(1, 10, day[0]), (1, 11, day[0]), (2, 20, None), (None, 30, day[0]), (3, 40, day[0])]
    t = SimpleNamespace(spark=spark, lineitem=spark.createDataFrame(lines * 3, line),
                        orders=spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date"))
    found = src.findings(t)
    got = sorted((r["finding_id"], r["asset_id"], r["algorithm"], r["source"], str(r["discovered_at"])) for r in found.collect())
    first = [("1-1", "ECDSA", "repo_scan", "2000-01-02"), ("1-2", "EdDSA", "tls_scan", "None"), ("1", "ML-KEM", "tls_scan", "2000-01-01")]
    assert got == sorted([(f[0], a, *f[1:]) for f in first for a in (10, 11)] + [("2-1", 20, "ECDH", "tls_scan", "2000-01-03")])
    plan = found._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert {re.sub(r"#\d+L?", "", s) for s in shuffles} == {"l_orderkey", "o_orderkey"}
