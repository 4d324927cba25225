"""Instance encoding, the demo graph, vector distances, chunking."""
import math

import pytest

from latticeguard.operators import graph as gr
from latticeguard.operators import retrieval as rt
from latticeguard.operators.features import encode_features
from latticeguard.schemas import FEATURE_NAMES

GOOD = dict(algorithm_RSA=1, algorithm_ECC=0, key_size=2048, quantum_vulnerable=1, internet_accessible=1,
            has_public_cert=1, network_zone="public", financial_data=1, customer_data=1, regulated_system=1,
            criticality="CRITICAL", dependency_count=3, loc_estimate=1000, migration_complexity="LOW",
            asset_age_days=400, previous_incident_flag=0)


def _enc(spark, rows, mode="strict", types=None):
    cols = ["asset_id"] + FEATURE_NAMES
    schema = ", ".join(f"{c} {(types or {}).get(c, 'string' if c in ('network_zone', 'criticality', 'migration_complexity') else 'int')}"
                       for c in FEATURE_NAMES)
    data = [tuple([i] + [r.get(c) for c in FEATURE_NAMES]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "asset_id long, " + schema)
    return encode_features(df, mode).orderBy("asset_id").collect()


def test_encode_good_row(spark):
    (r,) = _enc(spark, [GOOD])
    assert r["encode_error"] is None
    assert (r["key_size"], r["criticality"]) == (2048.0, 3.0)


def test_encode_missing_and_unknown_category(spark):
    rows = [dict(GOOD, criticality=None), dict(GOOD, criticality="NOT_A_LEVEL"), dict(GOOD, criticality="critical")]
    errs = [r["encode_error"] for r in _enc(spark, rows)]
    assert "missing feature criticality" in errs[0]
    assert "unknown category for criticality: NOT_A_LEVEL" in errs[1]
    assert "unknown category" in errs[2]  # case-sensitive in the encoder


def test_encode_strict_vs_lenient_types(spark):
    rows = [dict(GOOD, key_size="2048"), dict(GOOD, key_size="abc")]
    strict = _enc(spark, rows, types={"key_size": "string"})
    assert strict[0]["key_size"] is None and "key_size must be a number" in strict[0]["encode_error"]
    assert "must be a number" in strict[1]["encode_error"]
    bools = _enc(spark, [dict(GOOD, quantum_vulnerable=True)], types={"quantum_vulnerable": "boolean"})
    assert "must be a number" in bools[0]["encode_error"]
    lenient = _enc(spark, [dict(GOOD, quantum_vulnerable=True)], mode="lenient", types={"quantum_vulnerable": "boolean"})
    assert lenient[0]["quantum_vulnerable"] == 1.0 and lenient[0]["encode_error"] is None


def _demo_graph(spark):
    nodes = spark.createDataFrame([
        ("Application", "payment-gateway", "payment-gateway", "CRITICAL", None, None, None, None),
        ("Application", "internal-wiki", "internal-wiki", "LOW", None, None, None, None),
        ("Certificate", "cert-payment-001", "cert-payment-001", None, None, None, None, None),
        ("Certificate", "cert-wiki-002", "cert-wiki-002", None, None, None, None, None),
        ("Algorithm", "RSA-2048", "RSA", None, 2048, True, None, None),
        ("Algorithm", "ML-KEM", "ML-KEM", None, None, False, None, None),
        ("DataAsset", "customer-payment-data", "customer-payment-data", None, None, None, "financial", None),
        ("DataAsset", "internal-docs", "internal-docs", None, None, None, "internal", None),
    ], "node_type string, node_id string, name string, criticality string, key_size int, quantum_vulnerable boolean, "
       "classification string, not_after date")
    edges = spark.createDataFrame([
        ("Application", "payment-gateway", "USES", "Certificate", "cert-payment-001"),
        ("Certificate", "cert-payment-001", "SIGNED_WITH", "Algorithm", "RSA-2048"),
        ("Algorithm", "RSA-2048", "PROTECTS", "DataAsset", "customer-payment-data"),
        ("Application", "internal-wiki", "USES", "Certificate", "cert-wiki-002"),
        ("Certificate", "cert-wiki-002", "SIGNED_WITH", "Algorithm", "ML-KEM"),
        ("Algorithm", "ML-KEM", "PROTECTS", "DataAsset", "internal-docs"),
    ], "src_type string, src string, rel string, dst_type string, dst string")
    return nodes, edges


def test_demo_graph_query_and_idempotent_upsert(spark):
    nodes, edges = _demo_graph(spark)
    rows = [tuple(r) for r in gr.critical_apps_on_algorithm(nodes, edges).select("app", "alg_name", "key_size").collect()]
    assert rows == [("payment-gateway", "RSA", 2048)]
    twice = gr.upsert(gr.upsert(nodes, nodes, ["node_type", "node_id"]), nodes, ["node_type", "node_id"])
    assert twice.count() == 8 and edges.count() == 6
    assert [r["app"] for r in gr.apps_without_safe_path(nodes, edges).collect()] == ["payment-gateway"]
    assert [r["data"] for r in gr.data_only_behind_vulnerable(nodes, edges).collect()] == ["customer-payment-data"]


def test_vector_distances(spark):
    emb = spark.createDataFrame([(1, 0, [1.0, 2.0, 3.0]), (2, 0, [10.0, 20.0, 30.0])],
                                "vec_id long, label int, embedding array<float>")
    res = rt.topk(emb, [(0, [1.0, 2.0, 4.0])], k=2, metric="l2").orderBy("rank").collect()
    assert [r["vec_id"] for r in res] == [1, 2]
    assert res[0]["score"] == pytest.approx(1.0) and res[1]["score"] == pytest.approx(math.sqrt(1081))


def test_chunks_cover_whole_text(spark):
    text = " ".join(f"w{i}" for i in range(1234))
    docs = spark.createDataFrame([(1, text, "src", "en")], "doc_id long, text string, source string, lang string")
    ch = rt.chunks(docs).orderBy("chunk_no").collect()
    assert [c["start_word"] for c in ch] == [0, 450, 900]
    assert ch[-1]["chunk_text"].split()[-1] == "w1233"


def test_rule_hits(spark):
    docs = spark.createDataFrame([(1, "src", 'a\nkey token = "' + "ab" * 20 + '" here\nuse DES and md5\n')],
                                 "doc_id long, source string, text string")
    hits = sorted((r["line_no"], r["rule_id"]) for r in rt.rule_hits(docs).collect())
    assert hits == [(2, "hardcoded-key"), (3, "des-cipher"), (3, "md5-digest")]


def test_a_filter_on_the_error_stays_above_the_instance_encoder(spark):
    from pyspark.sql import functions as F

    from latticeguard.operators.features import encode_instances

    rows = spark.range(0, 20, 1, 2).select(F.col("id").alias("asset_id"), F.when(F.col("id") % 2 == 0, '{"key_size":1}').otherwise("x").alias("instance"))
    bad = encode_instances(rows, "instance").where(F.col("encode_error").isNotNull()).select("asset_id", "encode_error")
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")  # below it, each instance would be parsed a second time
    got = {r["asset_id"]: r["encode_error"] for r in bad.collect()}
    assert len(got) == 20 and got[1] == "instance is not a JSON object" and "missing feature" in got[0]
