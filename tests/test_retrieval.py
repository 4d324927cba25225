"""Chunk embeddings and retrieval against a brute-force cosine on a small fixture."""
import math
from collections import Counter

from latticeguard.operators import retrieval as rt

DOCS = [
    (1, "RSA keys and RSA certificates. the the the", "a"),
    (2, "RSA keys and RSA certificates. the the the", "b"),  # exact copy: a tie broken by doc_id
    (3, "elliptic curves, ECDSA keys, and the curve25519 key", "c"),
    (4, "nothing shared here 123", "d"),
    (5, "", "e"),
    (6, "Schlüssel für die Straße, clé privée; clé", "f"),
]
QUERIES = [(10, "RSA certificates"), (11, "ECDSA key curve"), (12, "zzz"), (13, "clé schlüssel")]


def _vec(text):
    import re
    return Counter(t.lower() for t in re.findall(r"[^\W_]+", text))


def _brute(k):
    out = []
    for qid, qt in QUERIES:
        q = _vec(qt)
        qn = math.sqrt(sum(c * c for c in q.values()))
        scored = []
        for doc, text, src in DOCS:
            v = _vec(text)
            dot = sum(c * q.get(t, 0) for t, c in v.items())
            if dot > 0:
                scored.append((-round(dot / (qn * math.sqrt(sum(c * c for c in v.values()))), 9), doc, src))
        for rank, (s, doc, src) in enumerate(sorted(scored)[:k], 1):
            out.append((qid, rank, doc, 0, src, -s))
    return sorted(out)


def test_norms_and_terms(spark):
    from pyspark.sql import functions as F

    d = spark.createDataFrame(DOCS, "doc_id long, text string, source string").withColumn("lang", F.lit("en"))
    emb = {r["doc_id"]: r for r in rt.chunk_embeddings(rt.chunks(d)).collect()}
    v = _vec(DOCS[0][1])
    assert emb[1]["n_terms"] == len(v) and emb[1]["n_tokens"] == sum(v.values())
    assert abs(emb[1]["norm"] - math.sqrt(sum(c * c for c in v.values()))) < 1e-12
    assert emb[5]["n_tokens"] == 0 and emb[5]["norm"] == 0.0


def test_retrieve_matches_brute_force(spark):
    from pyspark.sql import functions as F

    d = spark.createDataFrame(DOCS, "doc_id long, text string, source string").withColumn("lang", F.lit("en"))
    q = spark.createDataFrame(QUERIES, "item_id long, text string")
    emb = rt.chunk_embeddings(rt.chunks(d)).repartition(3)
    for k in (1, 2, 5):
        got = sorted(tuple(r) for r in rt.retrieve(emb, rt.query_terms(q, "item_id", "text"), k=k).collect())
        assert got == _brute(k)


def test_more_queries_than_a_block_take_more_passes(spark):
    from pyspark.sql import functions as F

    d = spark.createDataFrame(DOCS, "doc_id long, text string, source string").withColumn("lang", F.lit("en"))
    many = spark.createDataFrame([(i, QUERIES[i % 4][1]) for i in range(1100)], "item_id long, text string")
    emb = rt.chunk_embeddings(rt.chunks(d)).repartition(2)
    terms = rt.query_terms(many, "item_id", "text")
    got = rt.retrieve(emb, terms, k=2)
    by = {}
    for r in got.collect():
        by.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    want = {}
    for qid, rank, doc, _, _, score in _brute(2):
        want.setdefault(qid, []).append((rank, doc, score))
    assert set(by) == {i for i in range(1100) if i % 4 != 2}
    assert all(sorted(by[i]) == sorted(want[10 + i % 4]) for i in by)
    assert sorted(rt.retrieve(emb, terms.where("query_id < 8"), k=2, block=3).collect()) == sorted(
        r for r in got.collect() if r["query_id"] < 8)


def test_vector_topk_in_blocks(spark):
    emb = spark.createDataFrame([(i, i % 3, [float(i % 7), 1.0, float(i % 5)]) for i in range(60)],
                                "vec_id long, label int, embedding array<float>")
    queries = [(q, [float(q), 1.0, 2.0]) for q in range(9)]
    for metric in ("cosine", "l2"):
        whole = sorted(rt.topk(emb, queries, 4, metric).collect())
        assert whole == sorted(rt.topk(emb, queries, 4, metric, block=2).collect()) and len(whole) == 36


def test_every_match_of_a_line_is_a_finding(spark):
    d = spark.createDataFrame([(1, "s", "use MD5 and md5\nnothing\nRSA-1024 DES DES"), (2, "s", None)],
                              "doc_id long, source string, text string")
    got = sorted((r["path"], r["line_no"], r["rule_id"], r["match_no"], r["snippet"]) for r in rt.rule_hits(d).collect())
    assert got == [("s/1", 1, "md5-digest", 1, "MD5"), ("s/1", 1, "md5-digest", 2, "md5"), ("s/1", 3, "des-cipher", 1, "DES"),
                   ("s/1", 3, "des-cipher", 2, "DES"), ("s/1", 3, "rsa-1024-keygen", 1, "RSA-1024")]
