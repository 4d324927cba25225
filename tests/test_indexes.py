"""Inverted, trigram and cell indexes return what the scans return, and look at less."""
import random
import uuid

import pytest
from pyspark.sql import functions as F

from latticeguard.operators import passage_index as pi
from latticeguard.operators import retrieval as rt
from latticeguard.operators.text_search import TrigramIndex, grams
from latticeguard.session import checkpoint_dir


def root(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/test-index-{uuid.uuid4().hex}"


# --- passages -----------------------------------------------------------------------


def passages(spark, n=220, seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, j, f"s{i % 3}", rnd.choices(words, weights=[1 / (r + 1) for r in range(60)], k=rnd.randint(1, 30)))
            for i in range(n) for j in range(rnd.randint(1, 2))]
    rows += [(900, 0, "s", []), (901, 0, None, ["w3"] * 40), (901, 0, None, ["w3"] * 40)]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_no int, source string, tokens array<string>")
    queries = [(q, rnd.sample(words, rnd.randint(1, 12)) + ["w0"] * rnd.randint(0, 3)) for q in range(15)] + [(99, ["absent"])]
    terms = spark.createDataFrame([(q, t) for q, ts in queries for t in ts], "query_id long, term string").groupBy(
        "query_id", "term").agg(F.count(F.lit(1)).alias("c"))
    return chunks, terms


@pytest.mark.parametrize("k", [1, 5])
def test_index_returns_the_scans_rows(spark, k):
    chunks, terms = passages(spark)
    index = pi.PassageIndex.build(chunks, root(spark))
    assert sorted(map(tuple, index.search(terms, k).collect()), key=str) == sorted(map(tuple, rt.retrieve(chunks, terms, k).collect()), key=str)


def test_bounds_leave_most_chunks_unscored(spark, monkeypatch):
    chunks, terms = passages(spark, n=600, seed=2)
    where = root(spark)
    pi.PassageIndex.build(chunks, where)
    index = pi.PassageIndex.open(spark, where)  # written once, opened for any number of queries
    pairs, queries = index.candidates(terms, 1)
    touched = terms.join(index.postings, "term").select("query_id", "uid").distinct().count()
    assert 15 <= pairs.count() < touched / 4
    expected = sorted(map(tuple, index.search(terms, 3).collect()), key=str)
    monkeypatch.setattr(pi, "SEED_CELL", 0)  # no floor: every chunk with a term is a candidate
    assert sorted(map(tuple, index.search(terms, 3).collect()), key=str) == expected


def test_an_empty_corpus_or_query_set(spark):
    chunks, terms = passages(spark, n=5)
    index = pi.PassageIndex.build(chunks.limit(0), root(spark))
    assert index.search(terms).collect() == []
    assert pi.PassageIndex.build(chunks, root(spark)).search(terms.limit(0)).collect() == []


def test_floor_scores_few_chunks_of_a_large_cell_and_postings_stay(spark, monkeypatch):
    monkeypatch.setattr("pyspark.sql.DataFrame.repartitionByRange", lambda *_: pytest.fail("postings are shuffled"))
    rows = [(i, 0, "s", ["a", "b"] if i % 2 else ["a", "b", f"w{i}"]) for i in range(1200)] + [(5000, 0, "s", None), (5001, 0, "s", [])]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_no int, source string, tokens array<string>")
    terms = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "query_id long, term string, c long")
    index = pi.PassageIndex.build(chunks, root(spark))
    assert index.postings.count() == 600 * 5 and {r["uid"] for r in index.postings.collect()} <= {r["uid"] for r in index.chunks.collect()}
    sizes, scored = [], index._scored
    monkeypatch.setattr(index, "_scored", lambda pairs, queries: sizes.append(pairs.count()) or scored(pairs, queries))
    got = index.search(terms, 3)
    assert sizes[0] <= 3 * pi.SEEDS
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rt.retrieve(chunks, terms, 3).collect()))
    assert got.count() == 3


def test_a_block_writes_one_list_a_term_and_a_search_sums_it_whole(spark, monkeypatch):
    chunks, terms = passages(spark, n=300, seed=3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        index = pi.PassageIndex.build(chunks, root(spark))
        lists = index.lists.collect()
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "40"
        answers = []
        for most in (pi.TERMS_TO_TASKS, 0):  # the queries' terms in every task, or joined
            monkeypatch.setattr(pi, "TERMS_TO_TASKS", most, raising=False)
            assert ("dot" in index.candidates(terms, 3)[0].columns) == (most > 0)
            answers.append(sorted(map(tuple, index.search(terms, 3).collect()), key=str))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len({r["block"] for r in lists}) >= 300 // 40
    assert len({(r["block"], r["term"]) for r in lists}) == len(lists)
    for r in lists:
        layers = [h["layer"] for h in r["heads"]]
        assert layers == sorted(set(layers)) and sum(h["n"] for h in r["heads"]) == len(r["uids"]) == len(set(r["uids"]))
        for h in r["heads"]:
            at = slice(h["start"], h["start"] + h["n"])
            assert r["uids"][at] == sorted(r["uids"][at]) and h["top"] == max(r["impacts"][at])
    block_of = {(u, r["block"]) for r in lists for u in r["uids"]}
    assert len({u for u, _ in block_of}) == len(block_of)
    held = {(r["uid"], t["term"], t["c"]) for r in index.chunks.collect() for t in r["terms"]}
    assert {(r["uid"], r["term"], r["c"]) for r in index.postings.collect()} == held
    assert answers[0] == answers[1] == sorted(map(tuple, rt.retrieve(chunks, terms, 3).collect()), key=str)


# --- trigrams -----------------------------------------------------------------------


def test_trigram_search_equals_a_scan(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abAB é-") for _ in range(rnd.randint(0, 14))) for _ in range(300)] + [None, "", "ab", "Prod-DB prod-db"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, body string")
    index = TrigramIndex.build(rows, "body", root(spark))
    terms = ("ab", "ABA", "b é", "prod-db", "aaaa", "zzz", "é", "bab-", "")
    got = sorted((r["term"], r["id"]) for r in index.search(terms).collect())
    assert got == sorted((t.lower(), i) for t in terms for i, x in enumerate(texts) if x is not None and t.lower() in x.lower())
    assert sorted(index.search(terms).columns) == ["body", "id", "term"]
    some = {r["uid"] for r in index.candidates(["prod-db"]).collect()}
    assert len(some) == 1
    assert index.search(("abc",)).collect() == [] and index.search(()).collect() == []


def test_postings_are_lists_of_blocks_built_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr("pyspark.sql.DataFrame.repartitionByRange", lambda *_: pytest.fail("postings are shuffled"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(0, 100, 1, 3).selectExpr("id", "IF(id % 10 = 3, NULL, concat('x', id, '-asset')) AS body")
        index = TrigramIndex.build(rows, "body", root(spark))
        lists = index.postings.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(r["places"] == sorted(set(r["places"])) and 0 < len(r["places"]) <= 7 for r in lists)
    assert len({(r["gram"], r["block"]) for r in lists}) == len(lists) and len({r["block"] for r in lists}) >= 90 // 7
    held = {r["uid"]: r["hay"] for r in index.texts.collect()}
    got = sorted((r["block"] + p, r["gram"]) for r in lists for p in r["places"])
    assert got == sorted((u, g) for u, t in held.items() if t for g in {t[i:i + 3] for i in range(len(t) - 2)})
    plan = index.candidates(["asset"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert sorted(r["id"] for r in index.search(("7-ASS",)).collect()) == [i for i in range(100) if i % 10 == 7]


def test_grams_are_distinct(spark):
    got = spark.createDataFrame([("aaaa",), ("ab",), ("",), ("aéb",)], "t string").select(grams(F.col("t")).alias("g")).collect()
    assert [r["g"] for r in got] == [["aaa"], [], [], ["aéb"]]


def test_latest_row_of_equal_times_is_one_whole_row(spark):
    rows = [(1, 5, "a", 9), (1, 5, "b", 2), (1, 4, "z", 99), (2, 1, None, None)]
    for order in (rows, rows[::-1]):
        got = rt.latest_per_key(spark.createDataFrame(order, "k int, ts int, v string, w int"), "k", "ts", ["v", "w"])
        assert sorted(map(tuple, got.collect())) == [(1, "b", 2, 5), (2, None, None, 1)]


# --- cells --------------------------------------------------------------------------


def clustered(n, dim, seed):
    import numpy as np

    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(20, dim)) * 4
    return [(i, i % 3, (centres[i % 20] + rnd.normal(size=dim) * 0.4).tolist()) for i in range(n)]


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_cells_return_the_scans_rows_and_score_few(spark, metric):
    from latticeguard.operators.vector_index import CellIndex, centroid_queries

    rows = clustered(900, 8, 1) + [(2000 + i, 1, [0.5] * 8) for i in range(30)]  # ties by vec_id
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    queries = [(i, [float(x) for x in v]) for i, _, v in rows[::50]] + [(9999, [0.5] * 8)]
    index = CellIndex.build(table, root(spark), metric)
    ours = centroid_queries(spark, queries)
    want = {(r["query_id"], r["rank"]): (r["vec_id"], r["label"], round(r["score"], 9)) for r in rt.topk(table, queries, 5, metric).collect()}
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["label"], round(r["score"], 9)) for r in index.search(ours, 5).collect()}
    assert got == want
    assert index.candidates(ours, 5).count() < len(rows) * len(queries) / 4  # rows scored, of rows times queries


def test_cells_of_odd_tables(spark):
    from latticeguard.operators.vector_index import CellIndex, centroid_queries

    schema = "vec_id long, label int, embedding array<float>"
    one = spark.createDataFrame([(1, None, [1.0, 0.0]), (1, None, [1.0, 0.0]), (2, 5, [0.0, 0.0])], schema)
    queries = centroid_queries(spark, [(0, [1.0, 0.0])])
    cosine = CellIndex.build(one, root(spark), "cosine").search(queries, 5).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in cosine] == [(1, 1, 1.0), (2, 1, 1.0)]  # no direction, no cosine
    assert [r["vec_id"] for r in CellIndex.build(one, root(spark), "l2").search(queries, 5).collect()] == [1, 1, 2]
    assert CellIndex.build(one.limit(0), root(spark), "l2").search(queries, 5).collect() == []
    with pytest.raises(ValueError, match="metric"):
        CellIndex.build(one, root(spark), "dot")


# --- pages --------------------------------------------------------------------------


def test_pages_hold_every_item_once(spark):
    from latticeguard.operators import documents as dc

    rnd = random.Random(9)
    keys = rnd.sample(range(100_000), 240)
    found = [(1 if i % 3 else i % 7 + 2, k, i % 4, f"f{k}", "RSA", None, True) for i, k in enumerate(keys)]
    findings = spark.createDataFrame(found, "asset_id long, order_key long, line_no int, finding_id string, algorithm string, "
                                            "key_size int, quantum_vulnerable boolean")
    head = spark.createDataFrame([(a, "x") for a in (*range(1, 9), 99)], "asset_id long, name string")
    pages = dc.asset_pages(head, findings, page=7).collect()
    for a in (*range(1, 9), 99):
        mine = sorted((p for p in pages if p["asset_id"] == a), key=lambda p: p["page"])
        ids = [f["finding_id"] for p in mine for f in p["findings"]]
        assert ids == [f[3] for f in sorted((f for f in found if f[0] == a), key=lambda f: (f[1], f[2]))]
        assert [p["page"] for p in mine] == list(range(1, mine[0]["n_pages"] + 1))
        assert all(len(p["findings"]) == 7 for p in mine[:-1]) and all(p["name"] == "x" for p in mine)
    plan = spark.createDataFrame([(p, r, r * 10 + p, 0, 0.5, None) for p in (1, 2) for r in range(1, 16 * p)],
                                 "phase int, rank long, asset_id long, level int, score double, reasoning string")
    got = sorted(dc.plan_pages(plan, page=10).collect(), key=lambda r: (r["phase"], r["page"]))
    assert [(r["phase"], r["page"], r["n_items"], len(r["items"])) for r in got] == [
        (1, 1, 15, 10), (1, 2, 15, 5), (2, 1, 31, 10), (2, 2, 31, 10), (2, 3, 31, 10), (2, 4, 31, 1)]
    assert all([i["rank"] for i in r["items"]] == sorted(i["rank"] for i in r["items"]) for r in got)
