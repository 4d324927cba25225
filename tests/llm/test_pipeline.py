"""The pipeline stage by stage against plain Python, on small documents and on odd tables."""
import random
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
from latticeguard.llm import decontaminate, hostquality, packing
from test_decontaminate import brute as brute_overlaps
from test_hostquality import brute_stats
from test_linededup import brute as brute_lines
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def expected(rows, bench):
    """The texts, by doc_id, that reach the packing stage. Hosts are far from being rejected in these tables."""
    rows = [r for r in rows if (s := brute_stats(r[2]))[0] >= 50 and 100 * s[4] <= 50 * s[0]]
    texts = {i: t for (i, t), n in brute_lines(rows, 0.1, 4).items() for _ in range(n)}
    groups = brute_components({i: brute_fingerprint(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if groups[i] == i}
    leaks = {d for d, _ in brute_overlaps(texts.items(), bench)}
    return {i: t for i, t in texts.items() if i not in leaks}


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = expected(rows, bench)
    assert 0 < len(want) < len(rows)
    exact = Tokenizer.from_file(public_tokenizers.path(packing.bpe.TOKENIZER))
    pieces = Counter()
    for r in corpus_pipeline.run(spark, SF).collect():
        pieces[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert pieces == {(i, n): n for i, t in want.items() for n in [len(exact.encode(t, add_special_tokens=False).ids) + 1]}


def test_stages_keep_the_columns_and_take_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    rnd = random.Random(1)
    words = lambda n: " ".join(f"w{rnd.randrange(9000)}" for _ in range(n))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    body, rows = words(300), []
    rows += [(1, body, "en", "h", 0), (2, body.upper(), "en", "h", 0), (3, words(200) + "\n" + bench, "en", "h", 0),
             (4, "short", "en", "h", 0), (5, None, None, None, None), (6, "", "en", "", 0), (7, "a b c " * 60, "en", "h", 0)]
    rows += [(10 + i, f"menu of the site\n{words(90)}", "en", "site", 0) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == COLUMNS, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append({r["doc_id"] for r in docs.collect()})
    clean = {1, 3, *range(10, 22)}
    assert seen == [clean | {2}, clean | {2}, clean, clean - {3}]
    assert not docs.where("text LIKE '%menu of the site%'").count()
    assert docs.where("n_chars = length(text)").count() == docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == seen[-1]


def test_stages_take_empty_and_repeated_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    twice = docs.limit(20).unionByName(docs.limit(20))
    once = corpus_pipeline.STAGES[2][1](spark, twice, SF)
    ids = [r["doc_id"] for r in once.collect()]
    assert len(ids) == len(set(ids))


def test_helpers_agree():
    assert hostquality.text_stats("a b a b a b".encode())[4] == brute_stats("a b a b a b")[4]
    assert decontaminate.token_hashes("A, b!").tolist() == decontaminate.token_hashes("a b").tolist()
    assert np.uint64(1).dtype == np.uint64
