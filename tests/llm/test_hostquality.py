"""Host-level quality rules: measures against plain Python, shrinkage by hand."""
import random
import re

import pytest

from latticeguard.llm import hostquality as hq


def brute_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(covered))


@pytest.mark.parametrize("seed", range(40))
def test_stats_equal_brute_force(seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choice(["a ", "b ", "é  ", "c\n", "#x ", "\t", "a b c ", "\x0b", "日 "]) for _ in range(rnd.randint(0, 80)))
    assert hq.text_stats(text.encode()) == brute_stats(text)


def test_stats_of_nothing():
    assert hq.text_stats(None) == hq.text_stats(b"") == (0, 0, 0, 0, 0)
    assert hq.text_stats("x".encode() * 200_000)[:2] == (1, 200_000)


def corpus():
    rnd = random.Random(0)
    good = lambda i: " ".join(f"w{rnd.randrange(10_000)}" for _ in range(80)) + f" {i}"
    rows = [(i, "good", good(i)) for i in range(60)]
    rows += [(100 + i, "bad", "too short" if i % 10 else good(i)) for i in range(60)]
    rows += [(200, "tiny", "short"), (201, None, good(1)), (202, "", good(2)), (203, None, None), (204, "good", "")]
    rows += [(300 + i, f"other{i % 8}", good(i) if i % 9 else "short") for i in range(80)]
    return rows


def test_judge_and_keep(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "s", "x") for r in rows], "doc_id long, source string, text string, stats string, bad string")
    got = {r["doc_id"]: r for r in hq.judge(df).collect()}
    assert set(got) == {r[0] for r in rows}
    fails, docs = {}, {}
    for i, host, text in rows:
        stats = brute_stats(text)
        failed = stats[0] < 50 or 100 * stats[4] > 50 * stats[0]
        assert tuple(got[i][c] for c in hq.STATS) == stats and got[i]["base_failed"] == failed
        if host:
            docs[host] = docs.get(host, 0) + 1
            fails[host] = fails.get(host, 0) + (failed or 100 * stats[2] > 10 * stats[1] or stats[3] > 20)
    rates = [fails[h] / docs[h] for h in docs]
    mean = sum(rates) / len(rates)
    var = sum((r - mean) ** 2 for r in rates) / len(rates)
    strength = min(1000.0, max(2.0, mean * (1 - mean) / var - 1))
    bad = {h for h in docs if (fails[h] + mean * strength) / (docs[h] + strength) > hq.HOST_RATE}
    assert "bad" in bad and "good" not in bad
    assert {i for i in got if got[i]["kept"]} == {i for i, h, t in rows if not got[i]["base_failed"] and h not in bad}
    kept = hq.keep_good(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i]["kept"]}


def test_one_document_does_not_condemn_a_host(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    rates = {r["host"]: r["rate"] for r in hq.host_rates(hq.document_stats(df), "source").collect()}
    assert rates["tiny"] < 1.0 and rates["tiny"] < rates["bad"]


def test_empty_and_repeated(spark):
    schema = "doc_id long, source string, text string"
    df = spark.createDataFrame([(1, "h", "a b")] * 3, schema)
    assert [r["kept"] for r in hq.judge(df).collect()] == [False] * 3
    assert hq.judge(df.limit(0)).collect() == [] and hq.keep_good(df.limit(0)).collect() == []
