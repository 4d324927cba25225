"""URL filters: parts, exact cascades, verdicts against plain Python, both ways of looking up."""
import random

import pytest
from pyspark.sql import functions as F

from latticeguard.llm import urlfilter as uf

URLS = [None, "", "no scheme/org/", "http://", "http://A.Example.ORG/es/1", "https://example.org/en/12?q=/es/", "ftp://x.org", "http://x.org/",
        "http://notexample.org/es/", "http://a.b.c.com/fr/x#y", "http://com/de/", "http://u:p@h.com:80/de/1", "http://x.net/en/1",
        "http://casino-win.example.net/x", "http://www.casino-win.example.net", "http://free-bets.com/fr/", "http://casinos.net/",
        "x://y://example.org/en/1", "http://example.org?/es/", "http://example.org/en/1", "http://a..org/é", "http://spam.net/" + "p" * 5000,
        "http://" + "a." * 300 + "org/", "http://EXAMPLE.org/ES/", "http://ADULT-x.org/"]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    tail = rest[cut:]
    stop = min([i for i in (tail.find(c) for c in "?#") if i >= 0], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:stop]


def brute(url):
    host, path = parts(url)
    best = None
    for verdict, rule in uf.RULES:
        rule_host, rule_path = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    if best:
        return host, path, best[1], best[0]
    labels = host.split(".")[:-1]
    listed = any(w == word for label in labels for word in label.split("-") for w in uf.LISTED_WORDS)
    return host, path, None, "block" if listed else "allow"


@pytest.mark.parametrize("max_bits", [uf.MAX_BITS, 8])  # 8: every list is too large for a cascade
def test_verdicts_equal_brute_force(spark, max_bits):
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, best string")
    listed = uf.listed_hosts(df)
    out = uf.verdicts(df, uf.RULES, listed, max_bits=max_bits)
    assert out.columns == ["page_id", "url", "host", "best", "_host", "path", "rule", "verdict"]
    got = {r["page_id"]: (r["_host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS * 2)}


def test_cascade_is_exact_over_the_universe(spark):
    rnd = random.Random(0)
    listed = {f"k{i}" for i in rnd.sample(range(20_000), 3000)}
    universe = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    cascade = uf.build(universe, spark.createDataFrame([(k,) for k in sorted(listed)] + [("not there",)], "key string"))
    assert len(cascade.levels) >= 2  # the first level has false positives
    assert {r["key"] for r in universe.where(cascade.lists(F.col("key"))).collect()} == listed
    assert cascade.levels[0].bits <= 2 * uf.BITS_PER_KEY * len(listed)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = spark.createDataFrame([], "key string")
    assert uf.verdicts(df.limit(0), uf.RULES, none).collect() == []
    (row,) = uf.verdicts(df, [("block", "net/")], none).collect()
    assert (row["rule"], row["verdict"]) == (None, "allow")
