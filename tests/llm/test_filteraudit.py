"""Filter audit against a document-by-document count over all orders."""
import random
import re
from collections import Counter
from itertools import permutations

from latticeguard.llm import filteraudit as fa

SCHEMA = "doc_id long, text string, lang string, part int, failed string"


def brute(docs, labels):
    """(part, order, step) -> counts, by applying each order to each document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for doc_id, text, lang, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, *_ in docs):
            fails.add("E")
        rows.append((lang or "", fails, doc_id in good, doc_id in toxic))
    out, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        for part in {r[0] for r in rows}:
            left = [r for r in rows if r[0] == part]
            alone = Counter(next(iter(f)) for _, f, _, _ in left if len(f) == 1)
            for step, name in enumerate(order):
                gone = [r for r in left if name in r[1]]
                failing = sum(name in r[1] for r in rows if r[0] == part)
                left = [r for r in left if name not in r[1]]
                out[part, "".join(order), step + 1] = [
                    len(left), len(gone), failing - len(gone), alone[name], sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[part, name] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def corpus(n, seed):
    rnd = random.Random(seed)
    docs = []
    for i in range(n):
        words = [rnd.choice("abcdefgh") + str(rnd.randint(0, rnd.choice((9, 500)))) for _ in range(rnd.choice((0, 5, 99, 100, 120)))]
        if rnd.random() < 0.3:
            words = [w.upper() for w in words]
        text = rnd.choice((" ", "\n", "  ")).join(words) + rnd.choice(("", "", "#", " é"))
        if rnd.random() < 0.3 and docs:
            text = rnd.choice(docs)[1]
        docs.append((rnd.choice((i, i, i, None, i // 2)), rnd.choice((text, text, None)) if i % 17 == 0 else text,
                     rnd.choice(("en", "en", "fr", None, "")), 7, "x"))
    labels = [(i, rnd.choice((0, 1, None)), rnd.choice((0, 1, None))) for i in range(0, n, 2)]
    return docs, labels


def got(spark, docs, labels):
    out = fa.audit(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = out.collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[3:]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_audit_equals_brute_force(spark, monkeypatch):
    docs, labels = corpus(250, 1)
    expected = brute(docs, labels)
    assert got(spark, docs, labels) == expected
    monkeypatch.setattr(fa, "RANGE", 7)
    assert got(spark, docs, labels) == expected


def test_edges(spark):
    assert got(spark, [], []) == {}
    long_text = "word " * 300_000
    docs = [(3, long_text, "en", 1, "x"), (5, long_text, "fr", 1, "x"), (5, long_text, "fr", 1, "x"), (None, None, None, 1, "x"),
            (None, "", None, 1, "x"), (6, "", "en", 1, "x")]
    labels = [(3, 1, 0), (3, 0, 1), (None, 1, 1), (5, None, None)]
    assert got(spark, docs, labels) == brute(docs, labels)


def test_posting_lists_are_sorted_and_whole(spark):
    docs, labels = corpus(300, 2)
    failed = fa.failures(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    ranges = fa.postings(failed).collect()
    assert sum(r["n"] for r in ranges) == len(docs)
    for r in ranges:
        for ids in [*r["lists"], r["good"], r["toxic"]]:
            assert ids == sorted(set(ids)) and all(0 <= i < r["n"] for i in ids)


def test_galloping_merges():
    rnd = random.Random(5)
    for _ in range(3000):
        lists = [sorted(rnd.sample(range(60), rnd.randint(0, rnd.choice((3, 50))))) for _ in range(rnd.randint(0, 5))]
        assert fa.union(lists) == sorted(set().union(*lists))
        for a in lists:
            for b in lists:
                assert fa.difference(a, b) == sorted(set(a) - set(b))
                assert fa.shared(a, b) == len(set(a) & set(b))
        ids = lists[0] if lists else []
        if ids:
            at, target = rnd.randrange(len(ids)), rnd.randint(0, 61)
            assert fa.gallop(ids, target, at) == next((i for i in range(at, len(ids)) if ids[i] >= target), len(ids))
