"""Personal data: base spans against plain regular expressions, what the trees may add, edge cases."""
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from latticeguard.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(s):
    return re.sub("[^0-9]", "", s)


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(_digits(s)) <= 19 and luhn(_digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(_digits(s)) <= 15)]


def brute(text):
    return [(k, m.start(), m.end()) for k, (_, p, ok) in enumerate(BASE) for m in re.finditer(p, text or "") if ok(m.group())]


def texts():
    rnd = random.Random(6)
    bits = ["a.b@c.de", "x@y", "@", "a@b.c.d_e@f.g", "x@y@w.com", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0000255.0.0.000",
            "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "4111 1111  1111 1111", "+1 (578) 555-6437",
            "+1-2", "+49 (0) 30 12345", "+", "(", "é", "日本", "😀", " ", "\n", "word", "call ", "12", "3" * 25, "1.1.1", "99.99.99.99 "]
    out = [None, "", " ", "a@b.cd", "x" * 50_000 + "@" + "y" * 50_000 + ".com", "1" * 60_000, "1 " * 30_000, "a@b" + ".c" * 20_000,
           "1." * 20_000, "+1" + " " * 40_000, "+1" + "(" * 40_000 + "2", "😀 a@b.cd 1.2.3.4 " * 1500]
    return out + ["".join(rnd.choice(bits) + rnd.choice(["", " ", ", "]) for _ in range(rnd.randint(1, 25))) for _ in range(300)]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, "b", "r") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string, row string")
    model = pii.fit(df)
    return df, model, {r["doc_id"]: r for r in pii.find(df, model=model).collect()}


def test_base_spans_equal_plain_patterns(found):
    df, _, got = found
    assert len(got) == df.count()
    for i, text in enumerate(texts()):
        assert [tuple(s) for s in got[i]["_base"]] == brute(text), text[:80]
        assert got[i]["base"] == "b" and got[i]["row"] == "r" and got[i]["text"] == text


def test_added_spans_overlap_no_base_span_nor_each_other(found):
    _, model, got = found
    assert model.trees and set(model.thresholds) == set(pii.KINDS)
    for r in got.values():
        base, spans = [tuple(s) for s in r["_base"]], [tuple(s) for s in r["spans"]]
        added = [s for s in spans if s not in base]
        assert spans == sorted(base + added)
        for k, s, e in added:
            assert all(e <= a or b <= s for j, a, b in spans if (j, a, b) != (k, s, e))


def test_the_trees_add_loose_forms_and_leave_clean_text(found, spark):
    _, model, _ = found
    rows = [(1, "write to jane.doe [at] mail [dot] example [dot] com now"), (2, "no data here at all, only words (and signs)."),
            (3, "version 1.2.3 of 10 items, 37 of them new")]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), model=model).collect()}
    assert [tuple(s) for s in got[1]] == [(0, 9, 51)] and got[2] == [] and got[3] == []


LOOSE = {"write to bob [at] example [dot] com now": (0, 9, 35), "mail anna (at) site.org please": (0, 5, 23),
         "call (030) 123-4567 today": (3, 5, 19), "tel 0049 30 1234567": (3, 4, 19), "call 555-123-4567": (3, 5, 17),
         "paid with 378282246310005 then": (2, 10, 25), "addr 10[.]0[.]0[.]1 up": (1, 5, 19)}
CLEAN = ["version 1.2.3 of 10 items", "order 378282246310005 came", "in 2024 10 11 2012 we had", "a 555-123-4567 part",
         "isbn 978-3-16-148410-0", "only words (and signs) at this. dot"]


@pytest.mark.parametrize("corpus", ["sf0.001", "sf0.01", "none"])
def test_loose_forms_are_found_under_any_fit(spark, corpus):
    docs = spark.createDataFrame([(1, "words only")], "doc_id long, text string") if corpus == "none" else (
        spark.read.parquet(f"/root/testdata/{corpus}/documents.parquet"))
    rows = [(i, t) for i, t in enumerate([*LOOSE, *CLEAN])]
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string"), model=pii.fit(docs)).collect()
    assert {r["text"]: [tuple(s) for s in r["spans"]] for r in got} == {
        **{t: [s] for t, s in LOOSE.items()}, **{t: [] for t in CLEAN}}


def test_many_proposals_in_one_text(found, spark):
    """80,000 proposals in one text: the time grows with their number, not with its square."""
    _, model, _ = found
    text = " ".join(f"call (030) 123-{1000 + i % 9000} and" for i in range(80_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.monotonic()
    (row,) = pii.find(df, model=model).select(F.size("spans").alias("n"), F.element_at("spans", -1).alias("last")).collect()
    assert row["n"] == 80_000 and tuple(row["last"]) == (3, len(text) - 18, len(text) - 4)
    assert time.monotonic() - start < 200  # a square law takes a quarter of an hour


def test_proposals_that_overlap(spark):
    """Counts of smaller bounds, as the selection takes them, against plain Python; repeated rows alike."""
    rnd = random.Random(3)
    rows = [(sorted(rnd.randrange(30) for _ in range(rnd.randrange(9))), sorted(rnd.randrange(30) for _ in range(rnd.randrange(9))))
            for _ in range(200)]
    df = spark.createDataFrame(rows + rows, "v array<long>, q array<long>")
    got = df.select("v", "q", pii._before(F.col("v"), F.col("q"), False).alias("less"),
                    pii._before(F.col("v"), F.col("q"), True).alias("upto")).collect()
    assert len(got) == 2 * len(rows)
    for r in got:
        assert r["less"] == [sum(v < q for v in r["v"]) for q in r["q"]]
        assert r["upto"] == [sum(v <= q for v in r["v"]) for q in r["q"]]


def test_redact_and_spelling(found, spark):
    _, model, _ = found
    df = spark.createDataFrame([(1, "é a@b.cd, 1.2.3.4!"), (2, None), (3, "")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in pii.redact(df, model=model).collect()} == {1: "é [EMAIL], [IP]!", 2: None, 3: ""}
    (row,) = pii.find(df.where("doc_id = 1"), model=model).select(pii.spelt(F.col("spans")).alias("s")).collect()
    assert row["s"] == "email:2:8,ip:10:17"


def test_empty_and_spanless_tables(spark):
    df = spark.createDataFrame([(1, "words only"), (2, None)], "doc_id long, text string")
    assert [r["spans"] for r in pii.find(df).collect()] == [[], []]
    assert pii.find(df.limit(0)).collect() == []
