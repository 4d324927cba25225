"""Spaced-seed decontamination: sensitivity of the masks, and results against all diagonals."""
import random
from collections import Counter
from itertools import combinations

import numpy as np

from latticeguard.llm import decontaminate as dc


def test_masks_hit_every_accepted_overlap():
    for size, errors in ((13, 0), (14, 1), (15, 2), (16, 3)):
        for wrong in combinations(range(size), errors):
            bad = set(wrong)
            assert any(all(at + i not in bad for i, bit in enumerate(mask) if bit == "1")
                       for mask in dc.MASKS for at in range(size - len(mask) + 1))


def fewest_errors_without_hit(masks, upto):
    """length -> fewest wrong tokens that leave no window of any mask intact (over the last error bits)."""
    width = max(map(len, masks))
    shapes = [(len(m), int(m, 2)) for m in masks]
    states, fewest = {0: 0}, {}
    for n in range(1, upto + 1):
        after = {}
        for last, errors in states.items():
            for wrong in (0, 1):
                bits = (last << 1 | wrong) & ((1 << width) - 1)
                if not any(n >= size and not bits & shape for size, shape in shapes):
                    after[bits] = min(after.get(bits, n), errors + wrong)
        states = after
        fewest[n] = min(states.values())
    return fewest


def test_masks_hit_every_accepted_overlap_of_any_length():
    for size, errors in fewest_errors_without_hit(dc.MASKS, 120).items():
        assert size - errors < dc.MIN_MATCH or (size - errors) / size < dc.IDENTITY, (size, errors)


def test_four_middle_words_replaced(spark):
    item = [f"t{i}" for i in range(20)]
    docs = []
    for wrong in ((8, 9, 10, 11), (5, 9, 10, 11), (7, 9, 10, 11), (5, 9, 10, 15), (7, 9, 10, 15)):
        docs.append((len(docs), " ".join("x" if i in wrong else t for i, t in enumerate(item))))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = sorted((r["doc_id"], r["n_tokens"], r["n_matched"]) for r in dc.overlaps(d, bench).collect())
    assert got == [(i, 20, 16) for i in range(5)]


def brute(docs, bench):
    items = {}
    for i, text in bench:
        tokens = dc.token_hashes(text)
        if len(tokens) >= min(map(len, dc.MASKS)) and i is not None:
            items.setdefault(tokens.tobytes(), []).append(i)
    found = {}
    for d, text in docs:
        a = dc.token_hashes(text).view(np.int64)
        for raw, ids in items.items():
            b = np.frombuffer(raw, np.uint64).view(np.int64)
            equal = Counter(p - j for j, t in enumerate(b.tolist()) for p in np.flatnonzero(a == t).tolist())
            for g in (g for g, n in equal.items() if n >= min(dc.MIN_MATCH, len(b))):  # others can't be accepted
                v = dc.best_overlap(a, b, g)
                if v:
                    old = found.get((d, min(ids)))
                    key = (v[3], -v[0], -v[1])
                    if old is None or key > old[0]:
                        found[d, min(ids)] = (key, (*v, len(ids)))
    return {k: v for k, (_, v) in found.items()}


def fixture():
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(900)] + ["É", "straße", "日本"]
    text = lambda n: [rnd.choice(words) for _ in range(n)]
    bench = [text(n) for n in (9, 10, 12, 13, 20, 40, 59)]
    docs = []
    for item in bench:
        for errors in (0, 1, 2, 4, 8):
            copy = list(item)
            for at in rnd.sample(range(len(copy)), min(errors, len(copy))):
                copy[at] = "other"
            docs.append(text(rnd.randint(0, 60)) + copy + text(rnd.randint(0, 60)))
        docs.append(text(5) + item[2:] + text(5))
        docs.append(item[:len(item) // 2])
        docs.append(item + text(3) + item)  # twice
    docs += [text(300) for _ in range(20)] + [bench[5] + bench[6] + text(2000)]
    rows = [(i, (" , ".join(d) if i % 2 else "\n".join(d).upper())) for i, d in enumerate(docs)]
    items = [(i * 10, " ".join(b)) for i, b in enumerate(bench)] + [(777, " ".join(bench[4]) + " !"), (778, None), (779, ""), (780, "w1 w2")]
    return rows + [(1000, None), (1001, ""), (1002, "...")], items


def test_overlaps_equal_all_diagonals(spark):
    docs, bench = fixture()
    d = spark.createDataFrame([(*r, "x", "y") for r in docs], "doc_id long, text string, item string, context string").repartition(4)
    b = spark.createDataFrame([(*r, 1) for r in bench], "item_id long, text string, tokens int")
    got = {(r["doc_id"], r["item_id"]): (r["doc_start"], r["item_start"], r["n_tokens"], r["n_matched"], r["copies"])
           for r in dc.overlaps(d, b).collect()}
    want = brute(docs, bench)
    assert got == want and len(want) > 30
    kept = dc.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_repeated_rows_null_keys_and_empty_tables(spark):
    schema, bench_schema = "doc_id long, text string", "item_id long, text string"
    item = " ".join(f"t{i}" for i in range(30))
    docs = spark.createDataFrame([(1, item), (1, item), (None, item), (2, "clean")], schema)
    bench = spark.createDataFrame([(5, item), (4, item)], bench_schema)
    got = dc.overlaps(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"], r["copies"]) for r in got) == [(0, 4, 2), (1, 4, 2)]
    assert [r["doc_id"] for r in dc.drop_contaminated(docs, bench).collect()] == [2]
    clean = spark.createDataFrame([(None, "clean"), (None, None), (None, item), (7, item)], schema)
    assert sorted((r["text"] or "") for r in dc.drop_contaminated(clean, bench).collect()) == ["", "clean"]
    clash = clean.selectExpr("doc_id", "text", "1 AS gone", "2 AS gone_mark", "3 AS name", "4 AS key")
    left = dc.drop_contaminated(clash, bench)
    assert left.columns == clash.columns and left.count() == 2
    assert dc.overlaps(docs.limit(0), bench).collect() == [] and dc.overlaps(docs, bench.limit(0)).collect() == []
    assert dc.drop_contaminated(docs, bench.limit(0)).count() == 4


def test_long_text_crosses_scan_blocks(spark):
    item = [f"t{i}" for i in range(40)]
    text = " ".join(["filler"] * 300_000 + item + ["filler"] * 10)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    (row,) = dc.overlaps(docs, bench).collect()
    assert (row["doc_start"], row["n_matched"]) == (300_000, 40)


def n_tokens(text):
    return len(dc.token_hashes(text))


def test_tokens_are_unicode_words_and_single_characters_of_unspaced_scripts():
    def same(a, b):
        return dc.token_hashes(a).tolist() == dc.token_hashes(b).tolist()

    assert n_tokens("以下哪一项，是正确的？") == 9 and n_tokens("ひらがなカタカナー") == 9 and n_tokens("สวัสดี") == 6
    assert n_tokens("《红楼梦》、GPT4模型") == 6 and n_tokens("𠮷野家") == 3
    assert same("«\u00a0mot\u00a0» — l’eau…", '"Mot" - l\'eau...') and n_tokens("«\u00a0mot\u00a0»") == 1
    assert n_tokens("हिन्दी भाषा") == 2 and n_tokens("e\u0301te\u0301 STRASSE straße") == 3
    assert n_tokens("snake_case x\u200by 東\ufe00京") == 6 and n_tokens("“” — …") == 0


def test_unspaced_and_short_items_are_found(spark):
    chinese = "下列关于光合作用的说法中，哪一项是正确的？请从四个选项里选出最合适的一个，并说明你的理由。"
    french = "Le chat\u00a0: «\u00a0je dors\u00a0» — dit-il à l’ami qui passe, « demain » nous verrons bien le reste"
    short = ["eins", "zwei drei", "a b c", "vier fünf sechs sieben acht", "t1 t2 t3 t4 t5 t6 t7"]
    items = [chinese, french, *short, "Eins!"]
    plain = 'le chat: "je dors" - dit-il à l\'ami qui passe, "demain" nous verrons bien le reste'
    filler = " ".join(f"f{i}" for i in range(30))
    docs = [f"前言{chinese}后记", f"{filler} {plain}", "Zwei  DREI", f"eins {filler} eins", "zwei x drei einser", "a b", "a b a b c a b c",
            f"{filler} vier fünf sechs sieben acht t1 t2 t3 t4 t5 t6 t7", "t1 t2 t3 t4 t5 t6", "", None]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["doc_start"], r["n_tokens"], r["n_matched"], r["copies"]) for r in dc.overlaps(d, bench).collect()}
    assert got == {(0, 0): (2, n_tokens(chinese), n_tokens(chinese), 1), (1, 1): (30, n_tokens(french), n_tokens(french), 1),
                   (2, 3): (0, 2, 2, 1), (3, 2): (0, 1, 1, 2), (6, 4): (2, 3, 3, 1), (7, 5): (30, 5, 5, 1), (7, 6): (35, 7, 7, 1)}
    assert {r["doc_id"] for r in dc.drop_contaminated(d, bench).collect()} == {4, 5, 8, 9, 10}
    only = bench.where("item_id = 3")
    assert [tuple(r) for r in dc.overlaps(d, only).collect()] == [(2, 3, 1, 0, 0, 2, 2)]


def test_clean_namesake_of_a_contaminated_row_stays(spark):
    item = " ".join(f"t{i}" for i in range(30))
    docs = spark.createDataFrame([(1, item), (1, "clean"), (1, None), (2, f"x {item}")], "doc_id long, text string")
    bench = spark.createDataFrame([(4, item)], "item_id long, text string")
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["text"] for r in kept.collect()))) == ["None", "clean"]


def test_bitmap_grows_with_the_benchmark(spark, monkeypatch):
    assert dc.bitmap_power(0) == dc.bitmap_power(2_000_000) == 25
    assert dc.bitmap_power(2_100_000) == 26 and dc.bitmap_power(10**10) == 30
    docs, bench = fixture()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    want = sorted(map(tuple, dc.overlaps(d, b).collect()))
    for powers in ((6, 9), (6, 14)):  # nearly every window passes; most don't
        monkeypatch.setattr(dc, "BITMAP_POWERS", powers)
        assert sorted(map(tuple, dc.overlaps(d, b).collect())) == want


def test_short_item_beside_a_very_long_one(spark):
    long = [f"u{i}" for i in range(5000)]
    short = [f"v{i}" for i in range(20)]
    docs = [["x"] * 900 + short + ["y"] * 700 + long[100:400] + ["z"] * 30, long[4000:] + short, short[3:] + ["x"] * 10 + long]
    d = [(i, " ".join(t)) for i, t in enumerate(docs)]
    b = [(1, " ".join(long)), (2, " ".join(short))]
    got = {(r["doc_id"], r["item_id"]): (r["doc_start"], r["item_start"], r["n_tokens"], r["n_matched"], r["copies"])
           for r in dc.overlaps(spark.createDataFrame(d, "doc_id long, text string"),
                                spark.createDataFrame(b, "item_id long, text string")).collect()}
    assert got == {(0, 1): (1620, 100, 300, 300, 1), (0, 2): (900, 0, 20, 20, 1), (1, 1): (0, 4000, 1000, 1000, 1),
                   (1, 2): (1000, 0, 20, 20, 1), (2, 1): (27, 0, 5000, 5000, 1), (2, 2): (0, 3, 17, 17, 1)}
