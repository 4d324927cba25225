"""Language identification: held-out accuracy, kernels against plain sets, edge cases."""
import random

import numpy as np
import pytest
import xxhash

from latticeguard.llm import langid

SF = "/root/testdata/sf0.01"
LETTERS = {"xx": "abcde", "yy": "cdefgé", "zz": "дежзи"}


def rows(n=60, seed=1):
    rnd = random.Random(seed)
    return [(i, " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(rnd.randint(3, 40))), lang)
            for i, (lang, letters) in enumerate(list(LETTERS.items()) * n)]


def test_grams_are_the_texts_ngrams():
    table, last = langid.letter_codes("abc"), langid.scratch()
    codes = langid.encode("Ab, \n cé日😀1a", table).tolist()
    assert codes == [0, 2, 3, 0, 4, 1, 1, 0, 2, 0]  # the emoji and the digit are no letters
    want = {tuple(codes[i:i + n]) for n in (1, 2, 3) for i in range(len(codes) - n + 1)}
    for _ in range(2):
        assert len(langid.grams(np.array(codes), last)) == len(want)
    assert len(langid.encode("12 34", table)) == 0 and len(langid.encode("", table)) == 0


def test_learns_and_predicts(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    model = langid.fit(df.unionByName(spark.createDataFrame([(1, None, "xx"), (2, "abc", None), (3, "12", "ww")], df.schema)))
    assert model.languages == ["xx", "yy", "zz"]
    test = spark.createDataFrame([(i, t, lang, "s") for i, t, lang in rows(30, 9)], "doc_id long, text string, score string, lang_pred string")
    out = langid.predict(test, model)
    assert out.columns == [*test.columns, "_lang_pred", "_score"]
    got = out.collect()
    assert sum(r["_lang_pred"] == r["score"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["_score"] <= 1 for r in got)


def brute_grams(text):
    """Strings of one to three characters of the words in lower case, one blank between and around them."""
    padded = f" {' '.join(text.lower().split())} "
    return {padded[i:i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)}


def brute_kernel(some, others):
    return np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in others] for a in some])


@pytest.mark.parametrize("landmarks", [128, 9])
def test_scores_equal_plain_kernel_ridge_regression(spark, monkeypatch, landmarks):
    """Regression over plain sets of strings, in its dual form: no bits, no packed codes, no root of the kernel."""
    monkeypatch.setattr(langid, "LANDMARKS", landmarks)
    train = sorted(rows(20, 4), key=lambda r: (r[2], xxhash.xxh64_intdigest(r[1], 42) + 2**63 & 2**64 - 1))
    sets, langs = [brute_grams(t) for _, t, _ in train], [lang for *_, lang in train]
    chosen = [g for lang in LETTERS for g in [s for s, own in zip(sets, langs, strict=True) if own == lang][:landmarks // 3]]
    k_all, k_own = brute_kernel(sets, chosen), brute_kernel(chosen, chosen)
    wanted = np.array([[float(own == lang) for lang in LETTERS] for own in langs])
    weights = np.linalg.solve(k_all.T @ k_all + langid.RIDGE * len(sets) * k_own, k_all.T @ wanted)

    model = langid.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    test = rows(10, 11)
    got = {r["doc_id"]: r for r in langid.predict(spark.createDataFrame(test, "doc_id long, text string, lang string"), model).collect()}
    for i, text, _ in test:
        values = (brute_kernel([brute_grams(text)], chosen) @ weights)[0]
        assert got[i]["lang_pred"] == list(LETTERS)[values.argmax()]
        assert got[i]["score"] == pytest.approx(min(1.0, max(0.0, values.max())), abs=1e-5)


def test_edges(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    model = langid.fit(df)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "日本"), (5, "abcde " * 50_000), (6, "abc"), (6, "abc")],
                                "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] in model.languages and got[5][0] == "xx"
    assert langid.predict(odd.limit(0), model).collect() == []
    empty = langid.fit(df.limit(0))
    assert empty.languages == [] and {r["lang_pred"] for r in langid.predict(odd, empty).collect()} == {"und"}


def test_query_holds_out_and_is_accurate(spark):
    import zlib

    from latticeguard.llm.queries import op2_language

    got = op2_language(spark, SF).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert {r["doc_id"] for r in got} == set(truth)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
