"""Count-only Viterbi against the public unigram tokenizer over the same vocabulary."""
import random

import pytest
from tokenizers import Tokenizer, models, normalizers

from latticeguard.llm import tokencount as tc


@pytest.fixture(scope="module")
def exact():
    scores = tc.unigram_scores()
    vocabulary = [("<unk>", -0.5), *((f"<0x{b:02X}>", -0.5) for b in range(256)), *((p, s / tc.STEPS) for p, s in scores.items())]
    made = Tokenizer(models.Unigram(vocabulary, 0, True))
    made.normalizer = normalizers.Sequence([normalizers.Replace(" ", tc.BLANK), normalizers.Prepend(tc.BLANK)])
    return made


def texts():
    rnd = random.Random(1)
    out = ["", " ", "a  b", "   x ", "\n\n日本 \x00", "▁a ▁", "x" * 300, "é" * 50 + " " * 40, "😀 ok", "a ▁ ▁ b", "the house", "a" * 5000]
    for _ in range(1500):
        out.append("".join(rnd.choice("abeinst é▁日\n") for _ in range(rnd.randint(1, 40))))
    return out


def test_counts_equal_the_tokenizer(exact):
    counter = tc.Counter(tc.unigram_scores())
    for _ in range(2):  # the second time from memory
        for text in texts():
            assert counter.count(text)[1] == len(exact.encode(text, add_special_tokens=False).ids), text


def test_segments_add_up():
    counter = tc.Counter(tc.unigram_scores())
    for text in texts()[:300]:
        if text:
            whole = counter.viterbi(tc.BLANK + text.replace(" ", tc.BLANK))
            assert counter.count(text) == whole


def test_tie_keeps_the_earlier_start():
    counter = tc.Counter({"▁": -5, "a": -1, "b": -1, "ab": -2, "c": -4})
    assert counter.viterbi("ab") == (-2, 1) and counter.viterbi("▁ab") == (-7, 2)


def test_real_texts_and_edges(spark, exact):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in tc.count_tokens(docs).collect()}
    for r in docs.collect():
        assert got[r["doc_id"]]["n_tokens"] == len(exact.encode(r["text"], add_special_tokens=False).ids)
    odd = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "a", 5), (3, "a", 5)], "doc_id long, text string, n_tokens int")
    out = tc.count_tokens(odd)
    assert out.columns == ["doc_id", "text", "n_tokens", "_n_tokens", "token_score"]
    rows = {r["doc_id"]: (r["_n_tokens"], r["token_score"]) for r in out.collect()}
    assert rows[1] == rows[2] == (0, 0.0) and rows[3][0] == 1 and rows[3][1] < 0
    assert tc.count_tokens(odd.limit(0)).collect() == []
