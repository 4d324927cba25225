"""Prefix-programmed BPE against the tokenizer file itself, and exact round trips."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from latticeguard.llm import bpecodec as bc
from latticeguard.llm import queries

ENDING = "<|endoftext|>"


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path(bc.TOKENIZER))


def ids_of(exact, text):
    return exact.encode(text, add_special_tokens=False).ids


def test_every_token_and_random_texts(exact):
    codec, rnd = bc.Codec(), random.Random(4)
    for token, raw in enumerate(codec.bytes):
        assert codec.piece(raw) == [token]
    letters = "aeinsth é日\n\t 1239.,'’—😀\x1c\x85\xa0Ǆ͸"
    for n in range(6000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 40)))
        if n % 5 == 0:
            text = text.replace("n", ENDING)
        ids = ids_of(exact, text)
        assert codec.encode(text) == bc.packed(ids), text
        assert codec.decode(bc.packed(ids)) == exact.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    codec = bc.codec()
    whole = Tokenizer.from_file(public_tokenizers.path(bc.TOKENIZER)) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = whole
    assert codec.encode(text) == bc.packed(ids_of(whole, text))
    assert codec.decode(codec.encode(text)) == text


@pytest.mark.parametrize("text", ["a" * 200_000, "ab" * 50_000, " " * 30_000, "\n \t" * 20_000, "é" * 30_000, "日本" * 9_000,
                                  "1234567890" * 5_000, ENDING * 500, "x " * 50_000])
def test_very_long_pieces(exact, text):
    codec = bc.codec()
    assert codec.encode(text) == bc.packed(ids_of(exact, text)) and codec.decode(codec.encode(text)) == text


def test_prefixes_hold_the_unique_last_token(exact):
    """The stored token of every prefix is the last one of that prefix's own encoding."""
    codec = bc.codec()
    for word in (b" unbelievably", b"internationalisation", b" aaaabaaab", "größeres".encode()):
        last = codec._last_tokens(word)
        for end in range(1, len(word) + 1):
            assert last[end] == codec.piece(word[:end])[-1]
        assert codec.piece(word) == ids_of(exact, word.decode())


def test_characters_that_all_versions_agree_on(exact):
    """Where the pattern is used instead of the tokenizer's own cutter, both cut alike."""
    codec = bc.codec()
    for point in [*range(1, 0x530), *range(0x2010, 0x2028), 0x20AC]:
        char = chr(point)
        text = f"a{char}1{char}.{char} {char}"
        assert codec.pieces(text) == [text[a:b] for _, (a, b) in codec.cutter.pre_tokenize_str(text)], hex(point)


def test_forgetting_changes_nothing(exact, monkeypatch):
    for limit in ("WORDS", "PIECES", "SEAMS"):
        monkeypatch.setattr(bc, limit, 5)
    codec = bc.Codec()
    for text in ("the cat sat on the mat again and again, the cat", "unbelievable words: unbelievable"):
        for _ in range(3):
            assert codec.encode(text) == bc.packed(ids_of(exact, text))


def test_broken_and_unknown_ids(exact):
    codec = bc.codec()
    half = codec.piece("é".encode())
    broken = [codec.tokens["日".encode()[:1]], *half]
    assert codec.decode(bc.packed(broken)) == exact.decode(broken, skip_special_tokens=False)
    assert codec.decode(bc.packed([70_000, *half])) == "é" and codec.decode(None) == codec.decode(b"") == ""


def test_query_and_edges(spark, exact):
    got = {r["doc_id"]: r for r in queries.op13_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        text = r["text"] or ""
        ids = ids_of(exact, text)
        assert got[r["doc_id"]][1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                        hashlib.sha256(text.encode()).hexdigest())
    odd = spark.createDataFrame([(1, None, 5, 1), (2, "", 5, 1), (3, "a b", 5, 1), (3, "a b", 5, 1), (None, "a b", 5, 1)],
                                "doc_id long, text string, ids int, decoded int")
    out = bc.decode(bc.encode(odd), "_ids")
    assert out.columns == ["doc_id", "text", "ids", "decoded", "_ids", "_decoded"]
    rows = out.collect()
    assert len(rows) == 5 and [bytes(r["_ids"]) for r in rows[:2]] == [b"", b""]
    assert all(r["_decoded"] == "a b" and bytes(r["_ids"]) == bc.packed(ids_of(exact, "a b")) for r in rows[2:])
    assert bc.decode(bc.encode(odd.limit(0)), "_ids").collect() == []


def test_a_words_letters_are_kept_once(exact):
    codec = bc.Codec()
    text = "a blorpth blorpth, blorpth. x² x_y éléph, éléph 12, x"
    for _ in range(2):
        assert codec.encode(text) == bc.packed(ids_of(exact, text))
    assert " blorpth" not in codec.known and "blorpth" in codec.words and "éléph" in codec.words
