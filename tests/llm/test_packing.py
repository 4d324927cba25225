"""Packing: exact cover of every document's ids, capacities, padding; differencing on its own."""
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from latticeguard.llm import bpe, packing

ODD = ["", " ", "  a", " a b", "a  b", "a \n b", "a\n\n b", "<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>y z", "日本 語 text",
       "é È\t", "a ", "\n", "don't I'll we 're", "a \u0085b", "😀 😀😀", "12345 678 9 0a", "...  ,,,\r\n x", "  a  b"]


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path(packing.bpe.TOKENIZER))


def test_ids_are_the_tokenizers(exact):
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice(["a", "Be", " ", " ", "\n", ".", "é", "ß ", "1", "日", "<|endoftext|>", "  "])
                           for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    for again in range(2):  # the second time from memory
        got = [np.frombuffer(b, "<u4").tolist() for b in bpe.encoder().encode(texts)]
        assert got == [exact.encode(t, add_special_tokens=False).ids for t in texts], again


def test_pack_documents(spark, exact):
    rnd = random.Random(2)
    texts = ODD + [None, "x " * 6000] + [" ".join(f"w{rnd.randrange(900)}" for _ in range(rnd.randint(1, 900))) for _ in range(150)]
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    out = packing.pack_documents(df).collect()
    ids = {i: np.array(exact.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t, _ in rows}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in out:
        raw = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(raw) == r["length"] > 0 and zlib.crc32(raw.tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for i in ids:
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at
            at += length
        assert at == len(ids[i])
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    used = sum(map(len, ids.values()))
    assert used > 0.96 * packing.CAPACITY * len(windows)
    assert packing.pack_documents(df.limit(0)).collect() == []


def test_repeated_rows_are_packed_each(spark):
    df = spark.createDataFrame([(1, "a b c")] * 5, "doc_id long, text string")
    assert packing.pack_documents(df).count() == 5


def test_differencing_is_near_equal_and_count_rises():
    rnd = random.Random(3)
    sizes = [rnd.randint(1, 400) for _ in range(120)]
    parts = packing.differencing(sizes, 8)
    assert sorted(i for p in parts for i in p) == list(range(120))
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert max(sums) - min(sums) <= 20
    assert len(packing.pack([600] * 5)) == 5  # three windows would do by sum, and exceed the capacity
    assert packing.pack([]) == [] and packing.pack([1024, 1]) in ([[0], [1]], [[1], [0]])


def test_rest_pieces():
    for rest in (0, 1, 15, 16, 17, 511, 512, 513, 1023):
        for fine in (False, True):
            sizes = packing.rest_pieces(rest, fine=fine)
            assert sum(sizes) == rest and all(0 < s <= packing.PIECE for s in sizes)
