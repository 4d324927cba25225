"""SimHash near-dedup against plain Python, all pairs."""
import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from latticeguard.llm import simhash
from latticeguard.llm.common import dealt_join
from latticeguard.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, component string"


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits=4):
    parent = {k: k for k in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(fps), 2):
        if bin(fps[a] ^ fps[b]).count("1") <= max_bits:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in fps}


def texts():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(n)) for n in (3, 40, 300, 600, 1500, 20_000)]
    out = [None, "", " \n\t ", "One", "one", "É b c d e", "é b c d e", "a b c d e"]
    for text in base:
        out += [text, text, text.upper()]
        for _ in range(6):
            changed = text.split(" ")
            for _ in range(max(1, len(changed) // 150)):
                changed[rnd.randrange(len(changed))] = rnd.choice(words)
            out.append(" ".join(changed))
    return out


def test_near_duplicates_equal_brute_force(spark):
    rows = [(i * 3 + 1, t, "x", "y") for i, t in enumerate(texts())]
    rnd = random.Random(1)
    rnd.shuffle(rows)
    got = {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component"])
           for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    fps = {d: brute_fingerprint(t) for d, t, *_ in rows}
    assert {d: f for d, (f, _) in got.items()} == fps
    assert {d: c for d, (_, c) in got.items()} == brute_components(fps)
    assert len(set(brute_components(fps).values())) < len(set(fps.values()))  # links between different texts exist


@pytest.mark.parametrize("max_bits, segments", [(4, 3), (4, 4), (4, 2), (3, 4), (5, 3), (0, 2)])
def test_links_lose_nothing(spark, max_bits, segments):
    rnd = random.Random(max_bits)
    centres = [rnd.getrandbits(64) for _ in range(12)]
    values = {0, (1 << 64) - 1}
    for c in centres:
        for _ in range(25):
            values.add(c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))))
    fps = {v: v for v in values}
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    for block in (simhash.BLOCK, 16):  # 16: hot buckets are cut into pairs of blocks
        edges = simhash.links(df, max_bits, segments, block)
        got = {r["node"] & (1 << 64) - 1: r["component"] for r in connected_components(edges).collect()}
        want = brute_components(fps, max_bits)
        groups = lambda of: {frozenset(k for k in of if of[k] == c) for c in of.values()}
        assert {g for g in groups(got) if len(g) > 1} == {g for g in groups(want) if len(g) > 1}


def test_hot_bucket_makes_no_pairs(spark):
    rnd = random.Random(2)
    centre = rnd.getrandbits(64)
    values = {centre ^ sum(1 << b for b in rnd.sample(range(64), 2)) for _ in range(1500)}
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    n = simhash.links(df).count()
    assert n < 60 * len(values)  # all pairs would be some 400 a value
    assert len({r["component"] for r in connected_components(simhash.links(df)).collect()}) == 1


def test_drop_keeps_one_of_each_group(spark):
    rows = [(5, "a b c d e f g", "p", "q"), (3, "A b c d e f g", "p", "q"), (9, "z y x w v u", "p", "q"),
            (9, "z y x w v u", "p", "q"), (None, "a b c d e f g", "p", "q"), (11, None, None, None), (12, "", "p", "q")]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [(False, 3), (False, 9), (False, 11), (True, None)]
    assert simhash.drop_near_duplicates(df.limit(0)).count() == 0
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_rows_are_named_by_key_and_text(spark):
    a, b, c, d = "a b c d e f g", "z y x w v u", "one two three four five", "six seven eight nine"
    rows = [(1, a), (2, a.upper()), (2, b), (2, b), (3, c), (3, d), (3, d), (4, d), (5, c), (5, c.upper()), (5, "k l m n o p"),
            (6, "u v w q"), (6, "U v w q"), (None, a), (None, a), (None, "h i j k"), (None, "h i j k"), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = [(r["doc_id"], (r["text"] or "").lower()) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(1, a), (2, b), (3, c), (3, d), (5, "k l m n o p"), (6, "u v w q"), (None, a),
                                           (None, "h i j k"), (None, "")], key=str)


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


def test_segment_plan_covers_by_pigeonhole():
    rnd = random.Random(3)
    for max_bits, segments in ((4, 3), (4, 4), (5, 2), (3, 3)):
        plan = simhash.segment_plan(max_bits, segments)
        for _ in range(2000):
            error = sum(1 << b for b in rnd.sample(range(64), max_bits))
            assert any((error >> low & (1 << width) - 1).bit_count() <= radius for low, width, radius in plan)


def test_pieces_run_on_spark(spark):
    assert simhash.with_fingerprint(spark.range(1).select(F.lit("a b").alias("text"))).first()["fp"] == int(
        np.uint64(xxhash.xxh64_intdigest(b"a b", 42)).view(np.int64))


def test_long_text_crosses_hash_blocks():
    rnd = random.Random(8)
    text = " ".join(f"w{rnd.randrange(300)}" for _ in range(simhash._SHINGLES_AT_ONCE + 9000))
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_segments_follow_the_number_of_fingerprints():
    assert simhash.segments_for(0, 4) == simhash.segments_for(10**9, 4) == 3
    assert simhash.segments_for(10**11, 4) == 2
    assert simhash.segments_for(10**6, 4, (5, 4, 3, 2)) in (5, 4)


@pytest.mark.parametrize("at_least", [1, 7, 1000])
def test_buckets_are_cut_only_at_their_ends(at_least):
    rnd = random.Random(at_least)
    rows = sorted((rnd.randrange(9), rnd.randrange(3), i) for i in range(200))
    batches = [pa.RecordBatch.from_pylist([{"b": b, "p": p, "f": f} for b, p, f in rows[i:i + 11]]) for i in range(0, 200, 11)]
    parts = [list(zip(*(c.tolist() for c in part), strict=True)) for part in simhash.whole_buckets(iter(batches), at_least)]
    assert [r for part in parts for r in part] == rows
    assert all(a[-1][:2] != b[0][:2] for a, b in zip(parts, parts[1:], strict=False))
    assert list(simhash.whole_buckets(iter([]), at_least)) == []


def test_dealt_join_equals_the_plain_one(spark):
    many = spark.createDataFrame([(1, i) for i in range(900)] + [(2, 1), (3, None), (None, 5)], "k int, x int")
    one = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d"), (None, "n")], "k int, v string")
    assert sorted(map(tuple, dealt_join(many, one, "k", "x").select("k", "x", "v").collect())) == sorted(
        map(tuple, many.join(one, "k").select("k", "x", "v").collect()))
