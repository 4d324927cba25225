"""Slice-and-intersect nearest entries and codebooks against plain loops over Python integers."""
import math
import random

import numpy as np

from latticeguard.llm import vectorcode as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code int"


def brute(rows, parts=8, entries=16, rounds=6):
    """codes, errors and codebooks by exhaustive search."""
    kept = [(i, [min(max(math.floor(4096 * x), -vc.LARGEST), vc.LARGEST) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], ""
    length = len(kept[0][1])
    at = [length * p // parts for p in range(parts + 1)]
    alike = [r for r in kept if len(r[1]) == length]
    books = [[r[1][a:b] for r in alike[:entries]] for a, b in zip(at, at[1:])]

    def near(p, vector):
        part = vector[at[p]:at[p + 1]]
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in alike:
                groups.setdefault(near(p, v)[1], []).append(v[at[p]:at[p + 1]])
            books[p] = [[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[p])]
    out = []
    for i, v, label in kept:
        found = [near(p, v) for p in range(parts)] if len(v) == length else None
        out.append((i, label, "".join(f"{e:02x}" for _, e in found) if found else None, sum(d for d, _ in found) if found else None))
    return out, ",".join(str(x) for book in books for e in book for x in e)


def run(spark, rows):
    books, coded = vc.compress(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA))
    out = vc.label_errors(coded).collect()
    return sorted(((r["vec_id"], r["label"], r["_code"], r["error"], r["label_error"]) for r in out), key=str), vc.spelt(books)


def check(spark, rows):
    got, digest = run(spark, rows)
    expected, books = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows])
    totals = {}
    for _, label, _, error in expected:
        if error is not None:
            totals[label] = totals.get(label, 0) + error
    assert digest == books
    assert got == sorted(((i, label, c, e, totals.get(label)) for i, label, c, e in expected), key=str)


def vectors(n, length, seed, step=0.25):
    rnd = random.Random(seed)
    return [(i, [rnd.randint(-6, 6) * step for _ in range(length)], rnd.choice((1, 1, 1, 2, None))) for i in range(n)]


def test_codes_equal_exhaustive_search(spark):
    check(spark, vectors(300, 16, 1))  # a coarse grid: many ties
    check(spark, vectors(120, 24, 2, 0.001))


def test_edges(spark):
    odd = vectors(40, 16, 3)
    odd += [(7, [0.5] * 16, 1), (7, [0.5] * 16, 1), (None, [0.25] * 16, None), (90, None, 1), (91, [None] * 16, 1),
            (92, [float("nan")] * 16, 1), (93, [float("inf")] + [0.0] * 15, 2), (94, [1e30] * 16, 2), (95, [1.0], 3), (96, [], 3)]
    check(spark, odd)
    check(spark, vectors(5, 8, 4))  # fewer vectors than entries
    check(spark, vectors(30, 11, 5))  # parts of unequal width
    check(spark, vectors(20, 3, 6))  # parts without a dimension
    assert run(spark, []) == ([], "")
    check(spark, [(1, None, 1)])


def test_hot_and_rare_labels_sum_alike(spark, monkeypatch):
    rows = vectors(200, 8, 8)
    before = run(spark, rows)
    monkeypatch.setattr(vc, "HOT_SHARE", 2.0)
    assert run(spark, rows) == before


def test_candidates_hold_all_nearest_and_cut_the_rest():
    rnd = np.random.default_rng(9)
    book = rnd.integers(-4000, 4000, (16, 8))
    parts = book[rnd.integers(0, 16, 4000)] + rnd.integers(-300, 300, (4000, 8))
    slices = vc.Slices(book)
    masks = slices.candidates(parts)
    distances = ((parts[:, None] - book[None]) ** 2).sum(2)
    least = distances.min(1)
    index, found = slices.nearest(parts)
    assert (found == least).all() and (index == distances.argmin(1)).all()
    for e in range(16):
        assert (masks[distances[:, e] == least] >> np.uint64(e) & np.uint64(1)).all()
    counted = sum((masks >> np.uint64(e) & np.uint64(1)).sum() for e in range(16))
    assert counted < 0.6 * 16 * len(parts)
    wide = rnd.integers(-5, 5, (64, 3))
    index, found = vc.Slices(wide).nearest(parts[:500, :3])
    assert (index == ((parts[:500, None, :3] - wide[None]) ** 2).sum(2).argmin(1)).all()
