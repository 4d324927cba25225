"""Closure, cycles and levels of cyclic graphs against plain searches."""
import random
from collections import deque

import pytest

from latticeguard.operators import reach


def search(edges, source):
    hops, queue = {}, deque((d, 1) for s, d in edges if s == source)
    while queue:
        node, n = queue.popleft()
        if node not in hops:
            hops[node] = n
            queue.extend((d, n + 1) for s, d in edges if s == node)
    return hops


def components(edges):
    nodes = {x for e in edges for x in e}
    seen = {n: search(edges, n) for n in nodes}
    return {n: min(o for o in seen[n] if n in seen[o]) for n in nodes if n in seen[n]}


def frame(spark, edges):
    return spark.createDataFrame(edges, "src long, dst long")


GRAPHS = {
    "two circles joined by a path": [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (6, 5), (6, 7), (8, 1)],
    "nested circles and a loop": [(1, 2), (2, 1), (2, 3), (3, 2), (9, 9), (9, 1), (3, 4), (4, 10), (10, 11), (11, 4), (4, 4)],
    "no circle": [(1, 2), (1, 3), (2, 4), (3, 4), (4, 5)],
}


@pytest.mark.parametrize("name", sorted(GRAPHS))
def test_named_graphs(spark, name):
    edges = GRAPHS[name]
    got = {(r["source"], r["node"]): r["hops"] for r in reach.reachable(
        frame(spark, [*edges, *edges[:2], (None, 1)]), spark.createDataFrame([(e[0],) for e in edges] + [(None,), (77,)], "x long")).collect()}
    assert got == {(s, n): h for s in {e[0] for e in edges} for n, h in search(edges, s).items()}
    assert {r["node"]: r["component"] for r in reach.cyclic_components(frame(spark, edges)).collect()} == components(edges)


def test_random_graph_components_and_levels(spark):
    rnd = random.Random(11)
    edges = list({(rnd.randint(0, 24), rnd.randint(0, 24)) for _ in range(34)})
    nodes = range(26)
    of = components(edges)
    rows = reach.component_levels(spark.createDataFrame([(n,) for n in nodes], "asset_id long"), frame(spark, edges)).collect()
    assert {r["asset_id"]: r["component"] for r in rows} == {n: of.get(n, n) for n in nodes}
    level = {r["component"]: r["level"] for r in rows}
    size = {c: sum(of.get(n, n) == c for n in nodes) for c in level}
    assert all(r["n_members"] == size[r["component"]] for r in rows)
    for c in level:
        below = [level[of.get(d, d)] for s, d in edges if of.get(s, s) == c and of.get(d, d) != c]
        assert level[c] == (max(below) + 1 if below else 0)


def test_nothing_to_follow(spark):
    none = frame(spark, [])
    assert reach.reachable(none, spark.createDataFrame([(1,)], "x long")).collect() == []
    assert reach.reachable(frame(spark, [(1, 2)]), spark.createDataFrame([], "x long")).collect() == []
    assert reach.cyclic_components(none).collect() == []


def written(spark, monkeypatch):
    """Rows of what is written from here on, by name."""
    rows, write = [], reach.materialize
    monkeypatch.setattr(reach, "materialize", lambda df, name: rows.append((name, (out := write(df, name)).count())) or out)
    return rows


def test_what_lies_behind_many_sources_is_searched_once(spark, monkeypatch):
    edges = [(100 + i, 1) for i in range(50)] + [(1, 2), (1, 3), (2, 4), (3, 4), (4, 1), (150, 4), (150, 2), (150, 1), (160, 160)]
    rows = written(spark, monkeypatch)
    sources = [(100 + i,) for i in range(51)] + [(1,), (160,), (4,), (999,)]
    got = {(r["source"], r["node"]): r["hops"] for r in reach.reachable(frame(spark, edges), spark.createDataFrame(sources, "x long")).collect()}
    assert got == {(s, n): h for (s,) in sources for n, h in search(edges, s).items()}
    assert max(n for name, n in rows if name.removeprefix("reach-").isdigit()) <= 10  # before: 50 sources in each


def test_a_chain_of_circles_is_found_at_once(spark, monkeypatch):
    pairs = [(10 * i, 10 * i + 1) for i in range(1, 6)]
    edges = [e for a, b in pairs for e in ((a, b), (b, a))] + [(10 * i + 11, 10 * i) for i in range(1, 5)]
    rows = written(spark, monkeypatch)
    assert {r["node"]: r["component"] for r in reach.cyclic_components(frame(spark, edges)).collect()} == components(edges)
    assert len([1 for name, _ in rows if name == "scc-taken"]) == 1  # before: a round for each
    back = [(d, s) for s, d in edges]  # the other way round it takes more rounds, and is as right
    assert {r["node"]: r["component"] for r in reach.cyclic_components(frame(spark, back)).collect()} == components(back)
