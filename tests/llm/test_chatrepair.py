"""Role repair: least cost against a search, one conversation over many tasks, rendering."""
import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from latticeguard.llm import chatrepair as cr

SCHEMA = "conv_id long, turn long, role string, text string, piece string"
COST = {"keep": 0, "relabel": cr.RELABEL, "insert": cr.INSERT}


def least_cost(roles):
    """Dijkstra over (source turns taken, state)."""
    done, queue = set(), [(0, 0, cr.START)]
    while queue:
        cost, i, state = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(roles) and state == cr.ASSISTANT:
            return cost
        for after in {cr.START: (1, 2), 1: (2,), 2: (3,), 3: (2,)}[state]:
            heapq.heappush(queue, (cost + cr.INSERT, i, after))
            if i < len(roles):
                heapq.heappush(queue, (cost + (roles[i] != cr.ROLES[after - 1]) * cr.RELABEL, i + 1, after))
        if i < len(roles) and state:
            heapq.heappush(queue, (cost + cr.MERGE + (roles[i] != cr.ROLES[state - 1]) * cr.RELABEL, i + 1, state))
    raise AssertionError


def random_roles(rnd, n):
    return [rnd.choice(["system", "user", "assistant", "user", "assistant", None]) for _ in range(n)]


def test_repair_is_cheapest_and_chains_agree():
    rnd = random.Random(4)
    for _ in range(1500):
        roles = random_roles(rnd, rnd.randint(1, 9))
        cost, steps, tail = cr.repair(roles)
        assert cost == least_cost(roles)
        cut = sorted(rnd.choices(range(len(roles) + 1), k=2))
        runs = [roles[:cut[0]], roles[cut[0]:cut[1]], roles[cut[1]:]]
        solved = cr.solve_chain([cr.run_matrix(r) for r in runs])
        again = [s for r, (a, b, _) in zip(runs, solved, strict=True) for s in cr.repair_run(r, a, b)]
        turns = lambda some: sum(len(i) + (a != "merge") for i, a, _ in some)
        assert turns(again) == turns(steps)
        assert [t for *_, t in solved] == [turns(again[:c]) for c in (0, *cut)]


def check(rows, source):
    """The rows of one conversation against its source (role, text) in order."""
    rows = sorted(rows, key=lambda r: r["seq"])
    assert len({r["seq"] for r in rows}) == len(rows)
    cost, state, kept = 0, None, []
    for r in rows:
        if r["action"] == "insert":
            cost += cr.INSERT
        else:
            role = cr.known_role(source[len(kept)][0])
            same = role == r["role"]
            cost += (cr.MERGE if r["action"] == "merge" else 0) + (0 if same else cr.RELABEL)
            kept.append(r)
    assert cost == least_cost([cr.known_role(role) for role, _ in source])
    text = "".join(r["piece"] for r in rows)
    turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, re.S)
    assert "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in turns) == text
    roles = [a for a, _ in turns]
    start = roles[1:] if roles[0] == "system" else roles
    assert start == ["user", "assistant"] * (len(start) // 2) and start
    assert [r["out_turn"] for r in rows] == sorted(r["out_turn"] for r in rows)
    assert {r["out_turn"] for r in rows} == set(range(len(turns)))
    assert [x for _, b in turns for x in b.split(cr.GLUE) if x] == [t for _, t in source if t]


@pytest.mark.parametrize("hot", [False, True])
def test_conversations(spark, hot):
    rnd = random.Random(hot)
    rows = []
    for conv in range(40):
        for turn in range(1500 if hot and conv == 7 else rnd.randint(1, 9)):
            rows.append((conv if conv else None, turn, rnd.choice(["system", "user", "Assistant ", "user", "assistant", None, "bot"]),
                         rnd.choice([None, "", f"t{conv}-{turn}"]), "x"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    out = cr.repair_conversations(df)
    assert out.columns == ["conv_id", "seq", "out_turn", "turn", "role", "action", "piece"]
    by = {}
    for r in out.collect():
        by.setdefault(r["conv_id"], []).append(r)
    assert set(by) == {r[0] for r in rows}
    for conv, got in by.items():
        check(got, [(r[2], r[3]) for r in rows if r[0] == conv])


def test_ties_repeated_rows_null_turns_and_empty_table(spark):
    rows = [(1, None, "user", "a", ""), (1, None, "user", "a", ""), (1, 3, "assistant", "b", ""), (1, 3, "assistant", "b", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = cr.repair_conversations(df).collect()
    check(got, [("user", "a"), ("user", "a"), ("assistant", "b"), ("assistant", "b")])
    assert cr.repair_conversations(df.limit(0)).collect() == []


def test_result_does_not_depend_on_partitioning(spark):
    rnd = random.Random(8)
    rows = [(conv, turn, rnd.choice(["system", "user", "assistant", "bot"]), f"t{conv}-{turn}", "x")
            for conv in range(12) for turn in range(400 if conv == 5 else rnd.randint(1, 9))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    before, results = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (2, 5, 16):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(map(tuple, cr.repair_conversations(df).collect()), key=str))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_query_covers_every_turn(spark):
    from latticeguard.llm.queries import op6_chat_repair

    source = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = op6_chat_repair(spark, "/root/testdata/sf0.001")
    rows = {}
    for r in got.collect():
        rows.setdefault(r["conv_id"], []).append(r)
    texts = {}
    for r in source.orderBy("conv_id", F.asc_nulls_first("turn"), "role", F.xxhash64("text")).collect():
        texts.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert set(rows) == set(texts)
    for conv in rows:
        check(rows[conv], texts[conv])
