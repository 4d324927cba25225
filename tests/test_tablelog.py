"""Commit log: interleaved writers, writers that die, states in time; merges rewrite only what they change."""
import uuid

import pytest
from pyspark.sql import functions as F

from latticeguard.config import DEPLOYMENT, Policy
from latticeguard.operators import registry
from latticeguard.operators.registry import Ledger
from latticeguard.session import checkpoint_dir
from latticeguard.sources.tablelog import KeyedTable, State, TableLog

NOW = "2024-02-10 00:00:00"
SCHEMAS = {"a": "k long, v string", "b": "k long"}


def root(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/test-log-{uuid.uuid4().hex}"


@pytest.fixture
def log(spark):
    return TableLog(spark, root(spark), SCHEMAS)


def keys(frame):
    return sorted(r["k"] for r in frame.collect())


def test_a_change_of_two_tables_is_seen_whole_and_states_stay(spark, log):
    assert log.state() == State() and keys(log.read("a")) == []
    first = log.append(a=spark.createDataFrame([(1, "x")], SCHEMAS["a"]), b=spark.range(1).select(F.lit(7).alias("k")))
    log.append(a=spark.createDataFrame([(2, "y")], SCHEMAS["a"]))
    assert keys(log.read("a")) == [1, 2] and keys(log.read("b")) == [7]
    assert keys(log.read("a", log.state(first.version))) == [1] and log.versions() == [1, 2]
    with pytest.raises(ValueError, match="no version 9"):
        log.state(9)
    assert log.commit(lambda state: None).version == 2


def test_the_slower_writer_works_its_change_out_again(spark, log):
    other = TableLog(spark, log.root, SCHEMAS)
    seen = []

    def next_key(state):
        n = (log.read("a", state).agg(F.max("k")).first()[0] or 0) + 1
        seen.append(n)
        if len(seen) == 1:  # the other writer commits between our reading and our putting
            other.append(a=spark.createDataFrame([(1, "other")], SCHEMAS["a"]))
        row = spark.createDataFrame([(n, "ours")], SCHEMAS["a"])
        return {"a": state.entries("a") + log.write("a", row)}

    log.commit(next_key)
    assert seen == [1, 2] and {(r["k"], r["v"]) for r in log.read("a").collect()} == {(1, "other"), (2, "ours")}


def test_no_manifest_is_overwritten(spark, log):
    assert log._put(State(1, {"b": []})) and not log._put(State(1, {"a": []}))
    assert log.state().tables == {"b": []} and log.versions() == [1]


def test_interleaved_registrations_get_different_versions(spark, monkeypatch):
    ledger = Ledger(spark, root(spark))
    other = Ledger(spark, ledger.root)
    write, calls = TableLog.write, []

    def interrupted(self, table, rows):
        if self is ledger.log and table == "model_aliases" and not calls:
            calls.append(1)
            assert other.register("m", "theirs", "/p") == 1
        return write(self, table, rows)

    monkeypatch.setattr(TableLog, "write", interrupted)
    assert ledger.register("m", "ours", "/q") == 2
    assert {(r["version"], r["run_id"]) for r in ledger.read("model_versions").collect()} == {(1, "theirs"), (2, "ours")}
    assert [tuple(r) for r in ledger.aliases().collect()] == [("m", "candidate", 2)]


@pytest.mark.parametrize("dies_after", range(4))
def test_a_writer_that_dies_leaves_no_half_promotion(spark, monkeypatch, dies_after):
    """Death after each write of a promotion (its two tables, then the draft manifest): nothing happened."""
    ledger = Ledger(spark, root(spark))
    values = spark.createDataFrame([("r", "neg_test_mae", -0.1), ("r", "bucket_macro_f1", 0.9)], "run_id string, key string, value double")
    ledger.log_run("r", NOW, {"dataset_id": "d", "n_features": 16}, values)
    ledger.register("m", "r", "/p")
    write, put, done = TableLog.write, TableLog._put, []

    def dying(step):
        def call(self, *args):
            if len(done) == dies_after:
                raise KeyboardInterrupt
            done.append(1)
            return step(self, *args)
        return call

    with monkeypatch.context() as m:
        m.setattr(TableLog, "write", dying(write))
        m.setattr(TableLog, "_put", dying(put))
        if dies_after < 3:
            with pytest.raises(KeyboardInterrupt):
                ledger.promote(Policy(), DEPLOYMENT, "local", NOW)
            assert ledger.read("promotions").count() == 0
            assert {r["alias"] for r in ledger.aliases().collect()} == {"candidate"}
    ledger.promote(Policy(), DEPLOYMENT, "local", NOW)  # a later job does the whole of it, once
    assert ledger.read("promotions").count() == 1
    assert {r["alias"]: r["version"] for r in ledger.aliases().collect()} == {"candidate": 1, "champion": 1}


def test_unnamed_files_are_unread_and_vacuumed(spark, log):
    log.append(a=spark.createDataFrame([(1, "x")], SCHEMAS["a"]))
    log.write("a", spark.createDataFrame([(9, "lost")], SCHEMAS["a"]))  # its writer died
    assert keys(log.read("a")) == [1]
    assert log.vacuum() == 1 and keys(log.read("a")) == [1] and log.versions() == [1]


# --- merges -------------------------------------------------------------------------


def keyed(spark, log, n=2000, rows=50):
    table = KeyedTable(log, "a", ["k"], file_rows=rows)
    table.merge(spark.range(n).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    return table


def test_one_percent_of_keys_rewrites_a_matching_share(spark, log):
    table = keyed(spark, log)
    files = {e["path"] for e in log.state().entries("a")}
    assert len(files) >= 30
    batch = spark.range(1000, 1020).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    state, rewritten = table.merge(batch)
    assert rewritten <= 2 and len(files & {e["path"] for e in state.entries("a")}) == len(files) - rewritten
    assert {(r["v"], r["count"]) for r in table.read().groupBy("v").count().collect()} == {("old", 1980), ("new", 20)}
    again, rewritten = table.merge(batch)  # twice equals once: not even a new version
    assert rewritten == 0 and again.version == state.version


def test_merge_equals_a_dictionary(spark, log):
    import random

    rnd, table, truth = random.Random(6), KeyedTable(log, "a", ["k"], file_rows=20), {}
    for _ in range(5):
        rows = [(rnd.randint(-50, 150), rnd.choice(("p", "q", None)), rnd.randint(0, 3)) for _ in range(60)]
        for k, v, when in sorted(rows, key=lambda r: (r[2], (r[1] is not None, r[1] or ""))):
            truth[k] = v
        table.merge(spark.createDataFrame(rows, "k long, v string, seen long"), recency="seen")
        assert {r["k"]: r["v"] for r in table.read().collect()} == truth
        lows = [e["low"] for e in log.state().entries("a")]
        assert lows == sorted(lows) and sum(e["rows"] for e in log.state().entries("a")) == len(truth)


def test_concurrent_merges_both_count(spark, log):
    table, other = keyed(spark, log, 200), KeyedTable(TableLog(spark, log.root, SCHEMAS), "a", ["k"], file_rows=50)
    put, raced = TableLog._put, []

    def racing(self, state):
        if not raced and self is log:
            raced.append(1)
            other.merge(spark.createDataFrame([(5, "theirs"), (150, "theirs")], SCHEMAS["a"]))
        return put(self, state)

    log._put = racing.__get__(log)
    table.merge(spark.createDataFrame([(5, "ours"), (7, "ours"), (900, "ours")], SCHEMAS["a"]))
    got = {r["k"]: r["v"] for r in table.read().where("v <> 'old'").collect()}
    assert got == {5: "ours", 7: "ours", 900: "ours", 150: "theirs"} and table.read().count() == 201


def test_string_keys_empty_batches_and_null_keys(spark):
    log = TableLog(spark, root(spark), {"n": "t string, id string, p int"})
    table = KeyedTable(log, "n", ["t", "id"], file_rows=3)
    empty = spark.createDataFrame([], "t string, id string, p int")
    assert table.merge(empty) == (State(), 0)
    rows = [("é", "x", 1), ("a", "\U0001F600", 2), ("a", "￿", 3), ("a", "", 4), ("b", "z", None)]
    table.merge(spark.createDataFrame(rows, "t string, id string, p int"))
    state, n = table.merge(empty)
    assert n == 0 and state.version == 1
    table.merge(spark.createDataFrame([("a", "￿", 30), ("c", "new", 5)], "t string, id string, p int"))
    assert {(r["t"], r["id"]): r["p"] for r in table.read().collect()} == {
        ("é", "x"): 1, ("a", "\U0001F600"): 2, ("a", "￿"): 30, ("a", ""): 4, ("b", "z"): None, ("c", "new"): 5}
    with pytest.raises(ValueError, match="null"):
        table.merge(spark.createDataFrame([(None, "x", 1)], "t string, id string, p int"))


def test_ledger_tables_have_schemas():
    assert "model_aliases" in registry.SCHEMAS
