"""Ledger and registry: later metric wins, aliases, promotion once, load by alias, appends."""
import uuid

import pytest
from pyspark.sql import functions as F

from latticeguard.config import DEPLOYMENT, Policy
from latticeguard.operators import training as trn
from latticeguard.operators.registry import Ledger, metric_rows
from latticeguard.schemas import FEATURE_NAMES
from latticeguard.session import checkpoint_dir, materialize, release

NOW = "2024-02-10 00:00:00"


@pytest.fixture
def ledger(spark):
    return Ledger(spark, f"{checkpoint_dir(spark).rstrip('/')}/test-ledger-{uuid.uuid4().hex}")


def _metrics(spark, run, **values):
    return spark.createDataFrame([(run, k, v) for k, v in values.items()], "run_id string, key string, value double")


def _run(ledger, run, mae, f1=0.9):
    spark = ledger.spark
    ledger.log_run(run, NOW, {"dataset_id": "d", "n_features": 16}, _metrics(spark, run, neg_test_mae=-1.0, bucket_macro_f1=f1),
                   _metrics(spark, run, neg_test_mae=-mae))
    return ledger.register("m", run, f"/nowhere/{run}")


def _aliases(ledger):
    return {(r["model"], r["alias"]): r["version"] for r in ledger.aliases().collect()}


def test_first_version_is_promoted_and_a_worse_one_is_not(spark, ledger):
    assert ledger.aliases().count() == 0 and ledger.read("promotions").count() == 0
    assert _run(ledger, "r1", 0.10) == 1
    assert _aliases(ledger) == {("m", "candidate"): 1}  # registering never moves the champion
    ledger.promote(Policy(), DEPLOYMENT, "local", NOW)
    assert _aliases(ledger) == {("m", "candidate"): 1, ("m", "champion"): 1}
    assert _run(ledger, "r2", 0.30) == 2
    (no,) = ledger.promote(Policy(), DEPLOYMENT, "local", NOW).where("environment = 'local'").collect()
    assert (no["outcome"], no["gate"]) == ("reject", "relative improvement")
    assert _run(ledger, "r3", 0.05) == 3
    (yes,) = ledger.promote(Policy(), DEPLOYMENT, "local", NOW).where("environment = 'local'").collect()
    assert yes["outcome"] == "approve"
    assert _aliases(ledger) == {("m", "candidate"): 3, ("m", "champion"): 3}
    ledger.promote(Policy(), DEPLOYMENT, "local", NOW)  # the same candidate again: nothing moves
    assert [(r["version"], r["run_id"]) for r in ledger.read("promotions").orderBy("version").collect()] == [(1, "r1"), (3, "r3")]
    latest = {(r["run_id"], r["key"]): r["value"] for r in ledger.read("run_metrics").collect()}
    assert latest["r3", "neg_test_mae"] == -0.05 and len(latest) == 6  # the later set's value, once per key
    assert {(r["key"], r["value"]) for r in ledger.read("run_params").where("run_id = 'r1'").collect()} == {
        ("dataset_id", "d"), ("n_features", "16")}


def test_load_by_alias_and_append_scores(spark, ledger):
    with pytest.raises(ValueError, match="no version under the alias 'champion'"):
        ledger.load("m")
    rows = [tuple(float((i * (j + 3)) % 7) for j in range(16)) + (i % 10 / 10,) for i in range(60)]
    train = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in FEATURE_NAMES) + ", risk_score double")
    model = trn.fit(train, (3, 2, 0.1), scaled=True)  # with the optional scaler, saved with the pipeline
    assert len(model.stages) == 3
    path = f"{ledger.root}/models/a"
    trn.save(model, path, spark)
    ledger.register("m", "r1", path)
    loaded, thresholds = ledger.load("m", alias="candidate")
    assert thresholds.priorities[0] == "CRITICAL"
    a = [r[0] for r in model.transform(train).select("raw_prediction").collect()]
    assert a == [r[0] for r in loaded.transform(train).select("raw_prediction").collect()]
    scores = spark.createDataFrame([(1, 0.5, "HIGH"), (2, None, None)], "asset_id long, risk_score double, priority string")
    ledger.append_scores(scores, "m", 1, "r1", NOW)
    ledger.append_scores(scores, "m", 1, "r1", NOW)
    assert [(r["asset_id"], r["model_version"]) for r in ledger.read("risk_scores").collect()] == [(1, "1")] * 2


def test_metric_rows(spark):
    got = metric_rows("r", spark.range(1).select(F.lit(1.5).alias("a"), F.lit(None).cast("double").alias("b"))).collect()
    assert sorted((r["run_id"], r["key"], r["value"]) for r in got) == [("r", "a", 1.5), ("r", "b", None)]


def test_materialized_tables_are_deleted_on_release(spark):
    df = materialize(spark.range(5), "t")
    path = df._materialized_path
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    assert df.count() == 5 and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path))
    release(df)
    assert not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path))
    release(spark.range(1))  # not a materialized table: nothing happens


@pytest.mark.parametrize("master, allowed", [("spark://h:7077", False), ("yarn", False), ("local-cluster[2,1,1024]", False),
                                             ("k8s://h", False), ("local", True), ("local[8]", True), ("local[*]", True)])
def test_no_machine_local_scratch_on_a_cluster(master, allowed):
    class Context:
        def __init__(self):
            self.master = master

        def getCheckpointDir(self):
            return "set"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: None)
            set = staticmethod(lambda key, value: None)

    if allowed:
        assert checkpoint_dir(Session())
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(Session())
