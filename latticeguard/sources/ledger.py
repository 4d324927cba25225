"""Run ledger derived from the driver's `events` table.

The reference keeps runs, metrics, params, tags and model aliases in a
tracking server; here they are tables. So that the promotion queries read the
given data (and grow with it), the ledger is derived from `events`:

* every user is a training run `run-<user_id>`; each event is one logged
  metric value: key from the event type, value from the event value, ts and
  step (= event_id) order the log, so the latest value per key wins;
* the run's end time is its last event; its `dataset_id` param is
  `ds-<k mod 2>` where k is the `k` field of the props JSON of its last event;
* model `model-<user_id div 2>` has version 1 (even user, alias champion) and
  version 2 (odd user, alias candidate); all models belong to the one
  deployment of the policy;
* tags: each event type writes one required tag, plus the dataset and schema
  version tags, so the tag audit has real gaps to report.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEPLOYMENT
from ..schemas import SCHEMA_VERSION

# Fixed mapping (ours): event type -> (metric key, scale). bucket_macro_f1 is
# 1 - exp(-value / 50), which spreads the event values over [0, 1).
METRIC_OF_EVENT = {
    "view": ("bucket_macro_f1", None),
    "click": ("neg_test_mae", -1.0 / 1000.0),
    "purchase": ("test_r2", 1.0 / 500.0),
    "signup": ("pearson_r", 1.0 / 500.0),
    "error": ("test_mae", 1.0 / 1000.0),
}
TAG_OF_EVENT = {"view": "project", "click": "repo", "purchase": "git_sha", "signup": "created_by", "error": "run_type"}
LEDGER_AS_OF = "2024-02-14 00:00:00"


def _lookup(c: Column, mapping: dict, idx: int | None = None) -> Column:
    chain = None
    for k, v in mapping.items():
        val = v[idx] if idx is not None else v
        chain = F.when(c == k, F.lit(val)) if chain is None else chain.when(c == k, F.lit(val))
    return chain


def run_metrics(events: DataFrame) -> DataFrame:
    e = events.select("event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        _lookup(F.col("event_type"), METRIC_OF_EVENT, 0).alias("key"),
        F.when(F.col("event_type") == "view", F.lit(1.0) - F.exp(-F.col("value") / F.lit(50.0)))
        .otherwise(F.col("value") * _lookup(F.col("event_type"), METRIC_OF_EVENT, 1)).alias("value"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("step"),
    ).where(F.col("key").isNotNull())


def runs_and_params(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    k = F.get_json_object(F.col("props"), "$.k").try_cast("long")
    last = events.groupBy(F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id")).agg(
        F.max(F.col("ts").cast("timestamp")).alias("end_time"),
        F.max_by(k, F.struct("ts", "event_id")).alias("k"),
    )
    runs = last.select("run_id", "end_time")
    params = last.select("run_id", F.lit("dataset_id").alias("key"),
                         F.concat(F.lit("ds-"), (F.col("k") % 2).cast("string")).alias("value"))
    return runs, params


def run_tags(events: DataFrame, params: DataFrame) -> DataFrame:
    t = events.select(F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
                      _lookup(F.col("event_type"), TAG_OF_EVENT).alias("key")) \
        .where(F.col("key").isNotNull()).groupBy("run_id", "key").agg(F.lit("set").alias("value"))
    extra = params.select("run_id", F.lit("dataset_version").alias("key"), F.col("value")).unionByName(
        params.select("run_id", F.lit("feature_schema_version").alias("key"), F.lit(SCHEMA_VERSION).alias("value")))
    return t.unionByName(extra)


def model_registry(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    users = events.groupBy("user_id").agg(F.lit(1).alias("_x")).select("user_id")
    versions = users.select(
        F.concat(F.lit("model-"), F.expr("user_id div 2").cast("string")).alias("model"),
        (F.col("user_id") % 2 + 1).cast("int").alias("version"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
    )
    aliases = versions.select(
        "model", F.when(F.col("version") == 1, F.lit("champion")).otherwise(F.lit("candidate")).alias("alias"),
        "version")
    return versions, aliases
