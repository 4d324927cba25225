"""Writes of the run ledger and the model registry.

The ledger's tables share one commit log (`sources/tablelog.py`). Every action is one commit: a run with
its parameters and metrics, a version with its alias, a promotion with the alias it moves. Two jobs
that act at once are put in an order; the later one decides again from what the earlier one left, so
no version number is given twice and no alias move is lost. A job that dies leaves the last state.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Policy
from ..sources.tablelog import State, TableLog
from . import promotion as pm
from .graph import upsert

SCHEMAS = {
    "runs": "run_id string, end_time timestamp",
    "run_metrics": "run_id string, key string, value double, ts timestamp, step long",
    "run_params": "run_id string, key string, value string",
    "model_versions": "model string, version int, run_id string, path string",
    "promotions": "environment string, model string, version int, run_id string, promoted_at timestamp",
    "risk_scores": "asset_id long, risk_score double, priority string, model_name string, model_version string, "
                   "run_id string, scored_at timestamp",
    "model_aliases": "model string, alias string, version int",
}


class Ledger:
    """The tables under one shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = TableLog(spark, root, SCHEMAS)

    def read(self, table: str, state: State | None = None) -> DataFrame:
        return self.log.read(table, state)

    def append(self, table: str, rows: DataFrame) -> None:
        """Append rows of a table's columns."""
        self.log.append(**{table: rows})

    # --- runs -----------------------------------------------------------------------

    def log_run(self, run_id: str, ended: str, params: dict[str, object], *metrics: DataFrame) -> None:
        """A run's end, its parameters, and the union of its metric sets (a later set wins;
        `metrics` have run_id, key, value). Missing values are not logged."""
        end = F.lit(ended).cast("timestamp")
        one = self.spark.range(1)
        pairs = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(str(v)).alias("value")) for k, v in sorted(params.items())))
        merged = pm.merge_metric_sets(*metrics).where(F.col("value").isNotNull())
        self.log.append(
            runs=one.select(F.lit(run_id).alias("run_id"), end.alias("end_time")),
            run_params=one.select(F.lit(run_id).alias("run_id"), F.inline(pairs)),
            run_metrics=merged.withColumn("ts", end).withColumn("step", F.lit(0).cast("long")))

    def append_scores(self, scores: DataFrame, model: str, version: int, run_id: str, scored_at: str) -> None:
        """M8: scored rows with their provenance; rows without a score stay in the batch's error output."""
        from .training import with_provenance

        self.append("risk_scores", with_provenance(scores.where(F.col("risk_score").isNotNull()), model, str(version),
                                                   run_id, scored_at))

    # --- registry -------------------------------------------------------------------

    def aliases(self, state: State | None = None) -> DataFrame:
        return self.read("model_aliases", state)

    def register(self, model: str, run_id: str, path: str) -> int:
        """A new version of a model, under the alias `candidate`; `champion` never moves here."""
        one, given = self.spark.range(1), []

        def change(state: State) -> dict:
            last = self.read("model_versions", state).where(F.col("model") == model).agg(F.max("version")).first()[0]
            given[:] = [(last or 0) + 1]
            version = F.lit(given[0])
            row = one.select(F.lit(model).alias("model"), version.alias("version"), F.lit(run_id).alias("run_id"),
                             F.lit(path).alias("path"))
            alias = one.select(F.lit(model).alias("model"), F.lit(pm.CANDIDATE).alias("alias"), version.alias("version"))
            aliases = upsert(self.aliases(state), alias, ["model", "alias"])
            return {"model_versions": state.entries("model_versions") + self.log.write("model_versions", row),
                    "model_aliases": self.log.write("model_aliases", aliases)}

        self.log.commit(change)
        return given[0]

    def decide(self, policy: Policy, deployment: str, now: str, state: State | None = None) -> tuple[DataFrame, DataFrame]:
        """(resolved aliases, decisions) of every model that has a candidate, from one state of the ledger alone."""
        state = state or self.log.state()
        at = F.lit(now).cast("timestamp")
        resolved = pm.resolve_aliases(self.aliases(state), self.read("model_versions", state)).withColumn(
            "deployment", F.lit(deployment))
        latest = pm.latest_metrics(self.read("run_metrics", state))
        pairs = pm.metric_pairs(resolved, latest)
        comparison = pm.comparability(
            resolved, pm.evaluations(self.read("runs", state), self.read("run_params", state), at), pairs)
        ledger = pm.gate_ledger(comparison, pairs, policy, at, self.read("promotions", state))
        return resolved, pm.decisions(comparison, ledger, policy)

    def promote(self, policy: Policy, deployment: str, environment: str, now: str) -> DataFrame:
        """Flip `champion` of every model that an environment approves and append `promotions`, in one
        commit; returns the decisions it rests on. A model whose candidate is its champion already is not
        promoted again. If the ledger moves meanwhile, the decisions are made again from its new state."""
        made: list[DataFrame] = []

        def change(state: State) -> dict | None:
            resolved, decided = self.decide(policy, deployment, now, state)
            made[:] = [decided.persist()]
            moving = resolved.where(~F.col("cand_version").eqNullSafe(F.col("champ_version")))
            approved = made[0].where((F.col("environment") == environment) & (F.col("outcome") == "approve")).join(
                moving.select("model", "cand_version", "cand_run"), "model").persist()
            if approved.isEmpty():
                return None
            promoted = self.log.write("promotions", approved.select(
                "environment", "model", F.col("cand_version").alias("version"), F.col("cand_run").alias("run_id"),
                F.lit(now).cast("timestamp").alias("promoted_at")))
            moved = pm.alias_flip(self.aliases(state), resolved, approved.select("environment", "model", "outcome"), environment)
            return {"promotions": state.entries("promotions") + promoted,
                    "model_aliases": self.log.write("model_aliases", moved)}

        self.log.commit(change)
        return made[0]

    def load(self, model: str, alias: str = pm.CHAMPION, path: str | None = None):
        """M9: (fitted model, thresholds) at an explicit path, else at that of the alias's version."""
        from .training import load

        if path is None:
            row = (self.aliases().where((F.col("model") == model) & (F.col("alias") == alias))
                   .join(self.read("model_versions"), ["model", "version"]).select("path").first())
            if row is None:
                raise ValueError(f"model {model!r} has no version under the alias {alias!r}")
            path = row["path"]
        return load(path, self.spark)


def metric_rows(run_id: str, wide: DataFrame) -> DataFrame:
    """One-row wide metrics as (run_id, key, value)."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in wide.columns)
    return wide.selectExpr(f"'{run_id}' AS run_id", f"stack({len(wide.columns)}, {stack}) AS (key, value)")

