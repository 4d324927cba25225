"""Promotion plan over the events-derived ledger: every (environment, model) in one job."""
from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import REQUIRED_RUN_TAGS, Policy
from ..operators import promotion as pm
from ..sources import ledger as lg
from ..sources.tables import Tables


_PLANS: dict[tuple[int, str], "PromotionPlan"] = {}


def shared_plan(spark: SparkSession, sf_dir: str) -> "PromotionPlan":
    """One plan per (session, folder) with the default policy, so queries share its persisted tables."""
    key = (id(spark), sf_dir)
    plan = _PLANS.get(key)
    if plan is None or plan.t.spark is not spark:
        plan = _PLANS[key] = PromotionPlan(spark, sf_dir)
    return plan


def release_plans() -> None:
    """Forget every shared plan and what it persisted (cold timings)."""
    for plan in _PLANS.values():
        plan.t.spark.catalog.clearCache()
    _PLANS.clear()


class PromotionPlan:
    def __init__(self, spark: SparkSession, sf_dir: str, policy: Policy = Policy(),
                 as_of: str = lg.LEDGER_AS_OF):
        self.t = Tables(spark, sf_dir)
        self.policy = policy
        self.now = F.lit(as_of).cast("timestamp")

    @cached_property
    def run_metrics(self) -> DataFrame:
        return lg.run_metrics(self.t.events)

    @cached_property
    def runs_params(self):
        runs, params = lg.runs_and_params(self.t.events)
        return runs.persist(StorageLevel.MEMORY_AND_DISK), params.persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def registry(self):
        return lg.model_registry(self.t.events)

    @cached_property
    def latest(self) -> DataFrame:
        """One row per (run, metric key): ledger-sized, reused by every gate branch."""
        return pm.latest_metrics(self.run_metrics).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def resolved(self) -> DataFrame:
        versions, aliases = self.registry
        return pm.resolve_aliases(aliases, versions).withColumn("deployment", F.lit(lg.DEPLOYMENT)) \
            .persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def pairs(self) -> DataFrame:
        return pm.metric_pairs(self.resolved, self.latest).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def comparison(self) -> DataFrame:
        runs, params = self.runs_params
        evals = pm.evaluations(runs, params, self.now)
        return pm.comparability(self.resolved, evals, self.pairs).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def last_promoted(self) -> DataFrame:
        """W7 input: a champion counts as promoted when its run ended, in every environment."""
        envs = F.array(*[F.lit(r.environment) for r in self.policy.all_rules()])
        runs, _ = self.runs_params
        return self.resolved.join(runs.withColumnRenamed("run_id", "champ_run"), "champ_run") \
            .select("model", F.explode(envs).alias("environment"), F.col("end_time").alias("promoted_at")) \
            .persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def ledger(self) -> DataFrame:
        return pm.gate_ledger(self.comparison, self.pairs, self.policy, self.now, self.last_promoted) \
            .persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def decisions(self) -> DataFrame:
        return pm.decisions(self.comparison, self.ledger, self.policy)

    def tag_audit(self) -> DataFrame:
        """Required tags a run lacks: spine (run x required, by explode) anti-joined to tags."""
        runs, params = self.runs_params
        tags = lg.run_tags(self.t.events, params)
        spine = runs.select("run_id", F.explode(F.array(*[F.lit(t) for t in REQUIRED_RUN_TAGS])).alias("key"))
        return spine.join(tags.select("run_id", "key"), ["run_id", "key"], "left_anti") \
            .select("run_id", F.col("key").alias("missing_tag"))
