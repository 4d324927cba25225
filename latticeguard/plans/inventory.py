"""The inventory plan: driver tables -> findings -> assets -> features -> labels.

`Inventory` builds lazy DataFrames; nothing runs until a query acts on them.
"""
from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..config import LabelWeights
from ..operators import features as feat
from ..operators import labels as lab
from ..sources import inventory as inv
from ..sources.tables import Tables


_CACHE: dict[tuple[int, str], "Inventory"] = {}


def shared_inventory(spark: SparkSession, sf_dir: str) -> "Inventory":
    """One Inventory per (session, folder), so queries in a session share the persisted tables."""
    key = (id(spark), sf_dir)
    inv = _CACHE.get(key)
    if inv is None or inv.spark is not spark:
        inv = _CACHE[key] = Inventory(spark, sf_dir)
    return inv


def release_all() -> None:
    """Forget every shared inventory and what it persisted (cold timings)."""
    for inv in _CACHE.values():
        inv.spark.catalog.clearCache()
    _CACHE.clear()


class Inventory:
    def __init__(self, spark: SparkSession, sf_dir: str, seed: int = 42,
                 weights: LabelWeights = LabelWeights(), persist: bool = True):
        self.persist = persist
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)
        self.seed = seed
        self.weights = weights

    @cached_property
    def findings(self) -> DataFrame:
        return inv.findings(self.t)

    @cached_property
    def assets(self) -> DataFrame:
        return inv.assets(self.t)

    @cached_property
    def edges(self) -> DataFrame:
        return inv.dependency_edges(self.t)

    @cached_property
    def certificates(self) -> DataFrame:
        return inv.certificates(self.t)

    @cached_property
    def scan_attempts(self) -> DataFrame:
        return inv.scan_attempts(self.t)

    @cached_property
    def rollup(self) -> DataFrame:
        return feat.finding_rollup(self.findings)

    @cached_property
    def features(self) -> DataFrame:
        """One row per asset; persisted because every model/eval/plan query reads it
        several times (lineage is kept, so a lost executor only recomputes its part)."""
        f = feat.asset_features(self.assets, self.rollup, feat.dependency_count(self.edges))
        return f.persist(StorageLevel.MEMORY_AND_DISK) if self.persist else f

    @cached_property
    def rule_labelled(self) -> DataFrame:
        """Features with the noise-free rule score."""
        return lab.label(self.features, self.weights, seed=None)

    @cached_property
    def labelled(self) -> DataFrame:
        """Features with the noisy training label (keyed by asset_id); persisted because
        strata, splits, folds and training all read it several times."""
        d = lab.label(self.features, self.weights, seed=self.seed)
        return d.persist(StorageLevel.MEMORY_AND_DISK) if self.persist else d

    # --- split and evaluation inputs ---------------------------------------------

    @cached_property
    def split(self) -> DataFrame:
        from ..operators.splits import stratified_split

        s = stratified_split(self.labelled, seed=self.seed)
        return s.persist(StorageLevel.MEMORY_AND_DISK) if self.persist else s

    @cached_property
    def train(self) -> DataFrame:
        return self.split.where("split = 'train'")

    @cached_property
    def test(self) -> DataFrame:
        return self.split.where("split = 'test'")

    @cached_property
    def standin_predictions(self) -> DataFrame:
        """A SQL-expressible stand-in prediction on the test rows: label plus keyed
        noise under its own tags, so evaluation operators have an oracle."""
        from pyspark.sql import functions as F

        from ..functions.exprs import clip01, hash_normal
        from ..operators.evaluation import with_buckets

        t = self.test.withColumn("_p", F.col("risk_score") + hash_normal(F.col("asset_id"), self.seed, "p", 0.05))
        return with_buckets(t.withColumn("predicted_score", clip01(F.col("_p"))).drop("_p"))

    # --- model ---------------------------------------------------------------------

    @cached_property
    def medians(self) -> dict[str, float]:
        """Medians of the training rows, for missing numbers of either part, also of one that only the test
        part has."""
        return feat.fit_medians(self.train, self.split)

    @cached_property
    def train_encoded(self) -> DataFrame:
        from ..operators.training import training_frame

        return training_frame(self.train, medians=self.medians)

    @cached_property
    def test_encoded(self) -> DataFrame:
        from ..operators.training import training_frame

        return training_frame(self.test, medians=self.medians)

    @cached_property
    def trained(self):
        """CV over the 4-config grid, then the final fit (M1-M4)."""
        from ..operators.training import cross_validate

        return cross_validate(self.train_encoded, seed=self.seed)

    @cached_property
    def model_predictions(self) -> DataFrame:
        """Model scores on the test split with buckets."""
        from pyspark.sql import functions as F

        from ..functions.exprs import clip01
        from ..operators.evaluation import with_buckets

        pred = self.trained.model.transform(self.test_encoded)
        return with_buckets(pred.select("asset_id", "risk_score",
                                        clip01(F.col("raw_prediction")).alias("predicted_score")))

    @cached_property
    def demo_model(self):
        """Single fit with the configuration of the reference's run demo (80 trees, depth 3, rate 0.1)."""
        from ..operators.training import _sized, fit

        return fit(_sized(self.train_encoded), (80, 3, 0.1), seed=self.seed)

    @cached_property
    def demo_predictions(self) -> DataFrame:
        from pyspark.sql import functions as F

        from ..functions.exprs import clip01
        from ..operators.evaluation import with_buckets

        pred = self.demo_model.transform(self.test_encoded)
        return with_buckets(pred.select("asset_id", "risk_score",
                                        clip01(F.col("raw_prediction")).alias("predicted_score")))

    # --- graph -----------------------------------------------------------------------

    @cached_property
    def graph(self):
        from ..operators import graph as gr

        return gr.build(self.assets, self.t.orders, self.t.nation)

    # --- planning --------------------------------------------------------------------

    @cached_property
    def levels(self) -> DataFrame:
        from ..operators.planner import dependency_levels

        return dependency_levels(self.assets, self.edges)

    @cached_property
    def plan_items(self) -> DataFrame:
        from ..operators.planner import reasoning

        return self.labelled.withColumn("reasoning", reasoning(self.labelled)).select(
            "asset_id", "risk_score", "criticality", "quantum_vulnerable", "financial_data", "customer_data",
            "regulated_system", "migration_complexity", "algorithm", "key_size", "internet_accessible", "reasoning")

    @cached_property
    def baseline_plan(self) -> DataFrame:
        from ..operators.planner import baseline_plan

        from ..session import materialize

        return materialize(baseline_plan(self.plan_items), "baseline_plan")

    @cached_property
    def weighted_plan(self) -> DataFrame:
        from ..operators.planner import global_order, weighted_plan

        from ..session import materialize

        return materialize(global_order(weighted_plan(self.plan_items, self.levels)), "weighted_plan")
