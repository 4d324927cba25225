"""Rule label (L1-L10): transparent weighted score, optional keyed Gaussian noise."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COMPLEXITY_DEFAULT, COMPLEXITY_SCORE, CRITICALITY_DEFAULT, CRITICALITY_SCORE, LabelWeights
from ..functions.exprs import clip01, hash_normal


def _level(c: Column, table: dict[str, float], default: float) -> Column:
    """Case-insensitive level lookup; unknown and NULL give the default."""
    key = F.upper(c.cast("string"))
    chain = None
    for name, score in table.items():
        chain = F.when(key == name, F.lit(score)) if chain is None else chain.when(key == name, F.lit(score))
    return chain.otherwise(F.lit(default))


def _num(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("double")


def rule_score(df: DataFrame, weights: LabelWeights = LabelWeights()) -> Column:
    """The label before noise and before the clip (see `label`)."""
    exposure = F.lit(0.6) * _num(df, "internet_accessible") + F.lit(0.4) * _num(df, "has_public_cert")
    qv = F.coalesce(F.col("quantum_vulnerable").cast("boolean"), F.lit(False))
    weakness = F.when(qv, F.lit(1.0)).otherwise(F.lit(0.1))
    business = (F.lit(0.5) * _num(df, "financial_data") + F.lit(0.3) * _num(df, "customer_data")
                + F.lit(0.2) * _num(df, "regulated_system"))
    score = (
        F.lit(weights.exposure) * exposure
        + F.lit(weights.criticality) * _level(F.col("criticality"), CRITICALITY_SCORE, CRITICALITY_DEFAULT)
        + F.lit(weights.algo_weakness) * weakness
        + F.lit(weights.complexity) * _level(F.col("migration_complexity"), COMPLEXITY_SCORE, COMPLEXITY_DEFAULT)
        + F.lit(weights.business) * business
    )
    if "previous_incident_flag" in df.columns:
        bump = F.coalesce(F.col("previous_incident_flag").cast("boolean"), F.lit(False))
        score = score + F.when(bump, F.lit(weights.incident_bump)).otherwise(F.lit(0.0))
    return score


def label(df: DataFrame, weights: LabelWeights = LabelWeights(), seed: int | None = 42,
          key: str = "asset_id", label_col: str = "risk_score") -> DataFrame:
    """Add the label; with a seed, add keyed N(0, std) noise and clip again.

    Noise is a pure function of (seed, key), so it does not change with
    partitioning or row order (unlike randn(seed)).
    """
    # Each step is its own column so the clip's repeated references stay column
    # references (CollapseProject keeps non-cheap expressions un-inlined).
    out = df.withColumn("_raw", rule_score(df, weights)).withColumn("_base", clip01(F.col("_raw")))
    if seed is None:
        return out.withColumn(label_col, F.col("_base")).drop("_raw", "_base")
    out = out.withColumn("_noisy", F.col("_base") + hash_normal(F.col(key), seed, "", weights.noise_std))
    return out.withColumn(label_col, clip01(F.col("_noisy"))).drop("_raw", "_base", "_noisy")
