"""Dashboard-style reports.

All reports are aggregates or keyed lookups; the per-asset document is flat
(per-asset counts and extremes joined after aggregation), never a collected
list, so one asset with a huge number of findings cannot overload a task.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Thresholds
from ..functions.exprs import priority_bucket
from ..functions.quantiles import hashed_row_number


def posture_summary(rule_labelled: DataFrame, certs_expiring: DataFrame,
                    thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Assets per priority, vulnerable share, unknown share (distinct from safe), expiring certs."""
    pr = priority_bucket(F.col("risk_score"), thresholds)
    counts = [F.count_if(pr == p).alias(f"n_{p.lower()}") for p in thresholds.priorities]
    s = rule_labelled.agg(
        F.count(F.lit(1)).alias("n_assets"), *counts,
        F.avg(F.coalesce(F.col("qv_raw").cast("int"), F.lit(0)).cast("double")).alias("vulnerable_share"),
        F.avg(F.col("qv_raw").isNull().cast("double")).alias("unknown_share"),
    )
    n_expiring = certs_expiring.count()  # one scalar
    return s.withColumn("n_expiring_vulnerable_certs", F.lit(n_expiring).cast("long"))


def findings_table(findings: DataFrame, n: int = 50) -> DataFrame:
    """The dashboard's most recent vulnerable findings (top-n is the feature)."""
    return findings.where(F.col("quantum_vulnerable")).orderBy(F.col("discovered_at").desc(), F.col("finding_id")) \
        .limit(n).select("finding_id", "asset_id", "algorithm", "key_size",
                         F.col("discovered_at").cast("date").alias("discovered_at"))


def asset_document(features: DataFrame, rule_labelled: DataFrame, certificates: DataFrame,
                   thresholds: Thresholds = Thresholds()) -> DataFrame:
    """J6 (flat): one row per asset with its certificate and finding roll-ups (no M x N fan-out)."""
    certs = certificates.groupBy("asset_id").agg(
        F.count(F.lit(1)).alias("n_certs"), F.min("not_after").cast("date").alias("first_cert_expiry"))
    pr = rule_labelled.select("asset_id", priority_bucket(F.col("risk_score"), thresholds).alias("priority"))
    return features.select("asset_id", "criticality", "algorithm", "n_findings") \
        .join(certs, "asset_id", "left").join(pr, "asset_id", "left") \
        .select("asset_id", "criticality", F.col("algorithm").alias("primary_algorithm"), "n_findings",
                F.coalesce(F.col("n_certs"), F.lit(0)).alias("n_certs"), "first_cert_expiry", "priority")


def export_versioned(features: DataFrame, root: str, stamp: str, fmt: str = "parquet") -> str:
    """Write under <root>/features_<version>_<stamp>, partitioned by schema_version; never overwrite."""
    version = features.select("schema_version").first()[0] if "schema_version" in features.columns else "unknown"
    path = f"{root.rstrip('/')}/features_{version}_{stamp}"
    w = features.write.mode("errorifexists").partitionBy("schema_version")
    (w.parquet(path) if fmt == "parquet" else w.json(path))
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """S3: CSV with a header line, nulls as empty fields."""
    df.write.option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S3: CSV with a header, under a given schema; a header that differs from it is an error."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def create_assets(assets: DataFrame, new: DataFrame, key: str = "hostname") -> DataFrame:
    """`assets` and the assets of `new` (without asset_id) that no key of `assets` names, with new ids.

    Ids go on from the highest, in the order of a hash of the key; the numbers come from per-bucket counts, not
    from one sorted task."""
    fresh = new.dropDuplicates([key]).join(assets.select(key), key, "left_anti").withColumn(
        "_h", F.md5(F.col(key)))
    start = assets.agg(F.coalesce(F.max("asset_id"), F.lit(-1).cast("long"))).scalar()
    numbered = hashed_row_number(fresh, [], "_h")
    return assets.unionByName(numbered.select((start + F.col("rn")).cast("long").alias("asset_id"),
                                              *(c for c in assets.columns if c != "asset_id")))


def lookup_asset(assets: DataFrame, asset_id: int) -> DataFrame:
    """One asset by id (the filter reaches the scan)."""
    return assets.where(F.col("asset_id") == asset_id)
