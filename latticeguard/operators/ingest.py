"""Scan ingest helpers: target lists, coverage, asset resolution."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_PORT = 443


def parse_targets(lines: DataFrame, col: str = "value") -> DataFrame:
    """`host[:port]` per line; '#' comments and blank lines dropped; default port 443."""
    v = F.trim(F.col(col))
    d = lines.select(v.alias("line")).where((F.col("line") != "") & ~F.col("line").startswith("#"))
    host = F.regexp_extract(F.col("line"), r"^([^:\s]+)", 1)
    port = F.regexp_extract(F.col("line"), r":(\d+)$", 1)
    return d.select(host.alias("host"),
                    F.when(port == "", F.lit(DEFAULT_PORT)).otherwise(port.cast("int")).alias("port"))


def scan_coverage(attempts: DataFrame) -> DataFrame:
    """Attempts per outcome/reason and overall coverage = ok / attempted (window over the small result)."""
    g = attempts.groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("n_attempts"))
    w = Window.partitionBy()  # over the grouped result: one row per (outcome, reason)
    return g.select(
        "outcome", "reason", "n_attempts",
        (F.sum(F.when(F.col("outcome") == "ok", F.col("n_attempts")).otherwise(0)).over(w)
         / F.sum("n_attempts").over(w)).alias("coverage"),
    )


def resolve_assets(findings: DataFrame, assets: DataFrame) -> DataFrame:
    """Match a finding's hint to an asset by hostname, else by repo; unmatched get md5(hint).

    One equi-join of the hints that exist with one table of asset keys; no null key is ever
    shuffled, so findings without a hostname don't meet in one task. A finding with both hints
    has two rows in that join and keeps its best match (hostname first); a finding without any
    hint needs no join.
    """
    keys = assets.select("asset_id", F.explode(F.array(
        F.struct(F.lit("hostname").alias("kind"), F.col("hostname").alias("key")),
        F.struct(F.lit("repo").alias("kind"), F.col("repo").alias("key")))).alias("k")) \
        .select("k.kind", "k.key", "asset_id").where(F.col("key").isNotNull())
    f = findings.select("finding_id", F.col("asset_hint.hostname").alias("_h"), F.col("asset_hint.repo").alias("_r"))
    hints = F.filter(F.array(F.struct(F.lit("hostname").alias("kind"), F.col("_h").alias("key")),
                             F.struct(F.lit("repo").alias("kind"), F.col("_r").alias("key"))), lambda x: x["key"].isNotNull())
    f = f.select("finding_id", hints.alias("hints"))
    j = f.select("finding_id", F.size("hints").alias("n"), F.element_at("hints", 1)["key"].alias("hint"),
                 F.explode("hints").alias("h")).select("finding_id", "n", "hint", "h.kind", "h.key") \
        .join(keys, ["kind", "key"], "left")
    one = j.where("n = 1").select("finding_id", "hint", "asset_id", "kind")
    both = j.where("n = 2").groupBy("finding_id").agg(
        F.max("hint").alias("hint"), F.min(F.when(F.col("asset_id").isNotNull(), F.struct("kind", "asset_id"))).alias("b")) \
        .select("finding_id", "hint", "b.asset_id", "b.kind")
    none = f.where(F.size("hints") == 0).select("finding_id", F.lit(None).cast("string").alias("hint"),
                                                F.lit(None).cast("long").alias("asset_id"), F.lit("created").alias("kind"))
    found = one.unionByName(both).unionByName(none)
    return found.select(
        "finding_id", F.coalesce(F.col("asset_id").cast("string"), F.md5(F.col("hint"))).alias("resolved_asset"),
        F.when(F.col("asset_id").isNotNull(), F.col("kind")).otherwise(F.lit("created")).alias("matched_by"))
