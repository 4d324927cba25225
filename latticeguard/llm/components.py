"""Connected components over an edge table by alternating large-star and small-star steps.

Each step is a partial-aggregated minimum per node and an equi-join back to the edges, so a node
with very many neighbours (a hub) is combined map-side and its join partition can be split by
adaptive skew handling. The edge table shrinks to stars; it never leaves the cluster, and each
round is written to the shared checkpoint folder, which cuts the lineage and survives the loss of
executors.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticeguard.llm.common import materialize
from latticeguard.session import release


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return (edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (columns a, b; any orderable type).

    The component is the smallest node reachable. Self-loops and repeated or reversed edges change
    nothing; nodes without an edge to another node are not returned; no edges give no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "cc-edges")
    state = _state(edges)
    while state[0]:
        turned = materialize(_small_star(_large_star(edges)), "cc-edges")
        release(edges)
        edges, before = turned, state
        state = _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
