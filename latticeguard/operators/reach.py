"""Reachability and cycles over an edge table.

Everything is semi-naive: a round joins only what the last round found with the edges, drops what is
known, and stops when nothing is new. Each round is written to the shared folder, so plans stay flat
and a lost executor costs a part of one round.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, release
from .planner import dependency_levels


def reachable(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, node, hops): every node that a path of one or more edges (src, dst) leads to, with the length
    of the shortest one. A source on a cycle reaches itself. `sources` has one column; nulls reach nothing.

    The rounds run from the distinct successors of the sources, so what lies behind a node is searched once, however
    many sources lead to it. A source then takes what its successors reach: as it is if it has one, and the
    shortest path to each node if it has more.
    """
    links = materialize(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "reach-edges")
    start = sources.toDF("source").where("source IS NOT NULL").distinct()
    steps = start.join(links, start["source"] == links["src"]).select("source", F.col("dst").alias("mid"))
    first = materialize(steps.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("source"))), "reach-first")
    mids = materialize(first.select("mid").distinct(), "reach-mids")
    behind = _closure(links, mids).where("source <> node").unionByName(
        mids.select(F.col("mid").alias("source"), F.col("mid").alias("node"), F.lit(0).alias("hops")))
    behind = materialize(behind.select(F.col("source").alias("mid"), "node", (F.col("hops") + 1).alias("hops")), "reach-behind")
    for used in (links, mids):
        release(used)
    one = first.where("n = 1").join(behind, "mid").select("source", "node", "hops")
    more = first.where("n > 1").join(behind, "mid").groupBy("source", "node").agg(F.min("hops").alias("hops"))
    return one.unionByName(more)


def _closure(links: DataFrame, start: DataFrame) -> DataFrame:
    """(source, node, hops) of distinct sources. Pairs found once are never followed again, so cycles end and a node
    behind many paths is joined once."""
    start = start.toDF("source")
    frontier = start.select("source", F.col("source").alias("node"))
    rounds: list[DataFrame] = []
    hops = 0
    while not frontier.isEmpty():
        hops += 1
        found = frontier.join(links, frontier["node"] == links["src"]).select("source", F.col("dst").alias("node")).distinct()
        if rounds:
            known = reduce(DataFrame.unionByName, (r.select("source", "node") for r in rounds))
            found = found.join(known, ["source", "node"], "left_anti")
        fresh = materialize(found.withColumn("hops", F.lit(hops)), f"reach-{hops}")
        rounds.append(fresh)
        frontier = fresh.select("source", "node")
    return reduce(DataFrame.unionByName, rounds) if rounds else start.limit(0).select(
        "source", F.col("source").alias("node"), F.lit(0).alias("hops"))


def _trimmed(edges: DataFrame) -> DataFrame:
    """Edges that may lie on a cycle: ends without an edge in or out are taken off until none is left."""
    left = materialize(edges, "scc-edges")
    n = left.count()
    while n:
        inner = left.select(F.col("src").alias("node")).distinct().intersect(left.select(F.col("dst").alias("node")).distinct())
        kept = left.join(inner.withColumnRenamed("node", "src"), "src", "left_semi").join(
            inner.withColumnRenamed("node", "dst"), "dst", "left_semi").select("src", "dst")
        fewer = materialize(kept, "scc-edges")
        release(left)
        left, before, n = fewer, n, fewer.count()
        if n == before:
            break
    return left


def _spread(values: DataFrame, links: DataFrame) -> DataFrame:
    """(node, color): the smallest color that a path over `links` (from, to) carries to each node of `values`.
    Only nodes whose color fell in the last round pass it on; a round is one table, written once."""
    colors = materialize(values.select("node", "color", F.lit(True).alias("fell")), "scc-colors")
    while True:
        fallen = colors.where("fell")
        offered = fallen.join(links, fallen["node"] == links["from"]).groupBy(F.col("to").alias("node")).agg(F.min("color").alias("offer"))
        following = materialize(colors.join(offered, "node", "left").select(
            "node", F.least("color", "offer").alias("color"), F.coalesce(F.col("offer") < F.col("color"), F.lit(False)).alias("fell")),
            "scc-colors")
        release(colors)
        colors = following
        if colors.where("fell").isEmpty():
            return colors


def cyclic_components(edges: DataFrame) -> DataFrame:
    """(node, component): the nodes that lie on a cycle, with the smallest node of their strongly connected
    component. A node with an edge to itself lies on a cycle.

    Forward: every node learns the smallest node that reaches it, its color. Backward, the nodes of a color that reach
    the node it is named after are that node's component, and it is their smallest. These are taken off and the
    rest goes on. Every round takes off the component of each color's node: all components at once, unless a smaller
    node outside leads to one.
    """
    links = edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    left, done = _trimmed(links.where("src <> dst")), []
    while not left.isEmpty():
        nodes = left.select(F.col("src").alias("node")).union(left.select("dst")).distinct()
        colors = _spread(nodes.withColumn("color", F.col("node")), left.select(F.col("src").alias("from"), F.col("dst").alias("to")))
        of = colors.select(F.col("node").alias("src"), F.col("color").alias("c1"))
        to = colors.select(F.col("node").alias("dst"), F.col("color").alias("c2"))
        inside = materialize(left.join(of, "src").join(to, "dst").where("c1 = c2").select("src", "dst"), "scc-inside")
        # backward within a color: 0 spreads from the roots against the edges
        marks = _spread(colors.select("node", (F.col("node") != F.col("color")).cast("int").alias("color")),
                        inside.select(F.col("dst").alias("from"), F.col("src").alias("to")))
        members = marks.where("color = 0").select("node").join(colors.select("node", F.col("color").alias("component")), "node")
        sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
        taken = materialize(members.join(sizes, "component").select("node", "component", "n"), "scc-taken")
        done.append(taken.where("n > 1").select("node", "component"))
        gone = taken.select("node")
        rest = left.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(
            gone.withColumnRenamed("node", "dst"), "dst", "left_anti").select("src", "dst")
        following = _trimmed(rest)
        for used in (left, colors, inside, marks):
            release(used)
        left = following
    own = links.where("src = dst").select(F.col("src").alias("node"))
    if done:
        found = reduce(DataFrame.unionByName, done)
        own = own.join(found.select("node"), "node", "left_anti")
        return found.unionByName(own.select("node", F.col("node").alias("component")))
    return own.select("node", F.col("node").alias("component"))


def component_levels(assets: DataFrame, edges: DataFrame) -> DataFrame:
    """O3 for graphs with cycles: (asset_id, component, n_members, level).

    Assets that depend on each other in a circle form one component, named by its smallest member; every other
    asset is its own. A component's level is the longest path of components below it, so all its members fall
    into one phase, after what they depend on.
    """
    cyclic = materialize(cyclic_components(edges), "level-cycles")
    ids = assets.select("asset_id")
    named = materialize(ids.join(cyclic.withColumnRenamed("node", "asset_id"), "asset_id", "left").select(
        "asset_id", F.coalesce("component", "asset_id").alias("component")), "level-components")
    of = named.select(F.col("asset_id").alias("src"), F.col("component").alias("a"))
    to = named.select(F.col("asset_id").alias("dst"), F.col("component").alias("b"))
    between = edges.select("src", "dst").join(of, "src").join(to, "dst").where("a <> b").select(
        F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
    sizes = named.groupBy("component").agg(F.count(F.lit(1)).alias("n_members"))
    levels = dependency_levels(sizes.select(F.col("component").alias("asset_id")), between)
    return named.join(sizes, "component").join(levels.withColumnRenamed("asset_id", "component"), "component").select(
        "asset_id", "component", "n_members", "level")
