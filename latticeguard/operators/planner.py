"""Dependency-aware migration planning.

* levels (D4): peeling. A node whose dependencies all have a level gets the next one; a round
  shuffles the edge table once, which is halved as its edges close, and else what the round closes.
  The graph's depth is not bounded, and a cycle shows as open edges without a ready node;
* phases (D3): inside each level, HIGH-complexity items are capped per phase;
  every rank is an exact bucketed row number (no unpartitioned window over rows);
* checks (O5): a self-join of the dependency edges against the plan.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CRITICALITY_DEFAULT, CRITICALITY_SCORE
from ..functions.quantiles import rows_before
from ..session import checkpoint_dir, materialize, release

# Fixed values (ours, D1/D3): weights of risk, business impact and 1/complexity; HIGH items per phase.
PLAN_WEIGHTS = (0.5, 0.3, 0.2)
HIGH_PER_PHASE = 25
BUCKETS = 4096


def _by_key(rows: DataFrame) -> DataFrame:
    """A side with a row per asset, edge or score: joined by key, never gathered on the driver to be broadcast."""
    return rows.hint("merge")


def bucketed_row_number(df: DataFrame, partition_cols: list[str], bucket_col: str, order: list[Column],
                        out_col: str = "rn") -> DataFrame:
    """Exact row_number() over (partition by P order by B, O...) where B is a coarse,
    order-preserving bucket (an integer). Counts per (P, B) give offsets; the final
    window is partitioned by (P, B), so no task holds a whole partition of P."""
    counts = df.groupBy(*partition_cols, bucket_col).agg(F.count(F.lit(1)).alias("_c"))
    offs = rows_before(counts, partition_cols, bucket_col, "_c", "_before").drop("_c")
    j = df.join(offs, [*partition_cols, bucket_col], "inner")
    wr = Window.partitionBy(*partition_cols, bucket_col).orderBy(*order)
    return j.withColumn(out_col, F.col("_before") + F.row_number().over(wr)).drop("_before")


def score_row_number(df: DataFrame, partition_cols: list[str], score_col: str, id_col: str,
                     out_col: str = "rn", buckets: int = BUCKETS, id_range: int = BUCKETS) -> DataFrame:
    """Exact row_number() over (partition by P order by score desc, id asc); ids unique in P,
    scores finite in [0, 1] (NULL sorts last).

    The rank is (rows in higher score buckets) + (rows with a higher score in the same
    bucket) + (rows with the same score in lower id ranges) + the row number inside
    (P, score, id range). The offsets come from one partial-aggregated count table; the
    windows over it see distinct scores or id ranges, and the final window partitions by
    (P, score, id range), so a score held by a third of all rows is split into id ranges
    of at most `id_range` rows instead of landing in one task. All joins are by key; Spark
    broadcasts an offset table only when it is small.
    """
    k = F.coalesce(F.col(score_col).cast("double"), F.lit(float("-inf")))
    d = df.withColumn("_k", k).withColumn(
        "_sb", F.least(F.greatest(F.floor((F.lit(1.0) - F.col("_k")) * F.lit(buckets)), F.lit(0)),
                       F.lit(buckets)).cast("long")) \
        .withColumn("_ir", F.floor(F.col(id_col) / F.lit(id_range)).cast("long"))
    cnt = d.groupBy(*partition_cols, "_sb", "_k", "_ir").agg(F.count(F.lit(1)).alias("_c"))
    # rows in higher score buckets: at most `buckets` + 1 rows per group
    per_b = cnt.groupBy(*partition_cols, "_sb").agg(F.sum("_c").alias("_nb"))
    off_b = per_b.select(*partition_cols, "_sb", F.coalesce(
        F.sum("_nb").over(Window.partitionBy(*partition_cols).orderBy("_sb")
                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before_b"))
    # inside a bucket: rows with a higher score (RANGE frame = scores >= this one, minus
    # this score's own rows) and rows of this score in lower id ranges; both windows
    # partition by (P, bucket), so they share one exchange of the count table
    wb = Window.partitionBy(*partition_cols, "_sb")
    ws = Window.partitionBy(*partition_cols, "_sb", "_k")
    offs = cnt.select(
        *partition_cols, "_sb", "_k", "_ir",
        (F.sum("_c").over(wb.orderBy(F.col("_k").desc()).rangeBetween(Window.unboundedPreceding, 0))
         - F.sum("_c").over(ws)).alias("_before_s"),
        F.coalesce(F.sum("_c").over(ws.orderBy("_ir").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_before_r"))
    offs = offs.join(off_b, [*partition_cols, "_sb"]).select(
        *partition_cols, "_k", "_ir", (F.col("_before_b") + F.col("_before_s") + F.col("_before_r")).alias("_before"))
    j = d.join(_by_key(offs), [*partition_cols, "_k", "_ir"])
    w = Window.partitionBy(*partition_cols, "_k", "_ir").orderBy(F.col(id_col).asc())
    return j.withColumn(out_col, F.col("_before") + F.row_number().over(w)).drop("_k", "_sb", "_ir", "_before")


def dependency_levels(assets: DataFrame, edges: DataFrame) -> DataFrame:
    """(asset_id, level) by longest path; edges are (src depends on dst), both among the assets.

    Round i closes the edges into the nodes of level i - 1; a node whose last open edge
    closes has level i. The rounds equal the graph's depth. An edge knows how many its source
    has, so a round passes on only the edges that it closes and the counts of nodes that have
    some closed edges but not all; the edge table is written anew, without the edges of nodes
    that have a level, only when these are half of it. Open edges that no round can close lie
    on or behind a cycle: an error. Counts and levels are written to the shared checkpoint
    folder: plans stay flat however deep the graph is, and a lost executor costs a part of one round.
    """
    spark = assets.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/levels-{uuid.uuid4().hex}"
    kind = assets.schema["asset_id"].dataType.simpleString()

    def found(nodes: DataFrame, level: int) -> DataFrame:
        nodes.select("asset_id").write.parquet(f"{path}/level={level}")
        return spark.read.schema(f"asset_id {kind}").parquet(f"{path}/level={level}")

    def all_found() -> DataFrame:
        return spark.read.schema(f"asset_id {kind}, level int").option("basePath", path).parquet(path)

    def unfinished() -> DataFrame:
        done = all_found().where("level > 0").select(F.col("asset_id").alias("_done"))
        return open_edges.join(_by_key(done), F.col("src").eqNullSafe(F.col("_done")), "left_anti")

    pairs = edges.select("src", "dst").distinct()
    sizes = pairs.groupBy(F.col("src").alias("_src")).agg(F.count(F.lit(1)).alias("n"))
    open_edges = materialize(pairs.join(_by_key(sizes), F.col("src").eqNullSafe(F.col("_src"))).select("src", "dst", "n"),
                             "level-edges")
    n_open, n_closed = open_edges.count(), 0
    fresh = found(assets.join(_by_key(open_edges.select(F.col("src").alias("asset_id"))), "asset_id", "left_anti"), 0)
    level, touched = 0, None
    any_fresh = not fresh.isEmpty()
    while any_fresh:
        closed = open_edges.join(_by_key(fresh.select(F.col("asset_id").alias("dst"))), "dst", "left_semi")
        counts = closed.groupBy("src", "n").agg(F.count(F.lit(1)).alias("c"))
        if touched is not None:
            counts = counts.unionByName(touched.where("c < n")).groupBy("src", "n").agg(F.sum("c").alias("c"))
        counts = materialize(counts, "level-counts")
        if touched is not None:
            release(touched)
        touched = counts
        level += 1
        fresh = found(touched.where("c = n").select(F.col("src").alias("asset_id")), level)
        n_fresh, n_done = touched.where("c = n").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        any_fresh, n_closed = n_fresh > 0, n_closed + n_done
        if n_open > n_closed >= n_open / 2:
            still_open = materialize(unfinished(), "level-edges")
            release(open_edges)
            open_edges, n_open, n_closed = still_open, n_open - n_closed, 0
    if n_open > n_closed:
        left = unfinished().select("src").distinct().count()
        raise ValueError(f"dependency graph has a cycle: {left} nodes on or behind it have no level")
    return all_found()


def criticality_score(c: Column) -> Column:
    key = F.upper(c)
    chain = None
    for name, s in CRITICALITY_SCORE.items():
        chain = F.when(key == name, F.lit(s)) if chain is None else chain.when(key == name, F.lit(s))
    return chain.otherwise(F.lit(CRITICALITY_DEFAULT))


def weighted_score(risk: Column, financial: Column, customer: Column, regulated: Column, complexity: Column,
                   weights: tuple[float, float, float] = PLAN_WEIGHTS) -> Column:
    """w1*risk + w2*business + w3/complexity, complexity number = ordinal + 1."""
    business = (F.lit(0.5) * financial.cast("double") + F.lit(0.3) * customer.cast("double")
                + F.lit(0.2) * regulated.cast("double"))
    cx = F.when(complexity == "LOW", F.lit(1.0)).when(complexity == "MEDIUM", F.lit(2.0)) \
        .when(complexity == "HIGH", F.lit(3.0)).otherwise(F.lit(2.0))
    return (F.lit(weights[0]) * risk + F.lit(weights[1]) * business + F.lit(weights[2]) * (F.lit(1.0) / cx))


def reasoning(df: DataFrame) -> Column:
    """E.g. 'critical, RSA-2048, internet-facing, low complexity' (NULL parts skipped)."""
    alg = F.when(F.col("algorithm").isNotNull(),
                 F.concat_ws("-", F.col("algorithm"), F.when(F.col("key_size") > 0, F.col("key_size").cast("string"))))
    return F.concat_ws(
        ", ",
        F.lower(F.col("criticality")),
        alg,
        F.when(F.col("internet_accessible") == 1, F.lit("internet-facing")),
        F.concat(F.lower(F.col("migration_complexity")), F.lit(" complexity")),
    )


def baseline_plan(items: DataFrame, n_phases: int = 4) -> DataFrame:
    """Order by criticality score x vulnerable (desc), asset_id; split into n_phases
    equal runs (first n % k phases one larger)."""
    key = criticality_score(F.col("criticality")) * F.coalesce(F.col("quantum_vulnerable").cast("double"), F.lit(0.0))
    d = items.withColumn("baseline_key", key)
    # order-preserving bucket: key descending (key in [0, 1]) then asset id range
    d = d.withColumn("_b", (F.floor((F.lit(1.0) - F.col("baseline_key")) * F.lit(1000)).cast("long") * F.lit(1 << 40)
                            + F.floor(F.col("asset_id") / F.lit(BUCKETS)).cast("long")))
    n = d.count()
    r = bucketed_row_number(d, [], "_b", [F.col("asset_id").asc()], "rank")
    q, rem = divmod(n, n_phases)
    big = rem * (q + 1)
    rank = F.col("rank")
    phase = F.when(rank <= big, F.floor((rank - 1) / (q + 1))).otherwise(
        F.lit(rem) + F.floor((rank - 1 - big) / F.lit(max(q, 1)))) + 1
    return r.withColumn("phase", phase.cast("int")).drop("_b")


def weighted_plan(items: DataFrame, levels: DataFrame, cap: int = HIGH_PER_PHASE) -> DataFrame:
    """Level first; HIGH items get sub-phase ceil(rn / cap) within their level, others 1;
    global phase = sub-phase + sum of max sub-phases of earlier levels; rank within phase (W5)."""
    d = items.join(_by_key(levels), "asset_id").select(
        "asset_id", "level", (F.col("migration_complexity") == "HIGH").cast("int").alias("is_high"),
        weighted_score(F.col("risk_score"), F.col("financial_data"), F.col("customer_data"),
                       F.col("regulated_system"), F.col("migration_complexity")).alias("score"))
    # the two exact row numbers are nested and each reads its input twice (counts, then
    # rows): their inputs are written once, as four narrow columns; the items' other
    # columns are joined to the result by key
    d = materialize(d, "wplan_items")
    d = score_row_number(d, ["level", "is_high"], "score", "asset_id", "rn_c")
    d = materialize(d.withColumn("sub_phase", F.when(F.col("is_high") == 1, F.ceil(F.col("rn_c") / F.lit(cap)))
                                 .otherwise(F.lit(1)).cast("int")).drop("rn_c"), "wplan_subphases")
    span = d.groupBy("level").agg(F.max("sub_phase").cast("long").alias("span"))
    offs = rows_before(span, [], "level", "span", "_lvl_before").select("level", "_lvl_before")
    d = d.join(offs, "level").withColumn("phase", (F.col("_lvl_before") + F.col("sub_phase")).cast("int"))
    d = score_row_number(d.drop("_lvl_before"), ["phase"], "score", "asset_id", "rank")
    return d.join(_by_key(items), "asset_id")


def plan_violations(plan: DataFrame, edges: DataFrame) -> DataFrame:
    """Dependencies scheduled in the same or a later phase than their dependent (must be 0)."""
    p = plan.select("asset_id", "phase")
    j = edges.join(p.select(F.col("asset_id").alias("src"), F.col("phase").alias("src_phase")), "src") \
        .join(p.select(F.col("asset_id").alias("dst"), F.col("phase").alias("dst_phase")), "dst")
    return j.agg(F.count(F.lit(1)).alias("n_edges"),
                 F.count_if(F.col("dst_phase") >= F.col("src_phase")).alias("violations"))


def phase_summary(plan: DataFrame) -> DataFrame:
    """O6 (flat form): items and HIGH items per phase; the plan itself is written partitioned by phase."""
    return plan.groupBy("phase").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(F.col("migration_complexity") == "HIGH").alias("n_high"),
        F.min("level").alias("level"),
    )


def _baseline_ranks(baseline: DataFrame) -> DataFrame:
    """(asset_id, rb, rank_b): average rank of the baseline order's ties (equal baseline_key).
    The tie table has one row per distinct key (criticality score x vulnerable flag)."""
    ties = baseline.groupBy("baseline_key").agg(F.count(F.lit(1)).alias("_n"), F.min("rank").alias("_first"))
    return baseline.join(ties, "baseline_key").select(
        "asset_id", (F.col("_first") + (F.col("_n") - 1) / 2.0).alias("rb"), F.col("rank").alias("rank_b"))


def average_rank_desc(df: DataFrame, key: str, score: str, buckets: int = BUCKETS) -> DataFrame:
    """(key, avg_rank): 1-based rank of `score` descending, ties averaged (Spearman ranks).

    No global window: distinct scores are counted first (a partial aggregation, so a
    score held by a third of all rows is one row), rows above each distinct score come
    from per-bucket prefix sums (bucket = coarse score range, at most `buckets` + 1 rows)
    plus a window inside the bucket over distinct scores only; the rank is then joined
    back on the score (AQE splits a hot score on the row side). Scores lie in [0, 1].
    """
    s = F.col(score).cast("double")
    d = df.select(key, s.alias("_s")).where(F.col("_s").isNotNull())
    g = d.groupBy("_s").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_b", F.least(F.greatest(F.floor((F.lit(1.0) - F.col("_s")) * F.lit(buckets)), F.lit(0)),
                      F.lit(buckets)).cast("int"))
    per_b = g.groupBy("_b").agg(F.sum("_n").alias("_nb"))
    wb = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = per_b.select("_b", F.coalesce(F.sum("_nb").over(wb), F.lit(0)).alias("_before_b"))
    wi = Window.partitionBy("_b").orderBy(F.col("_s").desc()).rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumn("_before_in", F.coalesce(F.sum("_n").over(wi), F.lit(0))).join(F.broadcast(offs), "_b")
    g = g.select("_s", (F.col("_before_b") + F.col("_before_in") + (F.col("_n") + 1) / 2.0).alias("avg_rank"))
    return d.join(g, "_s").select(key, "avg_rank")


def rank_agreement(baseline: DataFrame, weighted: DataFrame, k: int = 100) -> DataFrame:
    """Spearman (average ranks for ties) between the two orders, and top-k overlap."""
    b = _baseline_ranks(baseline)
    wr = weighted.select("asset_id", F.col("_grank").alias("rw"))
    j = b.join(wr, "asset_id")
    return j.agg(
        F.corr("rb", "rw").alias("spearman"),
        (F.count_if((F.col("rank_b") <= k) & (F.col("rw") <= k)) / F.lit(float(k))).alias("topk_overlap"),
    )


def system_comparison(baseline: DataFrame, weighted: DataFrame, expert: DataFrame, k: int = 100,
                      expert_col: str = "risk_score") -> DataFrame:
    """Each system's migration order against the expert order (expert score descending):
    Spearman on average ranks, and the share of the expert's top-k that the system also puts
    in its top k. The expert top-k is a distributed take-ordered (k rows per task, then k)."""
    er = average_rank_desc(expert, "asset_id", expert_col).withColumnRenamed("avg_rank", "re")
    top = expert.orderBy(F.col(expert_col).desc(), F.col("asset_id").asc()).limit(k) \
        .select("asset_id", F.lit(1).alias("_top_e"))
    systems = {
        "baseline": _baseline_ranks(baseline).select("asset_id", F.col("rb").alias("r"), F.col("rank_b").alias("pos")),
        "weighted": weighted.select("asset_id", F.col("_grank").alias("r"), F.col("_grank").alias("pos")),
    }
    out = None
    for name, sr in systems.items():
        j = sr.join(er, "asset_id").join(F.broadcast(top), "asset_id", "left")
        a = j.agg(F.corr("r", "re").alias("spearman"),
                  (F.count_if((F.col("pos") <= k) & (F.col("_top_e") == 1)) / F.lit(float(k))).alias("topk_overlap"),
                  F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("system"), "spearman", "topk_overlap", "n")
        out = a if out is None else out.unionByName(a)
    return out


def system_ranks(baseline: DataFrame, weighted: DataFrame) -> dict[str, DataFrame]:
    """(asset_id, rank) of each migration order, ties averaged."""
    return {"baseline": _baseline_ranks(baseline).select("asset_id", F.col("rb").alias("rank")),
            "weighted": weighted.select("asset_id", F.col("_grank").cast("double").alias("rank"))}


def global_order(weighted: DataFrame) -> DataFrame:
    """Global position in the weighted plan: (phase, rank) -> 1..n, from per-phase counts."""
    counts = weighted.groupBy("phase").agg(F.count(F.lit(1)).alias("_c"))
    offs = rows_before(counts, [], "phase", "_c", "_before").select("phase", "_before")
    return weighted.join(offs, "phase").withColumn("_grank", F.col("_before") + F.col("rank")).drop("_before")
