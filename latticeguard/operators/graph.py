"""Property graph as two tables and its fixed queries.

(Application)-[:USES]->(Certificate)-[:SIGNED_WITH]->(Algorithm)-[:PROTECTS]->(DataAsset)

Nodes and edges are DataFrames; each fixed query is a chain of equi-joins on
the edge table filtered by relationship, so Catalyst plans it like any join
(broadcasting the small algorithm / data-asset sides, sort-merge for the
application-certificate side). No graph library and no driver-side traversal.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ECC_FAMILY
from ..sources.inventory import ALGORITHM_BY_PART_MOD, ECC_KEY_SIZES, RSA_KEY_SIZES, _pick, vuln_table

# Fixed mapping (ours): data-asset classification by region key mod 3.
DATA_CLASSES = ("customer", "financial", "internal")

NODE_COLS = ("node_type", "node_id", "name", "criticality", "key_size", "quantum_vulnerable", "classification",
             "not_after")


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def cert_algorithms(orders: DataFrame) -> DataFrame:
    """Per certificate (one per order): owning asset, algorithm, key size, validity."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    alg = _pick(F.col("o_orderkey") % 10, ALGORITHM_BY_PART_MOD)
    ks = (F.when(F.col("algorithm") == "RSA", _pick(F.col("o_orderkey") % 4, RSA_KEY_SIZES))
          .when(F.col("algorithm").isin(*ECC_FAMILY), _pick(F.col("o_orderkey") % 3, ECC_KEY_SIZES)).cast("int"))
    c = o.select(
        F.concat(F.lit("cert-"), F.col("o_orderkey").cast("string")).alias("cert_id"),
        F.col("o_custkey").alias("asset_id"),
        alg.alias("algorithm"),
        F.date_add(F.col("o_orderdate"), 730).alias("not_after"),
        F.col("o_orderkey"),
    ).withColumn("key_size", ks)
    return c.withColumn(
        "alg_id", F.concat_ws("-", F.col("algorithm"), F.col("key_size").cast("string"))
    ).drop("o_orderkey")


def build(assets: DataFrame, orders: DataFrame, nation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges). Node ids: asset-<k>, cert-<orderkey>, <alg>[-<key size>], <nation name>."""
    spark = assets.sparkSession
    certs = cert_algorithms(orders)
    apps = assets.select(F.concat(F.lit("asset-"), F.col("asset_id").cast("string")).alias("app_id"),
                         "asset_id", "criticality", "data_asset")
    vt = vuln_table(spark).select("algorithm", "quantum_vulnerable")
    data = nation.select(F.col("n_name").alias("data_asset"),
                         _pick(F.col("n_regionkey") % 3, DATA_CLASSES).alias("classification"))

    app_nodes = apps.select(F.lit("Application").alias("node_type"), F.col("app_id").alias("node_id"),
                            F.col("app_id").alias("name"), "criticality", _null("int").alias("key_size"),
                            _null("boolean").alias("quantum_vulnerable"), _null("string").alias("classification"),
                            _null("date").alias("not_after"))
    cert_nodes = certs.select(F.lit("Certificate").alias("node_type"), F.col("cert_id").alias("node_id"),
                              F.col("cert_id").alias("name"), _null("string").alias("criticality"),
                              _null("int").alias("key_size"), _null("boolean").alias("quantum_vulnerable"),
                              _null("string").alias("classification"), "not_after")
    algs = certs.groupBy("alg_id", "algorithm", "key_size").agg(F.lit(1).alias("_x")) \
        .join(F.broadcast(vt), "algorithm", "left")
    alg_nodes = algs.select(F.lit("Algorithm").alias("node_type"), F.col("alg_id").alias("node_id"),
                            F.col("algorithm").alias("name"), _null("string").alias("criticality"), "key_size",
                            "quantum_vulnerable", _null("string").alias("classification"),
                            _null("date").alias("not_after"))
    data_nodes = data.select(F.lit("DataAsset").alias("node_type"), F.col("data_asset").alias("node_id"),
                             F.col("data_asset").alias("name"), _null("string").alias("criticality"),
                             _null("int").alias("key_size"), _null("boolean").alias("quantum_vulnerable"),
                             "classification", _null("date").alias("not_after"))
    nodes = app_nodes.unionByName(cert_nodes).unionByName(alg_nodes).unionByName(data_nodes)

    cj = certs.join(apps.select("asset_id", "app_id", "data_asset"), "asset_id")
    uses = cj.select(F.lit("Application").alias("src_type"), F.col("app_id").alias("src"), F.lit("USES").alias("rel"),
                     F.lit("Certificate").alias("dst_type"), F.col("cert_id").alias("dst"))
    signed = certs.select(F.lit("Certificate").alias("src_type"), F.col("cert_id").alias("src"),
                          F.lit("SIGNED_WITH").alias("rel"), F.lit("Algorithm").alias("dst_type"),
                          F.col("alg_id").alias("dst"))
    protects = cj.groupBy("alg_id", "data_asset").agg(F.lit(1).alias("_x")).select(
        F.lit("Algorithm").alias("src_type"), F.col("alg_id").alias("src"), F.lit("PROTECTS").alias("rel"),
        F.lit("DataAsset").alias("dst_type"), F.col("data_asset").alias("dst"))
    edges = uses.unionByName(signed).unionByName(protects)
    return nodes, edges


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str], recency: str | None = None) -> DataFrame:
    """MERGE by key, incoming wins; applying the same batch twice equals once.

    Of several incoming rows of one key, the one with the highest `recency` (a column of the
    batch only) wins, ties by the row's own values: the winner is one whole row and doesn't depend
    on the order of the rows. A partial aggregation per key, so a hot key is combined map-side."""
    cols = [c for c in current.columns if c not in keys]
    a = current.withColumn("_rank", F.lit(-1).cast("long"))
    when = F.col(recency).cast("long") if recency else F.lit(0).cast("long")
    b = incoming.select(*current.columns, F.greatest(when, F.lit(0).cast("long")).alias("_rank"))
    rows = a.unionByName(b).groupBy(*keys).agg(F.max(F.struct("_rank", *cols)).alias("_row"))
    return rows.select(*(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in current.columns))


def _rel(edges: DataFrame, rel: str, src: str, dst: str) -> DataFrame:
    return edges.where(F.col("rel") == rel).select(F.col("src").alias(src), F.col("dst").alias(dst))


def critical_apps_on_algorithm(nodes: DataFrame, edges: DataFrame, algorithm: str = "RSA",
                               criticality: str = "CRITICAL") -> DataFrame:
    """(a:Application {criticality})-USES->(c)-SIGNED_WITH->(alg {name}); one row per path."""
    apps = nodes.where((F.col("node_type") == "Application") & (F.col("criticality") == criticality)) \
        .select(F.col("node_id").alias("app"))
    algs = nodes.where((F.col("node_type") == "Algorithm") & (F.col("name") == algorithm)) \
        .select(F.col("node_id").alias("alg"), F.col("name").alias("alg_name"), "key_size")
    return (apps.join(_rel(edges, "USES", "app", "cert"), "app")
            .join(_rel(edges, "SIGNED_WITH", "cert", "alg"), "cert")
            .join(F.broadcast(algs), "alg")  # algorithm nodes: bounded by the vulnerability table x key sizes
            .select("app", "cert", "alg_name", "key_size"))


def downstream_of_certificates(edges: DataFrame) -> DataFrame:
    """For every certificate, its algorithm and the data assets that algorithm protects
    (their number, and their names in order, comma-separated)."""
    per_alg = _rel(edges, "PROTECTS", "alg", "data").groupBy("alg").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_list("data")), ",").alias("names"))
    # one row per algorithm node: bounded by the vulnerability table x key sizes
    return _rel(edges, "SIGNED_WITH", "cert", "alg").join(F.broadcast(per_alg), "alg", "left").select(
        "cert", "alg", F.coalesce(F.col("n"), F.lit(0)).alias("n_data_assets"),
        F.coalesce(F.col("names"), F.lit("")).alias("data_assets"))


def algorithms_protecting(nodes: DataFrame, edges: DataFrame, classification: str = "customer") -> DataFrame:
    """Algorithms with a PROTECTS edge into data of a class; walk back from DataAsset."""
    data = nodes.where((F.col("node_type") == "DataAsset") & (F.col("classification") == classification)) \
        .select(F.col("node_id").alias("data"))
    return _rel(edges, "PROTECTS", "alg", "data").join(data, "data").groupBy("alg").agg(
        F.count(F.lit(1)).alias("n_data_assets"))


def apps_per_algorithm(edges: DataFrame) -> DataFrame:
    """Distinct applications per algorithm (distinct pairs first, then a count)."""
    pairs = _rel(edges, "USES", "app", "cert").join(_rel(edges, "SIGNED_WITH", "cert", "alg"), "cert") \
        .select("alg", "app").distinct()
    return pairs.groupBy("alg").agg(F.count(F.lit(1)).alias("n_apps"))


def data_only_behind_vulnerable(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Data assets whose every protecting algorithm is known vulnerable (unknown = not proven)."""
    algs = nodes.where(F.col("node_type") == "Algorithm").select(F.col("node_id").alias("alg"), "quantum_vulnerable")
    p = _rel(edges, "PROTECTS", "alg", "data").join(F.broadcast(algs), "alg", "left")
    return p.groupBy("data").agg(
        F.bool_and(F.coalesce(F.col("quantum_vulnerable"), F.lit(False))).alias("all_vulnerable"),
        F.count(F.lit(1)).alias("n_algorithms"),
    ).where(F.col("all_vulnerable")).select("data", "n_algorithms")


def apps_without_safe_path(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Applications with no path to an algorithm known safe (left anti join)."""
    safe = nodes.where((F.col("node_type") == "Algorithm") & (F.col("quantum_vulnerable") == F.lit(False))) \
        .select(F.col("node_id").alias("alg"))
    safe_apps = _rel(edges, "USES", "app", "cert").join(_rel(edges, "SIGNED_WITH", "cert", "alg"), "cert") \
        .join(F.broadcast(safe), "alg").select("app")
    apps = nodes.where(F.col("node_type") == "Application").select(F.col("node_id").alias("app"))
    return apps.join(safe_apps, "app", "left_anti")


def expiring_vulnerable_certs(nodes: DataFrame, edges: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Vulnerable certificates whose not_after falls within [as_of, as_of + days]."""
    certs = nodes.where(F.col("node_type") == "Certificate").select(F.col("node_id").alias("cert"), "not_after")
    algs = nodes.where(F.col("node_type") == "Algorithm").select(F.col("node_id").alias("alg"), "quantum_vulnerable")
    j = certs.join(_rel(edges, "SIGNED_WITH", "cert", "alg"), "cert").join(F.broadcast(algs), "alg")
    d = F.datediff(F.col("not_after"), F.lit(as_of).cast("date"))
    return j.where(F.col("quantum_vulnerable") & (d >= 0) & (d <= days)).select(
        "cert", "alg", "not_after", d.alias("days_to_expiry"))


def node_counts(nodes: DataFrame) -> DataFrame:
    """R3."""
    return nodes.groupBy("node_type").agg(F.count(F.lit(1)).alias("n_nodes"))

