"""Derive the inventory tables (findings, assets, certificates, scan attempts,
dependency edges, graph entities) from the driver's TPC-H-style tables.

The mapping is documented in FIXTURES.md (part B). Every derivation is a
declarative DataFrame plan: dedupe by partial aggregation (max of a struct),
equi-joins on keys, and broadcast only of fixed-size dimensions (the
10-row vulnerability table and the 25-row nation table).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import VULN_TABLE
from ..schemas import ECC_FAMILY
from .tables import Tables

# Fixed values of the fixture mapping (FIXTURES.md B1).
ALGORITHM_BY_PART_MOD = (
    "RSA", "RSA", "RSA", "ECDSA", "EdDSA", "ECDH", "ML-KEM", "ML-DSA", "X25519MLKEM768", "FOO-1",
)
RSA_KEY_SIZES = (1024, 2048, 3072, 4096)
ECC_KEY_SIZES = (256, 384, 521)
CRITICALITY_BY_SEGMENT = {
    "AUTOMOBILE": "CRITICAL", "BUILDING": "HIGH", "FURNITURE": "MEDIUM",
    "MACHINERY": "MEDIUM", "HOUSEHOLD": "LOW",
}
NETWORK_ZONES = ("public", "dmz", "internal", "isolated")
COMPLEXITY_BY_MOD5 = ("LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH")
REGULATED_REGIONS = (1, 3)
AS_OF_DATE = "2001-11-05"
CERT_LIFETIME_DAYS = 730
SCAN_ERROR_REASONS = ("timeout", "refused", "non-TLS")


def _pick(index: Column, values) -> Column:
    """Literal lookup by small integer index, as a CASE chain (codegen-friendly)."""
    chain = None
    for i, v in enumerate(values):
        chain = F.when(index == i, F.lit(v)) if chain is None else chain.when(index == i, F.lit(v))
    return chain


def vuln_table(spark: SparkSession) -> DataFrame:
    """Fixed 10-row dimension; safe to broadcast."""
    schema = T.StructType([
        T.StructField("algorithm", T.StringType(), False),
        T.StructField("quantum_vulnerable", T.BooleanType(), True),
        T.StructField("family", T.StringType(), True),
    ])
    return spark.createDataFrame(list(VULN_TABLE), schema)


def classify(df: DataFrame, vuln: DataFrame, algorithm_col: str = "algorithm") -> DataFrame:
    """Broadcast LEFT join; unknown algorithms keep the row with NULL vulnerability."""
    v = vuln.select(F.col("algorithm").alias("_alg"), "quantum_vulnerable", "family")
    return (
        df.join(F.broadcast(v), F.col(algorithm_col) == F.col("_alg"), "left")
        .drop("_alg")
    )


def raw_findings(t: Tables) -> DataFrame:
    """One row per (order, line): the latest copy wins.

    Dedupe is a grouped max over a struct (lexicographic). The lines are shuffled once, by
    order: nearly all are unique, so combining them before the shuffle would sort each split
    and save next to nothing, and a join with the orders needs no second shuffle of them.
    """
    li = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
        "l_extendedprice", "l_returnflag",
    ).repartition("l_orderkey")
    latest = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.max(F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")).alias("w")
    )
    return latest.select("l_orderkey", "l_linenumber", "w.*")


def finding_id(order_key: Column, line_no: Column) -> Column:
    return F.concat_ws("-", order_key.cast("string"), line_no.cast("string"))


def findings(t: Tables) -> DataFrame:
    """Findings table (README finding contract) for every deduplicated line."""
    spark = t.spark
    f = raw_findings(t)
    # by key at every size: the deduplicated lines are partitioned by order already
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").hint("merge")
    j = f.join(orders, f.l_orderkey == orders.o_orderkey, "inner")
    alg = _pick(F.col("l_partkey") % 10, ALGORITHM_BY_PART_MOD)
    src = F.when(F.col("l_returnflag") == "N", F.lit("repo_scan")).otherwise(F.lit("tls_scan"))
    out = j.select(
        finding_id(F.col("l_orderkey"), F.col("l_linenumber")).alias("finding_id"),
        F.col("o_custkey").alias("asset_id"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_no"),
        src.alias("source"),
        alg.alias("algorithm"),
        F.col("l_suppkey"),
        F.col("l_shipdate").alias("discovered_at"),
        F.col("o_orderdate"),
        F.col("l_partkey"),
    )
    key_size = (
        F.when(F.col("algorithm") == "RSA", _pick(F.col("l_suppkey") % 4, RSA_KEY_SIZES))
        .when(F.col("algorithm").isin(*ECC_FAMILY), _pick(F.col("l_suppkey") % 3, ECC_KEY_SIZES))
        .cast("int")
    )
    is_tls = F.col("source") == "tls_scan"
    host = F.concat(F.lit("asset-"), F.col("asset_id").cast("string"), F.lit(".internal"))
    out = out.select(
        "finding_id", "asset_id", "order_key", "line_no", "source",
        F.struct(
            F.when(is_tls, host).alias("hostname"),
            F.when(~is_tls, F.concat(F.lit("repo/asset-"), F.col("asset_id").cast("string"))).alias("repo"),
            F.when(is_tls, F.lit(443)).alias("port"),
        ).alias("asset_hint"),
        "algorithm",
        key_size.alias("key_size"),
        F.when(is_tls, F.col("algorithm")).alias("signature_algorithm"),
        F.when(is_tls, F.concat(F.lit("CA-"), (F.col("l_suppkey") % 7).cast("string"))).alias("issuer"),
        F.when(is_tls, F.date_add(F.col("o_orderdate"), CERT_LIFETIME_DAYS).cast("timestamp_ntz")).alias("not_after"),
        F.create_map(
            F.lit("partkey"), F.col("l_partkey").cast("string"),
            F.lit("suppkey"), F.col("l_suppkey").cast("string"),
        ).alias("detail"),
        "discovered_at",
    )
    return classify(out, vuln_table(spark)).drop("family")


def incident_assets(t: Tables) -> DataFrame:
    """Customer ids with at least one `error` event (partial-aggregated distinct)."""
    return (
        t.events.where(F.col("event_type") == "error")
        .groupBy(F.col("user_id").alias("asset_id"))
        .agg(F.lit(1).alias("previous_incident_flag"))
    )


def dependency_edges(t: Tables) -> DataFrame:
    """Asset k depends on k div 3 and on k div 5 (k > 0); only targets that exist."""
    c = t.customer.select(F.col("c_custkey").alias("k"))
    e = c.where(F.col("k") > 0).select(
        F.col("k").alias("src"),
        F.explode(F.array(F.expr("k div 3"), F.expr("k div 5"))).alias("dst"),
    ).distinct()
    return e.join(c.select(F.col("k").alias("dst")), "dst", "left_semi").select("src", "dst")


def assets(t: Tables) -> DataFrame:
    """One row per customer with the declared (non-finding) attributes."""
    cust = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = t.nation.select("n_nationkey", "n_regionkey", "n_name")  # 25 rows by TPC-H spec
    first_order = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_order")
    )
    crit = F.col("c_mktsegment")
    crit_chain = None
    for seg, level in CRITICALITY_BY_SEGMENT.items():
        crit_chain = F.when(crit == seg, F.lit(level)) if crit_chain is None else crit_chain.when(crit == seg, F.lit(level))
    k = F.col("c_custkey")
    j = (
        cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
        .join(first_order, "c_custkey", "left")
        .join(incident_assets(t).withColumnRenamed("asset_id", "c_custkey"), "c_custkey", "left")
    )
    return j.select(
        k.alias("asset_id"),
        F.concat(F.lit("asset-"), k.cast("string"), F.lit(".internal")).alias("hostname"),
        F.concat(F.lit("repo/asset-"), k.cast("string")).alias("repo"),
        F.col("n_name").alias("data_asset"),
        crit_chain.alias("criticality"),
        _pick(F.col("c_nationkey") % 4, NETWORK_ZONES).alias("network_zone"),
        (k % 2).cast("int").alias("internet_accessible"),
        (F.col("c_acctbal") > 5000).cast("int").alias("financial_data"),
        (k % 3 == 0).cast("int").alias("customer_data"),
        F.col("n_regionkey").isin(*REGULATED_REGIONS).cast("int").alias("regulated_system"),
        _pick(k % 5, COMPLEXITY_BY_MOD5).alias("migration_complexity"),
        (F.lit(500) + (k * 7919) % 119500).cast("int").alias("loc_estimate"),
        F.datediff(F.lit(AS_OF_DATE).cast("date"), F.col("first_order").cast("date")).alias("asset_age_days"),
        F.coalesce(F.col("previous_incident_flag"), F.lit(0)).cast("int").alias("previous_incident_flag"),
    )


def certificates(t: Tables) -> DataFrame:
    """One certificate per order: cert-<orderkey>, owned by the order's customer."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    alg = _pick(F.col("o_orderkey") % 10, ALGORITHM_BY_PART_MOD)
    return o.select(
        F.concat(F.lit("cert-"), F.col("o_orderkey").cast("string")).alias("cert_id"),
        F.col("o_custkey").alias("asset_id"),
        alg.alias("public_key_algorithm"),
        F.col("o_orderdate").alias("not_before"),
        F.date_add(F.col("o_orderdate"), CERT_LIFETIME_DAYS).cast("timestamp_ntz").alias("not_after"),
    )


def scan_attempts(t: Tables) -> DataFrame:
    """P13 input: one TLS attempt per order; status P is a failure with a reason."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    failed = F.col("o_orderstatus") == "P"
    return o.select(
        F.concat(F.lit("asset-"), F.col("o_custkey").cast("string"), F.lit(".internal:443")).alias("target"),
        F.col("o_orderkey").alias("attempt_id"),
        F.when(failed, F.lit("error")).otherwise(F.lit("ok")).alias("outcome"),
        F.when(failed, _pick(F.col("o_orderkey") % 3, SCAN_ERROR_REASONS)).alias("reason"),
        F.col("o_orderdate").alias("attempted_at"),
    )
