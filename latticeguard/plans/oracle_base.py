"""DuckDB oracle SQL: the fixture mapping and label as plain SQL CTEs.

Every oracle query is `WITH <base CTEs> SELECT ...` over the driver's tables,
written independently of the Spark plan so the two engines cross-check.
"""
from __future__ import annotations

import math

from ..config import (COMPLEXITY_DEFAULT, COMPLEXITY_SCORE, CRITICALITY_DEFAULT, CRITICALITY_SCORE,
                      DEFAULT_THRESHOLDS, LabelWeights, VULN_TABLE)
from ..schemas import ECC_FAMILY
from ..sources.inventory import (AS_OF_DATE, ALGORITHM_BY_PART_MOD, CERT_LIFETIME_DAYS, COMPLEXITY_BY_MOD5,
                                 CRITICALITY_BY_SEGMENT, ECC_KEY_SIZES, NETWORK_ZONES, REGULATED_REGIONS,
                                 RSA_KEY_SIZES)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_pick(expr: str, values) -> str:
    parts = " ".join(f"WHEN {i} THEN {q(v) if isinstance(v, str) else v}" for i, v in enumerate(values))
    return f"CASE {expr} {parts} END"


def case_map(expr: str, mapping: dict, default=None) -> str:
    parts = " ".join(f"WHEN {q(k)} THEN {v if not isinstance(v, str) else q(v)}" for k, v in mapping.items())
    tail = f" ELSE {default}" if default is not None else ""
    return f"CASE {expr} {parts}{tail} END"


def dbl(x: float) -> str:
    return repr(float(x)) + "e0" if "e" not in repr(float(x)) else repr(float(x))


def bucket_sql(expr: str) -> str:
    last = DEFAULT_THRESHOLDS[-1][0]
    parts = " ".join(f"WHEN {expr} >= {dbl(m)} THEN {q(p)}" for p, m in DEFAULT_THRESHOLDS)
    return f"CASE WHEN {expr} IS NULL THEN NULL WHEN isnan({expr}) THEN {q(last)} {parts} ELSE {q(last)} END"


def rank_sql(expr: str) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = {q(p)} THEN {i}" for i, (p, _) in enumerate(DEFAULT_THRESHOLDS)) + " END"


def clip_sql(expr: str) -> str:
    return f"(CASE WHEN isnan({expr}) THEN {expr} WHEN {expr} < 0.0e0 THEN 0.0e0 WHEN {expr} > 1.0e0 THEN 1.0e0 ELSE {expr} END)"


def uniform_sql(key: str, seed: int, tag: str) -> str:
    h = f"md5(concat_ws(':', '{seed}', '{tag}', CAST({key} AS VARCHAR)))"
    return f"((CAST(('0x' || substr({h}, 1, 8)) AS BIGINT) + 0.5e0) / 4294967296.0e0)"


def normal_sql(key: str, seed: int, tag: str = "", std: float = 1.0) -> str:
    u1, u2 = uniform_sql(key, seed, tag + "a"), uniform_sql(key, seed, tag + "b")
    return f"({dbl(std)} * sqrt(-2.0e0 * ln({u1})) * cos({dbl(2.0 * math.pi)} * {u2}))"


def sort_hash_sql(key: str, seed: int) -> str:
    return f"md5(concat_ws(':', '{seed}', CAST({key} AS VARCHAR)))"


def rule_score_sql(w: LabelWeights = LabelWeights(), prefix: str = "") -> str:
    p = prefix
    exposure = f"(0.6e0 * CAST({p}internet_accessible AS DOUBLE) + 0.4e0 * CAST({p}has_public_cert AS DOUBLE))"
    weak = f"(CASE WHEN coalesce(CAST({p}quantum_vulnerable AS BOOLEAN), false) THEN 1.0e0 ELSE 0.1e0 END)"
    business = (f"(0.5e0 * CAST({p}financial_data AS DOUBLE) + 0.3e0 * CAST({p}customer_data AS DOUBLE)"
                f" + 0.2e0 * CAST({p}regulated_system AS DOUBLE))")
    crit = case_map(f"upper(CAST({p}criticality AS VARCHAR))", {k: dbl(v) for k, v in CRITICALITY_SCORE.items()},
                    dbl(CRITICALITY_DEFAULT))
    cx = case_map(f"upper(CAST({p}migration_complexity AS VARCHAR))", {k: dbl(v) for k, v in COMPLEXITY_SCORE.items()},
                  dbl(COMPLEXITY_DEFAULT))
    s = (f"({dbl(w.exposure)} * {exposure} + {dbl(w.criticality)} * {crit} + {dbl(w.algo_weakness)} * {weak}"
         f" + {dbl(w.complexity)} * {cx} + {dbl(w.business)} * {business})")
    s = (f"({s} + CASE WHEN coalesce(CAST({p}previous_incident_flag AS BOOLEAN), false) "
         f"THEN {dbl(w.incident_bump)} ELSE 0.0e0 END)")
    return clip_sql(s)


def _vuln_values() -> str:
    return ", ".join(f"({q(a)}, {'true' if v else 'false'}, {q(f)})" for a, v, f in VULN_TABLE)


def base_ctes(seed: int = 42) -> str:
    w = LabelWeights()
    alg = case_pick("l_partkey % 10", ALGORITHM_BY_PART_MOD)
    ecc = ", ".join(q(a) for a in ECC_FAMILY)
    crit = case_map("c_mktsegment", CRITICALITY_BY_SEGMENT)
    return f"""
vuln(algorithm, quantum_vulnerable, family) AS (VALUES {_vuln_values()}),
f_dedup AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_returnflag
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_returnflag DESC) AS rn
        FROM lineitem) WHERE rn = 1
),
f_base AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS finding_id,
         o_custkey AS asset_id, l_orderkey AS order_key, l_linenumber AS line_no,
         CASE WHEN l_returnflag = 'N' THEN 'repo_scan' ELSE 'tls_scan' END AS source,
         {alg} AS algorithm, l_suppkey, l_partkey, l_shipdate AS discovered_at, o_orderdate
  FROM f_dedup JOIN orders ON l_orderkey = o_orderkey
),
findings AS (
  SELECT finding_id, asset_id, order_key, line_no, source, f_base.algorithm,
         CAST(CASE WHEN f_base.algorithm = 'RSA' THEN {case_pick('l_suppkey % 4', RSA_KEY_SIZES)}
              WHEN f_base.algorithm IN ({ecc}) THEN {case_pick('l_suppkey % 3', ECC_KEY_SIZES)} END AS INTEGER) AS key_size,
         CASE WHEN source = 'tls_scan' THEN f_base.algorithm END AS signature_algorithm,
         CASE WHEN source = 'tls_scan' THEN 'CA-' || CAST(l_suppkey % 7 AS VARCHAR) END AS issuer,
         CASE WHEN source = 'tls_scan' THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL {CERT_LIFETIME_DAYS} DAY AS TIMESTAMP) END AS not_after,
         discovered_at, vuln.quantum_vulnerable, l_partkey, l_suppkey
  FROM f_base LEFT JOIN vuln ON f_base.algorithm = vuln.algorithm
),
incidents AS (SELECT DISTINCT user_id AS asset_id FROM events WHERE event_type = 'error'),
first_orders AS (SELECT o_custkey AS asset_id, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey),
assets AS (
  SELECT c_custkey AS asset_id,
         'asset-' || CAST(c_custkey AS VARCHAR) || '.internal' AS hostname,
         'repo/asset-' || CAST(c_custkey AS VARCHAR) AS repo,
         n_name AS data_asset,
         {crit} AS criticality,
         {case_pick('c_nationkey % 4', NETWORK_ZONES)} AS network_zone,
         CAST(c_custkey % 2 AS INTEGER) AS internet_accessible,
         CAST(c_acctbal > 5000 AS INTEGER) AS financial_data,
         CAST(c_custkey % 3 = 0 AS INTEGER) AS customer_data,
         CAST(n_regionkey IN ({', '.join(str(r) for r in REGULATED_REGIONS)}) AS INTEGER) AS regulated_system,
         {case_pick('c_custkey % 5', COMPLEXITY_BY_MOD5)} AS migration_complexity,
         CAST(500 + (c_custkey * 7919) % 119500 AS INTEGER) AS loc_estimate,
         CAST(date_diff('day', CAST(first_order AS DATE), DATE '{AS_OF_DATE}') AS INTEGER) AS asset_age_days,
         CAST(CASE WHEN incidents.asset_id IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS previous_incident_flag
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN first_orders ON first_orders.asset_id = c_custkey
  LEFT JOIN incidents ON incidents.asset_id = c_custkey
),
edges AS (
  SELECT DISTINCT src, dst FROM (
    SELECT c_custkey AS src, c_custkey // 3 AS dst FROM customer WHERE c_custkey > 0
    UNION ALL SELECT c_custkey AS src, c_custkey // 5 AS dst FROM customer WHERE c_custkey > 0) e
  WHERE dst IN (SELECT c_custkey FROM customer)
),
deps AS (SELECT src AS asset_id, count(*) AS dependency_count FROM edges GROUP BY src),
primary_f AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id
         ORDER BY discovered_at DESC, order_key DESC, line_no DESC) AS rn FROM findings) WHERE rn = 1
),
rollup AS (
  SELECT asset_id, count(*) AS n_findings,
         count(*) FILTER (WHERE quantum_vulnerable) AS n_vulnerable,
         count(*) FILTER (WHERE quantum_vulnerable IS NULL) AS n_unknown,
         max(discovered_at) AS last_discovered_at
  FROM findings GROUP BY asset_id
),
features AS (
  SELECT a.asset_id, '1.0.0' AS schema_version,
         coalesce(CAST(p.algorithm = 'RSA' AS INTEGER), 0) AS algorithm_RSA,
         coalesce(CAST(p.algorithm IN ({ecc}) AS INTEGER), 0) AS algorithm_ECC,
         coalesce(p.key_size, 0) AS key_size,
         coalesce(CAST(p.quantum_vulnerable AS INTEGER), 0) AS quantum_vulnerable,
         a.internet_accessible,
         coalesce(CAST(p.source = 'tls_scan' AS INTEGER), 0) AS has_public_cert,
         a.network_zone, a.financial_data, a.customer_data, a.regulated_system, a.criticality,
         coalesce(d.dependency_count, 0) AS dependency_count,
         a.loc_estimate, a.migration_complexity, a.asset_age_days, a.previous_incident_flag,
         p.algorithm AS algorithm, p.quantum_vulnerable AS qv_raw,
         coalesce(r.n_findings, 0) AS n_findings
  FROM assets a LEFT JOIN primary_f p ON p.asset_id = a.asset_id
  LEFT JOIN deps d ON d.asset_id = a.asset_id
  LEFT JOIN rollup r ON r.asset_id = a.asset_id
),
rule_labelled AS (SELECT *, {rule_score_sql(w)} AS risk_score FROM features),
labelled AS (
  SELECT * EXCLUDE (risk_score), {clip_sql(f"(risk_score + {normal_sql('asset_id', seed, '', w.noise_std)})")} AS risk_score
  FROM rule_labelled
)"""


def with_base(body: str, extra_ctes: str = "", seed: int = 42) -> str:
    ctes = base_ctes(seed)
    if extra_ctes:
        ctes = ctes + ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"
