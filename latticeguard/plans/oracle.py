"""DuckDB oracle SQL, one string per registered query that is SQL-expressible."""
from __future__ import annotations

from ..config import DEFAULT_THRESHOLDS
from ..schemas import FEATURE_NAMES
from .oracle_base import bucket_sql, dbl, q, with_base

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


# --- step 1-2: inventory -------------------------------------------------------
oracle("asset_inventory", with_base("SELECT * FROM assets"))

oracle("finding_dedupe", with_base("""
SELECT finding_id, asset_id, source, algorithm, key_size, quantum_vulnerable, signature_algorithm, issuer,
       CAST(not_after AS DATE) AS not_after, CAST(discovered_at AS DATE) AS discovered_at
FROM findings"""))

oracle("classify_findings", with_base("""
SELECT algorithm, quantum_vulnerable, count(*) AS n_findings FROM findings GROUP BY algorithm, quantum_vulnerable"""))

oracle("asset_features", with_base("SELECT * EXCLUDE (qv_raw) FROM features"))

oracle("feature_profile", with_base(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg(CAST({c} IS NULL AS DOUBLE)), 9) AS null_rate, count(*) AS row_count FROM features"
    for c in FEATURE_NAMES)))

oracle("finding_rollup", with_base("""
SELECT r.asset_id, r.n_findings, r.n_vulnerable, r.n_unknown, CAST(r.last_discovered_at AS DATE) AS last_discovered_at,
       p.finding_id AS primary_finding_id, p.algorithm AS primary_algorithm
FROM rollup r JOIN primary_f p ON p.asset_id = r.asset_id"""))

# --- step 3: labels and buckets --------------------------------------------------
oracle("rule_label", with_base("SELECT asset_id, round(risk_score, 9) AS risk_score FROM rule_labelled"))
oracle("rule_label_noisy", with_base("SELECT asset_id, round(risk_score, 9) AS risk_score FROM labelled"))
oracle("priority_buckets", with_base(f"""
SELECT {bucket_sql('risk_score')} AS priority, count(*) AS n_assets, round(avg(risk_score), 6) AS mean_score
FROM rule_labelled GROUP BY 1"""))

_BARS = " UNION ALL ".join(f"SELECT {q(p)} AS priority, {dbl(m)} AS bar" for p, m in DEFAULT_THRESHOLDS)
oracle("deployment_priorities", with_base(f"""
SELECT deployment, priority, count(*) AS n_assets
FROM (SELECT s.asset_id, s.asset_id % 25 AS deployment,
             coalesce(arg_max(b.priority, b.min_score) FILTER (WHERE s.risk_score >= b.min_score), arg_min(b.priority, b.min_score)) AS priority
      FROM rule_labelled s JOIN (SELECT CAST(n_nationkey AS BIGINT) AS d, priority, bar - CAST(n_nationkey % 5 AS DOUBLE) / 40 AS min_score
                                 FROM nation, ({_BARS})) b ON b.d = s.asset_id % 25
      GROUP BY s.asset_id)
GROUP BY deployment, priority"""))

# --- step 4: strata, splits, folds ----------------------------------------------
STRATA_CTES = """
edges_q AS (SELECT quantile_cont(risk_score, [0.0e0, 0.25e0, 0.5e0, 0.75e0, 1.0e0]) AS e FROM labelled),
strata AS (
  SELECT l.*, CASE WHEN len(list_distinct(e)) < 2 THEN NULL
         ELSE CAST(greatest(len(list_filter(list_distinct(e), lambda x: x < risk_score)) - 1, 0) AS INTEGER) END AS stratum
  FROM labelled l, edges_q),
st AS (SELECT asset_id, stratum, coalesce(stratum, -1) AS g, md5(concat_ws(':', '42', CAST(asset_id AS VARCHAR))) AS h
       FROM strata),
sizes AS (SELECT g, count(*) AS n_s FROM st GROUP BY g),
alloc0 AS (SELECT g, n_s, CAST(floor(0.2e0 * n_s) AS BIGINT) AS base, 0.2e0 * n_s - floor(0.2e0 * n_s) AS frac,
                  CAST(ceil(0.2e0 * sum(n_s) OVER ()) AS BIGINT) AS n_test FROM sizes),
alloc AS (SELECT g, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, g) <= n_test - sum(base) OVER () THEN 1 ELSE 0 END
                 AS n_alloc FROM alloc0),
split_s AS (SELECT asset_id, stratum,
                   CASE WHEN row_number() OVER (PARTITION BY st.g ORDER BY h) <= n_alloc THEN 'test' ELSE 'train' END AS split
            FROM st JOIN alloc ON st.g = alloc.g),
hashed AS (SELECT asset_id, md5(concat_ws(':', '42', CAST(asset_id AS VARCHAR))) AS h, count(*) OVER () AS n FROM labelled),
split_p AS (SELECT asset_id, CASE WHEN row_number() OVER (ORDER BY h) <= ceil(0.2e0 * n) THEN 'test' ELSE 'train' END AS split
            FROM hashed),
folds AS (SELECT asset_id, CAST(ntile(5) OVER (ORDER BY h) - 1 AS INTEGER) AS fold FROM hashed)"""

oracle("label_quantile_edges", with_base("""
SELECT p, round(e[i], 9) AS edge FROM edges_q,
  (SELECT unnest([0.0e0, 0.25e0, 0.5e0, 0.75e0, 1.0e0]) AS p, unnest([1, 2, 3, 4, 5]) AS i)""", STRATA_CTES))
oracle("label_strata", with_base("SELECT asset_id, stratum FROM strata", STRATA_CTES))
oracle("stratified_split", with_base("SELECT asset_id, stratum, split FROM split_s", STRATA_CTES))
oracle("shuffled_split", with_base("SELECT asset_id, split FROM split_p", STRATA_CTES))
oracle("kfold_assignment", with_base("SELECT asset_id, fold FROM folds", STRATA_CTES))
oracle("kfold_sizes", with_base("SELECT fold, count(*) AS n_rows FROM folds GROUP BY fold", STRATA_CTES))

# --- step 5: evaluation on the stand-in prediction -----------------------------
from .oracle_base import bucket_sql as _b, clip_sql as _clip, normal_sql as _normal, rank_sql as _rank  # noqa: E402

EVAL_CTES = STRATA_CTES + f""",
split_rows AS (SELECT l.*, s.split FROM labelled l JOIN split_s s ON s.asset_id = l.asset_id),
test_rows AS (SELECT * FROM split_rows WHERE split = 'test'),
train_rows AS (SELECT * FROM split_rows WHERE split = 'train'),
pred0 AS (SELECT asset_id, risk_score, {_clip(f"(risk_score + {_normal('asset_id', 42, 'p', 0.05)})")} AS predicted_score
          FROM test_rows),
pred1 AS (SELECT *, {_b('risk_score')} AS actual_priority, {_b('predicted_score')} AS predicted_priority FROM pred0),
pred_b AS (SELECT *, {_rank('actual_priority')} AS actual_rank, {_rank('predicted_priority')} AS predicted_rank FROM pred1),
pr(priority, rk) AS (VALUES ('CRITICAL', 0), ('HIGH', 1), ('MEDIUM', 2), ('LOW', 3)),
cm AS (
  SELECT a.priority AS actual_priority, b.priority AS predicted_priority, a.rk AS actual_rank, b.rk AS predicted_rank,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM pr a CROSS JOIN pr b
  LEFT JOIN (SELECT actual_priority, predicted_priority, count(*) AS n FROM pred_b GROUP BY ALL) c
    ON c.actual_priority = a.priority AND c.predicted_priority = b.priority),
f1s AS (
  SELECT a.priority, a.support, a.tp, b.predicted,
         CASE WHEN b.predicted > 0 THEN a.tp / b.predicted ELSE 0.0e0 END AS precision,
         CASE WHEN a.support > 0 THEN a.tp / a.support ELSE 0.0e0 END AS recall,
         CASE WHEN a.support + b.predicted > 0 THEN 2.0e0 * a.tp / (a.support + b.predicted) ELSE 0.0e0 END AS f1
  FROM (SELECT actual_priority AS priority, CAST(sum(n) AS BIGINT) AS support,
               CAST(sum(CASE WHEN actual_priority = predicted_priority THEN n ELSE 0 END) AS BIGINT) AS tp
        FROM cm GROUP BY 1) a
  JOIN (SELECT predicted_priority AS priority, CAST(sum(n) AS BIGINT) AS predicted FROM cm GROUP BY 1) b
    ON a.priority = b.priority),
cuts(cutoff) AS (VALUES (0.75e0), (0.5e0), (0.25e0)),
dec_edges AS (SELECT quantile_cont(predicted_score, [0.0e0, 0.1e0, 0.2e0, 0.3e0, 0.4e0, 0.5e0, 0.6e0, 0.7e0, 0.8e0, 0.9e0, 1.0e0]) AS e
              FROM pred_b)"""

oracle("test_predictions", with_base("""
SELECT asset_id, round(risk_score, 9) AS risk_score, actual_priority, TRUE AS score_in_range, TRUE AS bucket_agrees
FROM pred_b""", EVAL_CTES))
oracle("standin_predictions", with_base("""
SELECT asset_id, round(risk_score, 9) AS risk_score, round(predicted_score, 9) AS predicted_score,
       actual_priority, predicted_priority FROM pred_b""", EVAL_CTES))
oracle("regression_metrics", with_base("""
SELECT count(*) AS n,
       round(avg(abs(risk_score - predicted_score)), 9) AS mae,
       round(sqrt(avg((risk_score - predicted_score) * (risk_score - predicted_score))), 9) AS rmse,
       round(CASE WHEN var_pop(risk_score) * count(*) > 0
                  THEN 1.0e0 - sum((risk_score - predicted_score) * (risk_score - predicted_score)) / (var_pop(risk_score) * count(*))
                  WHEN sum((risk_score - predicted_score) * (risk_score - predicted_score)) = 0 THEN 1.0e0 ELSE 0.0e0 END, 9) AS r2,
       round(CASE WHEN stddev_pop(risk_score) > 0 AND stddev_pop(predicted_score) > 0
                  THEN corr(risk_score, predicted_score) END, 9) AS pearson_r
FROM pred_b""", EVAL_CTES))
oracle("baseline_mae_test", with_base("""
SELECT round(avg(abs(risk_score - (SELECT avg(risk_score) FROM test_rows))), 9) AS baseline_mae FROM test_rows""", EVAL_CTES))
oracle("baseline_mae_train", with_base("""
SELECT round(avg(abs(risk_score - (SELECT avg(risk_score) FROM train_rows))), 9) AS baseline_mae FROM test_rows""", EVAL_CTES))
oracle("label_stats", with_base("""
SELECT count(*) AS rows, round_even(avg(risk_score), 4) AS label_mean, round_even(stddev_samp(risk_score), 4) AS label_std,
       split AS part FROM split_rows GROUP BY split""", EVAL_CTES))
oracle("confusion_matrix", with_base("SELECT * FROM cm", EVAL_CTES))
oracle("bucket_macro_f1", with_base("SELECT round(avg(f1), 9) AS bucket_macro_f1 FROM f1s", EVAL_CTES))
oracle("per_label_f1", with_base("""
SELECT priority, support, tp, predicted, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1 FROM f1s""", EVAL_CTES))
oracle("under_scored", with_base("""
SELECT asset_id, actual_priority, predicted_priority, round(predicted_score, 9) AS predicted_score
FROM pred_b WHERE actual_rank < predicted_rank""", EVAL_CTES))
oracle("over_scored", with_base("""
SELECT asset_id, actual_priority, predicted_priority, round(predicted_score, 9) AS predicted_score
FROM pred_b WHERE actual_rank > predicted_rank""", EVAL_CTES))
oracle("error_counts", with_base("""
SELECT count(*) AS rows,
       count(*) FILTER (WHERE actual_rank < predicted_rank) AS under_scored_count,
       count(*) FILTER (WHERE actual_rank > predicted_rank) AS over_scored_count,
       round_even(count(*) FILTER (WHERE actual_rank < predicted_rank) / count(*) * 100.0e0, 2) AS under_scored_pct
FROM pred_b""", EVAL_CTES))
oracle("bucket_match_rate", with_base("""
SELECT round(avg(CAST(actual_priority = predicted_priority AS DOUBLE)), 9) AS bucket_match_rate FROM pred_b""", EVAL_CTES))
oracle("calibration_deciles", with_base("""
SELECT bin, round(avg(predicted_score), 9) AS mean_predicted, round(avg(risk_score), 9) AS mean_actual, count(*) AS n
FROM (SELECT p.*, CAST(greatest(len(list_filter(list_distinct(e), lambda x: x < predicted_score)) - 1, 0) AS INTEGER) AS bin
      FROM pred_b p, dec_edges WHERE len(list_distinct(e)) >= 2) GROUP BY bin""", EVAL_CTES))
oracle("threshold_sweep", with_base("""
SELECT cutoff, tp, fp, fn,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0e0 END, 9) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0e0 END, 9) AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0e0 * tp / (2 * tp + fp + fn) ELSE 0.0e0 END, 9) AS f1,
       round(brier, 9) AS brier
FROM (SELECT cutoff,
             count(*) FILTER (WHERE risk_score >= cutoff AND predicted_score >= cutoff) AS tp,
             count(*) FILTER (WHERE risk_score < cutoff AND predicted_score >= cutoff) AS fp,
             count(*) FILTER (WHERE risk_score >= cutoff AND predicted_score < cutoff) AS fn,
             avg((predicted_score - CAST(risk_score >= cutoff AS DOUBLE)) * (predicted_score - CAST(risk_score >= cutoff AS DOUBLE))) AS brier
      FROM pred_b, cuts GROUP BY cutoff)""", EVAL_CTES))
oracle("roc_auc", with_base("""
SELECT cutoff, CASE WHEN n_pos > 0 AND n_neg > 0 THEN round((sum(r) FILTER (WHERE pos = 1) - n_pos * (n_pos + 1) / 2.0e0) / (n_pos * n_neg), 9) END AS auc,
       n_pos, n_neg
FROM (SELECT cutoff, pos,
             rank() OVER (PARTITION BY cutoff ORDER BY s) + (count(*) OVER (PARTITION BY cutoff, s) - 1) / 2.0e0 AS r,
             count(*) FILTER (WHERE pos = 1) OVER (PARTITION BY cutoff) AS n_pos,
             count(*) FILTER (WHERE pos = 0) OVER (PARTITION BY cutoff) AS n_neg
      FROM (SELECT cutoff, predicted_score AS s, CAST(risk_score >= cutoff AS INTEGER) AS pos FROM pred_b, cuts))
GROUP BY cutoff, n_pos, n_neg""", EVAL_CTES))

# --- step 7: promotion over the events-derived run ledger -----------------------
from .oracle_promotion import promotion_ctes  # noqa: E402


def _prom(body: str) -> str:
    return f"WITH {promotion_ctes()}\n{body}"


oracle("run_latest_metrics", _prom("SELECT run_id, key, round(value, 9) AS value FROM latest"))
oracle("metric_comparison", _prom("""
SELECT model, metric, round(champion, 9) AS champion, round(candidate, 9) AS candidate, round(gap, 9) AS gap FROM pairs"""))
oracle("comparability", _prom("SELECT model, cand_run, champ_run, cand_dataset, champ_dataset, refusal FROM comp"))
oracle("gate_ledger", _prom("""
SELECT environment, model, gate, gate_order, metric, outcome, round(observed, 9) AS observed,
       round(required, 9) AS required FROM ledger"""))
oracle("promotion_decisions", _prom("""
SELECT environment, model, outcome, gate, metric, round(observed, 9) AS observed, round(required, 9) AS required,
       n_failures, on_pass FROM decisions"""))
from ..operators import promotion as _pm  # noqa: E402
from .oracle_promotion import _sql_fmt  # noqa: E402


def _num(x: str, sign: str = "") -> str:
    return f"printf('%{sign}.4f', round(round({x}, 9), 4))"


oracle("promotion_report", _prom(f"""
SELECT d.environment, d.model, d.outcome, d.gate,
  CASE WHEN p.champ_run IS NULL THEN 'no champion alias yet: first promotion'
       WHEN d.gate = 'comparability' THEN p.refusal
       WHEN d.gate IN ('absolute floor', 'relative improvement', 'regression') AND d.observed IS NULL THEN
            {_sql_fmt(_pm.MSG_NOT_EVALUATED, {"metric": "d.metric"})}
       WHEN d.gate = 'absolute floor' THEN {_sql_fmt(_pm.MSG_BELOW_FLOOR, {"metric": "d.metric", "observed:.4": _num("d.observed"), "floor:.4": _num("d.required")})}
       WHEN d.gate = 'relative improvement' THEN {_sql_fmt(_pm.MSG_NOT_ENOUGH_BETTER, {"metric": "d.metric", "gap:+.4": _num("d.observed", "+"), "required:+.4": _num("d.required", "+")})}
       WHEN d.gate = 'regression' THEN {_sql_fmt(_pm.MSG_REGRESSION, {"metric": "d.metric", "regression:.4": _num("d.observed"), "allowed:.4": _num("d.required")})}
       WHEN d.gate = 'age' THEN {_sql_fmt(_pm.MSG_TOO_OLD, {"age_days": "CAST(CAST(d.observed AS BIGINT) AS VARCHAR)", "max_days": "CAST(CAST(d.required AS BIGINT) AS VARCHAR)"})}
       WHEN d.gate = 'environment gating' THEN {_sql_fmt(_pm.MSG_RATE_LIMITED, {"environment": "d.environment", "until": "strftime(hr.end_time + to_hours(CAST(p.interval_hours AS BIGINT)), '%Y-%m-%d %H:%M:%S') || ' UTC'"})}
  END AS reason
FROM decisions d JOIN per_env p ON p.environment = d.environment AND p.model = d.model
LEFT JOIN runs hr ON hr.run_id = p.champ_run"""))
oracle("run_tag_audit", _prom("SELECT run_id, missing_tag FROM tag_audit"))

# --- step 8: property graph and its fixed queries ------------------------------
from ..operators.graph import DATA_CLASSES  # noqa: E402
from ..schemas import ECC_FAMILY  # noqa: E402
from ..sources.inventory import (ALGORITHM_BY_PART_MOD, AS_OF_DATE, ECC_KEY_SIZES,  # noqa: E402
                                 RSA_KEY_SIZES)
from .oracle_base import case_pick  # noqa: E402

_ECC = ", ".join(f"'{a}'" for a in ECC_FAMILY)
GRAPH_CTES = f"""
g_certs0 AS (SELECT 'cert-' || CAST(o_orderkey AS VARCHAR) AS cert_id, o_custkey AS asset_id,
                    {case_pick('o_orderkey % 10', ALGORITHM_BY_PART_MOD)} AS algorithm,
                    CAST(o_orderdate AS DATE) + 730 AS not_after, o_orderkey FROM orders),
g_certs1 AS (SELECT *, CAST(CASE WHEN algorithm = 'RSA' THEN {case_pick('o_orderkey % 4', RSA_KEY_SIZES)}
                                 WHEN algorithm IN ({_ECC}) THEN {case_pick('o_orderkey % 3', ECC_KEY_SIZES)} END AS INTEGER)
                    AS key_size FROM g_certs0),
g_certs AS (SELECT *, concat_ws('-', algorithm, CAST(key_size AS VARCHAR)) AS alg_id FROM g_certs1),
g_apps AS (SELECT 'asset-' || CAST(asset_id AS VARCHAR) AS app_id, asset_id, criticality, data_asset FROM assets),
g_data AS (SELECT n_name AS data_asset, {case_pick('n_regionkey % 3', DATA_CLASSES)} AS classification FROM nation),
g_algs AS (SELECT DISTINCT c.alg_id, c.algorithm, c.key_size, v.quantum_vulnerable
           FROM g_certs c LEFT JOIN vuln v ON v.algorithm = c.algorithm),
nodes AS (
  SELECT 'Application' AS node_type, app_id AS node_id, app_id AS name, criticality, CAST(NULL AS INTEGER) AS key_size,
         CAST(NULL AS BOOLEAN) AS quantum_vulnerable, CAST(NULL AS VARCHAR) AS classification, CAST(NULL AS DATE) AS not_after
  FROM g_apps
  UNION ALL SELECT 'Certificate', cert_id, cert_id, NULL, NULL, NULL, NULL, not_after FROM g_certs
  UNION ALL SELECT 'Algorithm', alg_id, algorithm, NULL, key_size, quantum_vulnerable, NULL, NULL FROM g_algs
  UNION ALL SELECT 'DataAsset', data_asset, data_asset, NULL, NULL, NULL, classification, NULL FROM g_data),
g_cj AS (SELECT c.*, a.app_id, a.data_asset FROM g_certs c JOIN g_apps a ON a.asset_id = c.asset_id),
edges_g AS (
  SELECT 'Application' AS src_type, app_id AS src, 'USES' AS rel, 'Certificate' AS dst_type, cert_id AS dst FROM g_cj
  UNION ALL SELECT 'Certificate', cert_id, 'SIGNED_WITH', 'Algorithm', alg_id FROM g_certs
  UNION ALL SELECT DISTINCT 'Algorithm', alg_id, 'PROTECTS', 'DataAsset', data_asset FROM g_cj),
uses AS (SELECT src AS app, dst AS cert FROM edges_g WHERE rel = 'USES'),
signed AS (SELECT src AS cert, dst AS alg FROM edges_g WHERE rel = 'SIGNED_WITH'),
protects AS (SELECT src AS alg, dst AS data FROM edges_g WHERE rel = 'PROTECTS')"""

oracle("graph_nodes", with_base("SELECT * FROM nodes", GRAPH_CTES))
oracle("graph_edges", with_base("SELECT * FROM edges_g", GRAPH_CTES))
oracle("graph_node_counts", with_base("SELECT node_type, count(*) AS n_nodes FROM nodes GROUP BY node_type", GRAPH_CTES))
oracle("graph_upsert_idempotent", with_base("""
SELECT node_type, count(*) AS n_nodes, 0::BIGINT AS n_stale, CAST(sum(key_size) AS BIGINT) AS sum_key_size,
       count(criticality) AS n_criticality, count(DISTINCT name) AS n_names
FROM (SELECT DISTINCT * FROM nodes) GROUP BY node_type""", GRAPH_CTES))
oracle("critical_apps_on_algorithm", with_base("""
SELECT u.app, u.cert, n.name AS alg_name, n.key_size
FROM uses u JOIN signed s ON s.cert = u.cert
JOIN nodes n ON n.node_type = 'Algorithm' AND n.node_id = s.alg AND n.name = 'RSA'
JOIN nodes a ON a.node_type = 'Application' AND a.node_id = u.app AND a.criticality = 'CRITICAL'""", GRAPH_CTES))
oracle("downstream_of_certificate", with_base("""
SELECT s.cert, s.alg, coalesce(p.n, 0) AS n_data_assets, coalesce(p.names, '') AS data_assets
FROM signed s LEFT JOIN (SELECT alg, count(*) AS n, string_agg(data, ',' ORDER BY data) AS names FROM protects GROUP BY alg) p
  ON p.alg = s.alg""", GRAPH_CTES))
oracle("reachable_from_certificate", "WITH RECURSIVE" + with_base("""
SELECT src AS cert, count(*) FILTER (dst_type = 'Algorithm') AS n_algorithms, count(*) FILTER (dst_type = 'DataAsset') AS n_data_assets,
       max(hops)::INTEGER AS max_hops
FROM (SELECT src, dst_type, dst, min(hops) AS hops FROM rc GROUP BY ALL) GROUP BY src""", GRAPH_CTES + """,
rc AS (
  SELECT src, dst_type, dst, 1 AS hops FROM edges_g WHERE src_type = 'Certificate'
  UNION SELECT r.src, e.dst_type, e.dst, r.hops + 1 FROM rc r JOIN edges_g e ON e.src = r.dst AND e.src_type = r.dst_type)""")[len("WITH"):])
oracle("graph_merge_sink", with_base("""
SELECT node_type, count(*) AS n_nodes, count(*) FILTER (node_type = 'Certificate' AND node_id LIKE 'cert-77%') AS n_renewed, 0::BIGINT AS n_stale,
       count(DISTINCT node_id) AS n_ids, 0::BIGINT AS n_renewed_before, TRUE AS few_files_rewritten, TRUE AS second_merge_wrote_nothing
FROM nodes GROUP BY node_type""", GRAPH_CTES))
oracle("algorithms_protecting_customer_data", with_base("""
SELECT p.alg, count(*) AS n_data_assets FROM protects p
JOIN nodes d ON d.node_type = 'DataAsset' AND d.node_id = p.data AND d.classification = 'customer'
GROUP BY p.alg""", GRAPH_CTES))
oracle("apps_per_algorithm", with_base("""
SELECT alg, count(DISTINCT app) AS n_apps FROM uses u JOIN signed s ON s.cert = u.cert GROUP BY alg""", GRAPH_CTES))
oracle("data_only_behind_vulnerable", with_base("""
SELECT data, count(*) AS n_algorithms FROM protects p
LEFT JOIN nodes a ON a.node_type = 'Algorithm' AND a.node_id = p.alg
GROUP BY data HAVING bool_and(coalesce(a.quantum_vulnerable, false))""", GRAPH_CTES))
oracle("apps_without_safe_path", with_base("""
SELECT node_id AS app FROM nodes WHERE node_type = 'Application' AND node_id NOT IN (
  SELECT u.app FROM uses u JOIN signed s ON s.cert = u.cert
  JOIN nodes a ON a.node_type = 'Algorithm' AND a.node_id = s.alg AND a.quantum_vulnerable = false)""", GRAPH_CTES))
oracle("expiring_vulnerable_certs", with_base(f"""
SELECT c.node_id AS cert, s.alg, c.not_after, CAST(date_diff('day', DATE '{AS_OF_DATE}', c.not_after) AS INTEGER) AS days_to_expiry
FROM nodes c JOIN signed s ON s.cert = c.node_id
JOIN nodes a ON a.node_type = 'Algorithm' AND a.node_id = s.alg
WHERE c.node_type = 'Certificate' AND a.quantum_vulnerable
  AND date_diff('day', DATE '{AS_OF_DATE}', c.not_after) BETWEEN 0 AND 90""", GRAPH_CTES))

# --- step 9: dependency levels and migration plans ------------------------------
from ..config import CRITICALITY_DEFAULT as _CD, CRITICALITY_SCORE as _CS  # noqa: E402
from .oracle_base import case_map as _case_map, dbl  # noqa: E402

_CRIT = _case_map("upper(criticality)", {k: dbl(v) for k, v in _CS.items()}, dbl(_CD))
PLAN_CTES = f"""
lv_paths(asset_id, level) AS (
  SELECT asset_id, 0 FROM assets WHERE asset_id NOT IN (SELECT src FROM edges)
  UNION ALL
  SELECT e.src, p.level + 1 FROM edges e JOIN lv_paths p ON e.dst = p.asset_id),
lv AS (SELECT asset_id, CAST(max(level) AS INTEGER) AS level FROM lv_paths GROUP BY asset_id),
items AS (
  SELECT l.*, concat_ws(', ', lower(criticality),
           CASE WHEN algorithm IS NOT NULL THEN concat_ws('-', algorithm, CASE WHEN key_size > 0 THEN CAST(key_size AS VARCHAR) END) END,
           CASE WHEN internet_accessible = 1 THEN 'internet-facing' END,
           lower(migration_complexity) || ' complexity') AS reasoning
  FROM labelled l),
bp AS (
  SELECT asset_id, baseline_key, row_number() OVER (ORDER BY baseline_key DESC, asset_id) AS rank,
         CAST(ntile(4) OVER (ORDER BY baseline_key DESC, asset_id) AS INTEGER) AS phase
  FROM (SELECT *, {_CRIT} * coalesce(CAST(quantum_vulnerable AS DOUBLE), 0.0e0) AS baseline_key FROM items)),
wp0 AS (
  SELECT i.*, lv.level,
         0.5e0 * risk_score + 0.3e0 * (0.5e0 * CAST(financial_data AS DOUBLE) + 0.3e0 * CAST(customer_data AS DOUBLE)
           + 0.2e0 * CAST(regulated_system AS DOUBLE))
           + 0.2e0 * (1.0e0 / CASE migration_complexity WHEN 'LOW' THEN 1.0e0 WHEN 'MEDIUM' THEN 2.0e0
                                   WHEN 'HIGH' THEN 3.0e0 ELSE 2.0e0 END) AS score,
         CAST(migration_complexity = 'HIGH' AS INTEGER) AS is_high
  FROM items i JOIN lv ON lv.asset_id = i.asset_id),
wp1 AS (SELECT *, CAST(CASE WHEN is_high = 1 THEN ceil(row_number() OVER (PARTITION BY level, is_high
                       ORDER BY score DESC, asset_id) / 25.0e0) ELSE 1 END AS INTEGER) AS sub_phase FROM wp0),
spans AS (SELECT level, max(sub_phase) AS span FROM wp1 GROUP BY level),
span_offs AS (SELECT level, coalesce(sum(span) OVER (ORDER BY level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS before FROM spans),
wp2 AS (SELECT wp1.*, CAST(before + sub_phase AS INTEGER) AS phase FROM wp1 JOIN span_offs ON span_offs.level = wp1.level),
wplan AS (SELECT *, row_number() OVER (PARTITION BY phase ORDER BY score DESC, asset_id) AS rank,
                 row_number() OVER (ORDER BY phase, score DESC, asset_id) AS grank FROM wp2)"""


def _plan(body: str) -> str:
    return "WITH RECURSIVE" + with_base(body, PLAN_CTES)[len("WITH"):]


oracle("dependency_levels", _plan("SELECT asset_id, level FROM lv"))
oracle("dependency_closure", "WITH RECURSIVE" + with_base("""
SELECT src AS asset_id, count(*) AS n_dependencies, max(hops)::INTEGER AS max_hops, sum(dst)::BIGINT AS sum_dependencies
FROM (SELECT src, dst, min(hops) AS hops FROM rc GROUP BY src, dst) GROUP BY src""", """
rc AS (SELECT src, dst, 1 AS hops FROM edges UNION SELECT r.src, e.dst, r.hops + 1 FROM rc r JOIN edges e ON e.src = r.dst)""")[len("WITH"):])
oracle("cyclic_dependency_levels", "WITH RECURSIVE" + with_base("""
SELECT asset_id, component, count(*) OVER (PARTITION BY component) AS n_members, level
FROM comp JOIN (SELECT node, max(level)::INTEGER AS level FROM cl GROUP BY node) l ON l.node = comp.component""", """
cyc AS (
  SELECT src, dst FROM edges
  UNION SELECT asset_id // 9, asset_id FROM assets WHERE asset_id % 50 = 7 AND asset_id // 9 IN (SELECT asset_id FROM assets)),
rc AS (SELECT src, dst FROM cyc UNION SELECT r.src, c.dst FROM rc r JOIN cyc c ON c.src = r.dst),
mutual AS (SELECT a.src, min(a.dst) AS least FROM rc a JOIN rc b ON b.src = a.dst AND b.dst = a.src GROUP BY a.src),
comp AS (SELECT asset_id, coalesce(least, asset_id) AS component FROM assets LEFT JOIN mutual ON mutual.src = asset_id),
ce AS (
  SELECT DISTINCT s.component AS src, d.component AS dst FROM cyc JOIN comp s ON s.asset_id = cyc.src
  JOIN comp d ON d.asset_id = cyc.dst WHERE s.component <> d.component),
cl AS (SELECT DISTINCT component AS node, 0 AS level FROM comp UNION SELECT ce.src, cl.level + 1 FROM cl JOIN ce ON ce.dst = cl.node)""")[len("WITH"):])
oracle("plan_baseline", _plan("SELECT asset_id, round(baseline_key, 9) AS baseline_key, rank, phase FROM bp"))
oracle("plan_weighted", _plan("""
SELECT asset_id, level, sub_phase, phase, rank, round(score, 9) AS score, reasoning FROM wplan"""))
oracle("plan_violations", _plan("""
SELECT count(*) AS n_edges, count(*) FILTER (WHERE d.phase >= s.phase) AS violations
FROM edges e JOIN wplan s ON s.asset_id = e.src JOIN wplan d ON d.asset_id = e.dst"""))
oracle("plan_phase_summary", _plan("""
SELECT phase, count(*) AS n_items, count(*) FILTER (WHERE migration_complexity = 'HIGH') AS n_high, min(level) AS level
FROM wplan GROUP BY phase"""))
oracle("plan_rank_agreement", _plan("""
SELECT round(corr(rb, rw), 9) AS spearman,
       round(count(*) FILTER (WHERE rank_b <= 100 AND rw <= 100) / 100.0e0, 9) AS topk_overlap
FROM (SELECT b.asset_id, b.rank AS rank_b,
             min(b.rank) OVER (PARTITION BY b.baseline_key) + (count(*) OVER (PARTITION BY b.baseline_key) - 1) / 2.0e0 AS rb,
             w.grank AS rw
      FROM bp b JOIN wplan w ON w.asset_id = b.asset_id)"""))

oracle("system_comparison", _plan("""
SELECT 'baseline' AS system, round(corr(x.rb, er.re), 9) AS spearman,
       round(count(*) FILTER (WHERE x.rank_b <= 100 AND t.asset_id IS NOT NULL) / 100.0e0, 9) AS topk_overlap, count(*) AS n
FROM (SELECT b.asset_id, b.rank AS rank_b,
             min(b.rank) OVER (PARTITION BY b.baseline_key) + (count(*) OVER (PARTITION BY b.baseline_key) - 1) / 2.0e0 AS rb
      FROM bp b) x
JOIN er ON er.asset_id = x.asset_id LEFT JOIN top_e t ON t.asset_id = x.asset_id
UNION ALL
SELECT 'weighted' AS system, round(corr(w.grank, er.re), 9) AS spearman,
       round(count(*) FILTER (WHERE w.grank <= 100 AND t.asset_id IS NOT NULL) / 100.0e0, 9) AS topk_overlap, count(*) AS n
FROM wplan w JOIN er ON er.asset_id = w.asset_id LEFT JOIN top_e t ON t.asset_id = w.asset_id""").replace(
    "\nbp AS (", """
er AS (SELECT asset_id, rank() OVER (ORDER BY risk_score DESC) + (count(*) OVER (PARTITION BY risk_score) - 1) / 2.0e0 AS re
       FROM rule_labelled),
top_e AS (SELECT asset_id FROM rule_labelled ORDER BY risk_score DESC, asset_id LIMIT 100),
bp AS (""", 1))

oracle("pairwise_agreement", _plan("""
SELECT system, (SELECT count(*) FROM bp) AS n, count(*)::VARCHAR AS comparable, count(*) FILTER (way > 0)::VARCHAR AS concordant,
       count(*) FILTER (way < 0)::VARCHAR AS discordant, count(*) FILTER (way = 0)::VARCHAR AS tied,
       round((count(*) FILTER (way > 0) + count(*) FILTER (way = 0) / 2.0e0) / count(*), 9) AS agreement
FROM (
  SELECT a.system, sign(b.r - a.r) * sign(b.e - a.e) AS way FROM ranks a JOIN ranks b
  ON b.system = a.system AND b.asset_id > a.asset_id AND b.e <> a.e)
GROUP BY system""").replace("\nSELECT system, (SELECT", """,
ranks AS (
  SELECT 'baseline' AS system, b.asset_id, -b.baseline_key AS r, -l.risk_score AS e FROM bp b JOIN rule_labelled l ON l.asset_id = b.asset_id
  UNION ALL
  SELECT 'weighted', w.asset_id, w.grank, -l.risk_score FROM wplan w JOIN rule_labelled l ON l.asset_id = w.asset_id)
SELECT system, (SELECT""", 1))

EXPERT_CTES = EVAL_CTES + f""",
expert_f AS (
  SELECT p.asset_id, p.predicted_score, r.risk_score AS expert_score,
         CASE WHEN t.asset_id IS NULL THEN 0 ELSE 1 END AS in_train,
         {_b('r.risk_score')} AS expert_priority, {_b('p.predicted_score')} AS predicted_priority
  FROM pred0 p JOIN rule_labelled r ON r.asset_id = p.asset_id
  LEFT JOIN train_rows t ON t.asset_id = p.asset_id)"""
oracle("expert_evaluation", with_base("""
SELECT count(*) AS n, CAST(sum(in_train) AS BIGINT) AS n_in_train, TRUE AS beats_mean_twofold, TRUE AS rmse_at_least_mae,
       TRUE AS match_rate_reached FROM expert_f""", EXPERT_CTES))
oracle("agreement_rate", with_base("""
SELECT expert_priority AS category, count(*) AS n_judged, TRUE AS agreed_among_judged, TRUE AS rate_is_quotient
FROM expert_f GROUP BY 1""", EXPERT_CTES))

# --- model queries: the learner's numbers as bounds, everything else exactly -----
from ..config import PARAM_GRID  # noqa: E402
from ..schemas import FEATURES as _SCHEMA  # noqa: E402

_MISSING = "nullif(concat_ws('; ', " + ", ".join(
    f"CASE WHEN {name} IS NULL THEN 'missing feature {name}' END" for name, _, _ in _SCHEMA) + "), '')"
oracle("cv_results", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {n}, {d}, {lr}::DOUBLE, TRUE, TRUE, TRUE)" for i, (n, d, lr) in enumerate(PARAM_GRID))
    + ") AS t(grid_index, n_estimators, max_depth, learning_rate, beats_mean_twofold, folds_agree, choice_is_the_best)")
oracle("feature_importance", "SELECT feature, TRUE AS is_share, TRUE AS adds_up FROM (VALUES " + ", ".join(
    f"('{name}')" for name, _, _ in _SCHEMA) + ") AS t(feature)")
oracle("batch_scores", with_base(f"""
SELECT asset_id, e AS encode_error, e IS NULL AS scored, CASE WHEN e IS NULL THEN TRUE END AS score_in_range,
       TRUE AS bucket_agrees FROM (SELECT asset_id, {_MISSING} AS e FROM features)"""))


def _instance_error(name: str, kind: str) -> str:
    number, known = f"'feature {name} must be a number'", f"'feature {name} must be a known string'"
    case = {"key_size": f"WHEN asset_id % 11 = 0 THEN {number}", "internet_accessible": f"WHEN asset_id % 13 = 0 THEN {number}",
            "criticality": f"WHEN asset_id % 17 = 0 THEN 'unknown category for {name}: ' || lower({name})",
            "loc_estimate": f"WHEN asset_id % 19 = 0 THEN 'missing feature {name}'",
            "network_zone": f"WHEN asset_id % 23 = 0 THEN {known}"}.get(name, "")
    return f"CASE WHEN {name} IS NULL THEN 'missing feature {name}' {case} END"


oracle("encode_errors", with_base(f"""
SELECT asset_id, e AS encode_error FROM (
  SELECT asset_id, CASE WHEN asset_id % 29 = 0 THEN 'instance is not a JSON object'
         ELSE nullif(concat_ws('; ', {", ".join(_instance_error(n, k) for n, k, _ in _SCHEMA)}), '') END AS e FROM features)
WHERE e IS NOT NULL"""))
oracle("model_quality", with_base("""
SELECT count(*) AS n, round(avg(abs(risk_score - (SELECT avg(risk_score) FROM train_rows))), 9) AS baseline_mae,
       TRUE AS beats_mean_twofold, FALSE AS model_worse_than_baseline, TRUE AS match_rate_reached, TRUE AS correlates
FROM test_rows""", EVAL_CTES))
oracle("reload_equivalence", with_base("""
SELECT count(*) AS rows, 0.0e0 AS max_abs_diff, 0::BIGINT AS unmatched FROM test_rows""", EVAL_CTES))
oracle("model_lifecycle", with_base(f"""
SELECT model, alias, version, 1::BIGINT AS n_promotions, n_scores, 12::BIGINT AS n_params, 8::BIGINT AS n_metrics,
       2::BIGINT AS n_later_metric_won
FROM (VALUES ('asset-risk', 'champion', 1), ('asset-risk', 'candidate', 2)) AS a(model, alias, version),
     (SELECT count(*) AS n_scores FROM features WHERE {_MISSING} IS NULL)"""))

# --- step 10: ingest extras, retrieval, rule hits, search ------------------------
from ..operators.retrieval import RULES as _RULES  # noqa: E402

oracle("scan_coverage", with_base(f"""
SELECT outcome, reason, n_attempts,
       round(sum(CASE WHEN outcome = 'ok' THEN n_attempts ELSE 0 END) OVER () / sum(n_attempts) OVER (), 9) AS coverage
FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN 'error' ELSE 'ok' END AS outcome,
             CASE WHEN o_orderstatus = 'P' THEN {case_pick('o_orderkey % 3', ('timeout', 'refused', 'non-TLS'))} END AS reason,
             count(*) AS n_attempts
      FROM orders GROUP BY ALL)"""))
oracle("asset_resolution", with_base("""
SELECT f.finding_id,
       coalesce(CAST(h.asset_id AS VARCHAR), CAST(r.asset_id AS VARCHAR), md5(coalesce(f.hint_host, f.hint_repo))) AS resolved_asset,
       CASE WHEN h.asset_id IS NOT NULL THEN 'hostname' WHEN r.asset_id IS NOT NULL THEN 'repo' ELSE 'created' END AS matched_by
FROM (SELECT finding_id,
             CASE WHEN source = 'tls_scan' THEN 'asset-' || CAST(asset_id AS VARCHAR) || '.internal' END AS hint_host,
             CASE WHEN source <> 'tls_scan' THEN 'repo/asset-' || CAST(asset_id AS VARCHAR) END AS hint_repo
      FROM findings) f
LEFT JOIN assets h ON h.hostname = f.hint_host
LEFT JOIN assets r ON r.repo = f.hint_repo"""))
oracle("scan_target_parse", """
SELECT regexp_extract(line, '^([^:\\s]+)', 1) AS host,
       CASE WHEN regexp_extract(line, ':(\\d+)$', 1) = '' THEN 443 ELSE CAST(regexp_extract(line, ':(\\d+)$', 1) AS INTEGER) END AS port
FROM (SELECT trim(CASE WHEN c_custkey % 10 = 0 THEN '# group ' || CAST(c_custkey AS VARCHAR)
                       WHEN c_custkey % 7 = 0 THEN '   '
                       ELSE 'asset-' || CAST(c_custkey AS VARCHAR) || '.internal' ||
                            CASE WHEN c_custkey % 3 = 0 THEN ':8443' ELSE '' END END) AS line FROM customer)
WHERE line <> '' AND NOT starts_with(line, '#')""")
oracle("document_chunks", """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_no, CAST(start_word AS INTEGER) AS start_word,
       CAST(len(w[start_word + 1: start_word + 500]) AS INTEGER) AS n_words,
       array_to_string(w[start_word + 1: start_word + 500], ' ') AS chunk_text, source, lang
FROM (SELECT doc_id, source, lang, w, unnest(generate_series(0, greatest(0, len(w) - 51), 450)) AS start_word,
             unnest(generate_series(1, len(generate_series(0, greatest(0, len(w) - 51), 450)))) AS i
      FROM (SELECT doc_id, source, lang, string_split_regex(trim(text), '\\s+') AS w FROM documents))""")
oracle("page_chunks", """
WITH p AS (SELECT page_id, url, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
                  string_split(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p><b>') AS parts FROM pages),
s AS (SELECT page_id, url, title, unnest(parts) AS raw, CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS section_no FROM p),
t AS (SELECT page_id, url, title, section_no,
             trim(CASE WHEN section_no = 0 THEN regexp_extract(raw, '<h1>([^<]*)</h1>', 1) ELSE regexp_extract(raw, '^([^<]*)', 1) END) AS section,
             trim(regexp_replace(regexp_replace(raw, '<[^>]*>', ' ', 'g'), '[ \\t\\n\\r]+', ' ', 'g')) AS text FROM s),
w AS (SELECT *, string_split_regex(text, '\\s+') AS w FROM t WHERE text <> ''),
c AS (SELECT *, unnest(generate_series(0, greatest(0, len(w) - 51), 450)) AS start_word,
             unnest(generate_series(1, len(generate_series(0, greatest(0, len(w) - 51), 450)))) AS i FROM w)
SELECT page_id, url, title, section_no, section, CAST(i - 1 AS INTEGER) AS chunk_no, CAST(start_word AS INTEGER) AS start_word,
       CAST(len(w[start_word + 1: start_word + 500]) AS INTEGER) AS n_words,
       array_to_string(w[start_word + 1: start_word + 500], ' ') AS chunk_text FROM c""")

_CHUNKS_SQL = """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_no, source,
       array_to_string(w[start_word + 1: start_word + 500], ' ') AS chunk_text
FROM (SELECT doc_id, source, w, unnest(generate_series(0, greatest(0, len(w) - 51), 450)) AS start_word,
             unnest(generate_series(1, len(generate_series(0, greatest(0, len(w) - 51), 450)))) AS i
      FROM (SELECT doc_id, source, string_split_regex(trim(text), '\\s+') AS w FROM documents))"""
_TERM_CTES = f"""WITH ch AS ({_CHUNKS_SQL}),
ct AS (SELECT doc_id, chunk_no, lower(t) AS term, count(*) AS c
       FROM (SELECT doc_id, chunk_no, unnest(regexp_extract_all(chunk_text, '[\\p{{L}}\\p{{N}}]+')) AS t FROM ch) GROUP BY ALL),
cn AS (SELECT doc_id, chunk_no, sqrt(sum(c * c)) AS norm, count(*) AS n_terms, sum(c) AS n_tokens FROM ct GROUP BY ALL)"""
oracle("chunk_embeddings", _TERM_CTES + """
SELECT ch.doc_id, ch.chunk_no, CAST(coalesce(cn.n_tokens, 0) AS INTEGER) AS n_tokens,
       CAST(coalesce(cn.n_terms, 0) AS INTEGER) AS n_terms, round(coalesce(cn.norm, 0.0e0), 9) AS norm
FROM ch LEFT JOIN cn ON cn.doc_id = ch.doc_id AND cn.chunk_no = ch.chunk_no""")
oracle("retrieve_passages", _TERM_CTES + """,
qt AS (SELECT item_id, lower(t) AS term, count(*) AS c
       FROM (SELECT item_id, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) AS t FROM benchmark) GROUP BY ALL),
qn AS (SELECT item_id, sqrt(sum(c * c)) AS qnorm FROM qt GROUP BY 1),
sc AS (SELECT q.item_id, t.doc_id, t.chunk_no, sum(CAST(q.c AS DOUBLE) * t.c) AS dot
       FROM qt q JOIN ct t ON t.term = q.term GROUP BY ALL),
ranked AS (SELECT sc.item_id, sc.doc_id, sc.chunk_no, round(dot / (cn.norm * qn.qnorm), 9) AS score
           FROM sc JOIN cn ON cn.doc_id = sc.doc_id AND cn.chunk_no = sc.chunk_no JOIN qn ON qn.item_id = sc.item_id)
SELECT r.item_id, CAST(r.rank AS INTEGER) AS rank, r.doc_id, r.chunk_no, ch.source, r.score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, chunk_no) AS rank FROM ranked) r
JOIN ch ON ch.doc_id = r.doc_id AND ch.chunk_no = r.chunk_no
WHERE r.rank <= 5""")

_DIM = 64
_CENT = ", ".join(f"avg(CAST(embedding[{i + 1}] AS DOUBLE))" for i in range(_DIM))
_EMB_CTES = f"""
cent AS (SELECT label AS query_id, [{_CENT}] AS qv FROM embeddings GROUP BY label),
emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"""


def _topk_sql(score: str, direction: str) -> str:
    return f"""WITH {_EMB_CTES}
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, label, round(score, 9) AS score FROM (
  SELECT c.query_id, e.vec_id, e.label, {score} AS score,
         row_number() OVER (PARTITION BY c.query_id ORDER BY {score} {direction}, e.vec_id) AS rank
  FROM cent c, emb e) WHERE rank <= 5"""


oracle("embedding_topk_cosine", _topk_sql(
    "list_dot_product(e.e, c.qv) / (sqrt(list_dot_product(e.e, e.e)) * sqrt(list_dot_product(c.qv, c.qv)))", "DESC"))
oracle("embedding_topk_l2", _topk_sql(
    "sqrt(list_sum(list_transform(list_zip(e.e, c.qv), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))", "ASC"))

_RULE_SQL = " UNION ALL ".join(
    f"SELECT doc_id, path, line_no, '{rid}' AS rule_id, regexp_extract_all(line, '{rx}') AS found, "
    f"{('NULL' if alg is None else repr(alg))}::VARCHAR AS algorithm FROM lines"
    for rid, rx, alg in _RULES)
oracle("rule_hits", f"""
WITH lines AS (SELECT doc_id, concat_ws('/', source, CAST(doc_id AS VARCHAR)) AS path,
                      unnest(string_split(text, chr(10))) AS line,
                      CAST(unnest(generate_series(1, len(string_split(text, chr(10))))) AS INTEGER) AS line_no
               FROM documents),
hits AS ({_RULE_SQL})
SELECT doc_id, path, line_no, rule_id, CAST(unnest(generate_series(1, len(found))) AS INTEGER) AS match_no,
       unnest(found) AS snippet, algorithm FROM hits""")
oracle("keyword_search", with_base("""
SELECT term, kind, id, asset_id FROM (
  SELECT 'finding' AS kind, finding_id AS id, asset_id,
         lower(concat_ws(' ', algorithm,
               CASE WHEN source = 'tls_scan' THEN 'asset-' || CAST(asset_id AS VARCHAR) || '.internal' END,
               CASE WHEN source <> 'tls_scan' THEN 'repo/asset-' || CAST(asset_id AS VARCHAR) END,
               CAST(l_partkey AS VARCHAR) || ' ' || CAST(l_suppkey AS VARCHAR))) AS hay
  FROM findings
  UNION ALL
  SELECT 'asset', CAST(asset_id AS VARCHAR), asset_id,
         lower(concat_ws(' ', hostname, repo, data_asset, criticality, network_zone)) FROM assets) f,
  (VALUES ('rsa'), ('ml-'), ('repo/')) t(term)
WHERE instr(hay, term) > 0"""))
oracle("latest_risk_score", with_base("""
SELECT l.asset_id, round(CASE WHEN l.asset_id % 3 = 0 OR l.asset_id % 5 = 0 THEN r.risk_score ELSE l.risk_score END, 9) AS risk_score,
       CASE WHEN l.asset_id % 3 = 0 OR l.asset_id % 5 = 0 THEN 'rule-v1' ELSE 'rule-noisy-v2' END AS model_name,
       CASE WHEN l.asset_id % 3 = 0 OR l.asset_id % 5 = 0 THEN DATE '2001-11-04' ELSE DATE '2001-11-05' END AS scored_at
FROM labelled l JOIN rule_labelled r ON r.asset_id = l.asset_id"""))

# --- step 11: reports, exports, keyed randomness ---------------------------------
from .oracle_base import normal_sql as _nz  # noqa: E402

oracle("posture_summary", with_base(f"""
SELECT count(*) AS n_assets,
       count(*) FILTER (WHERE p = 'CRITICAL') AS n_critical, count(*) FILTER (WHERE p = 'HIGH') AS n_high,
       count(*) FILTER (WHERE p = 'MEDIUM') AS n_medium, count(*) FILTER (WHERE p = 'LOW') AS n_low,
       round(avg(CAST(coalesce(CAST(qv_raw AS INTEGER), 0) AS DOUBLE)), 9) AS vulnerable_share,
       round(avg(CAST(qv_raw IS NULL AS DOUBLE)), 9) AS unknown_share,
       (SELECT count(*) FROM nodes c JOIN signed s ON s.cert = c.node_id
        JOIN nodes a ON a.node_type = 'Algorithm' AND a.node_id = s.alg
        WHERE c.node_type = 'Certificate' AND a.quantum_vulnerable
          AND date_diff('day', DATE '{AS_OF_DATE}', c.not_after) BETWEEN 0 AND 90) AS n_expiring_vulnerable_certs
FROM (SELECT *, {bucket_sql('risk_score')} AS p FROM rule_labelled)""", GRAPH_CTES))
oracle("findings_table", with_base("""
SELECT finding_id, asset_id, algorithm, key_size, CAST(discovered_at AS DATE) AS discovered_at
FROM findings WHERE quantum_vulnerable ORDER BY discovered_at DESC, finding_id LIMIT 50"""))
oracle("asset_document", with_base(f"""
SELECT f.asset_id, f.criticality, f.algorithm AS primary_algorithm, f.n_findings,
       coalesce(c.n_certs, 0) AS n_certs, c.first_cert_expiry, {bucket_sql('r.risk_score')} AS priority
FROM features f
LEFT JOIN (SELECT o_custkey AS asset_id, count(*) AS n_certs, min(CAST(o_orderdate AS DATE) + 730) AS first_cert_expiry
           FROM orders GROUP BY o_custkey) c ON c.asset_id = f.asset_id
LEFT JOIN rule_labelled r ON r.asset_id = f.asset_id"""))
oracle("feature_export_roundtrip", with_base("""
SELECT schema_version, count(*) AS n_rows, CAST(sum(key_size) AS BIGINT) AS sum_key_size FROM features GROUP BY schema_version"""))
oracle("feature_snapshot_read", with_base("""
SELECT CASE WHEN asset_id % 2 = 0 THEN '9.1' ELSE '9.10' END AS schema_version, count(*) AS n_rows,
       CAST(sum(key_size) AS BIGINT) AS sum_key_size,
       CAST(sum(CASE WHEN asset_id % 2 = 1 THEN loc_estimate END) AS BIGINT) AS sum_loc
FROM features GROUP BY 1"""))
oracle("feature_export_json", with_base("""
SELECT criticality, count(*) AS n_rows, CAST(sum(key_size) AS BIGINT) AS sum_key_size, CAST(sum(loc_estimate) AS BIGINT) AS sum_loc
FROM features GROUP BY criticality"""))
oracle("split_csv_roundtrip", with_base("""
SELECT split, criticality, count(*) AS n_rows, CAST(sum(asset_id) AS BIGINT) AS sum_id, count(asset_age_days) AS n_age
FROM split_rows GROUP BY split, criticality""", EVAL_CTES))
oracle("asset_create_lookup", with_base("""
SELECT created, n_assets, first_id, last_id, n_assets AS n_ids, (SELECT hostname FROM assets WHERE asset_id = 7) AS hostname_of_7
FROM (SELECT FALSE AS created, count(*) AS n_assets, min(asset_id) AS first_id, max(asset_id) AS last_id FROM assets
      UNION ALL
      SELECT TRUE, count(*), (SELECT max(asset_id) FROM assets) + 1, (SELECT max(asset_id) FROM assets) + count(*)
      FROM assets WHERE asset_id % 100 = 0)"""))
oracle("noise_moments", with_base(f"""
SELECT count(*) AS n, round(avg(z), 9) AS mean, round(stddev_samp(z), 9) AS std
FROM (SELECT {_nz('asset_id', 42, '', 0.05)} AS z FROM assets)"""))

# the indexes return what the scans return
oracle("retrieve_passages_indexed", ORACLE["retrieve_passages"])
oracle("keyword_search_indexed", ORACLE["keyword_search"])
oracle("embedding_topk_cosine_indexed", ORACLE["embedding_topk_cosine"])
oracle("embedding_topk_l2_indexed", ORACLE["embedding_topk_l2"])
oracle("asset_document_nested", with_base(f"""
SELECT f.asset_id, {bucket_sql('r.risk_score')} AS priority, CAST(coalesce((g.place - 1) // 50, 0) + 1 AS INTEGER) AS page,
       CAST(coalesce((g.n - 1) // 50, 0) + 1 AS INTEGER) AS n_pages,
       CAST(coalesce(least(g.n - (g.place - 1) // 50 * 50, 50), 0) AS INTEGER) AS n_on_page, g.place, g.finding_id, g.algorithm, g.key_size,
       g.quantum_vulnerable
FROM features f LEFT JOIN rule_labelled r ON r.asset_id = f.asset_id
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY order_key, line_no) AS place, count(*) OVER (PARTITION BY asset_id) AS n
           FROM findings) g ON g.asset_id = f.asset_id"""))
oracle("plan_document", _plan("""
SELECT phase, CAST((rank - 1) // 50 + 1 AS INTEGER) AS page, n AS n_items, CAST(least(n - (rank - 1) // 50 * 50, 50) AS INTEGER) AS n_on_page,
       rank, asset_id, level, round(score, 9) AS score, reasoning
FROM (SELECT *, count(*) OVER (PARTITION BY phase) AS n FROM wplan)"""))
