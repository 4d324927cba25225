"""DuckDB oracle SQL for the promotion queries (events-derived ledger)."""
from __future__ import annotations

from ..config import REQUIRED_RUN_TAGS, Policy
from ..operators import promotion as pm
from ..sources import ledger as lg
from .oracle_base import dbl, q


def _sql_fmt(template: str, mapping: dict[str, str]) -> str:
    """Turn a message template into a SQL string expression: fixed text || column || ..."""
    out, rest = [], template
    while "{" in rest:
        i = rest.index("{")
        j = rest.index("}", i)
        out.append(q(rest[:i]))
        out.append(mapping[rest[i + 1:j]])
        rest = rest[j + 1:]
    out.append(q(rest))
    return "(" + " || ".join(out) + ")"


def _policy_values(policy: Policy) -> tuple[str, str]:
    envs, bars = [], []
    for r in policy.all_rules():
        envs.append(f"({q(r.environment)}, {q(r.deployment)}, {q(r.primary_metric)}, {dbl(r.min_primary_margin)}, "
                    f"{r.max_eval_age_days}, {r.min_promotion_interval_hours}, {q(r.on_pass)})")
        for m, b in r.floors:
            bars.append(f"({q(r.environment)}, 'floor', {q(m)}, {dbl(b)})")
        for m, b in r.max_regressions:
            bars.append(f"({q(r.environment)}, 'regression', {q(m)}, {dbl(b)})")
    return ", ".join(envs), ", ".join(bars)


def promotion_ctes(policy: Policy = Policy(), as_of: str = lg.LEDGER_AS_OF) -> str:
    key_case = "CASE event_type " + " ".join(f"WHEN {q(e)} THEN {q(k)}" for e, (k, _) in lg.METRIC_OF_EVENT.items()) + " END"
    scale_case = "CASE event_type " + " ".join(
        f"WHEN {q(e)} THEN {dbl(s)}" for e, (_, s) in lg.METRIC_OF_EVENT.items() if s is not None) + " END"
    tag_case = "CASE event_type " + " ".join(f"WHEN {q(e)} THEN {q(t)}" for e, t in lg.TAG_OF_EVENT.items()) + " END"
    env_values, bar_values = _policy_values(policy)
    required = ", ".join(f"({q(t)})" for t in REQUIRED_RUN_TAGS)
    now = f"TIMESTAMP '{as_of}'"
    return f"""
rm AS (
  SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id, {key_case} AS key,
         CASE WHEN event_type = 'view' THEN 1.0e0 - exp(-value / 50.0e0) ELSE value * {scale_case} END AS value,
         ts, event_id AS step
  FROM events),
latest AS (SELECT run_id, key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, key ORDER BY ts DESC, step DESC) AS rn FROM rm WHERE key IS NOT NULL)
  WHERE rn = 1),
last_ev AS (SELECT * FROM (
  SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id, ts, props,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1),
runs AS (SELECT run_id, ts AS end_time,
                'ds-' || CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 AS VARCHAR) AS dataset_id
         FROM last_ev),
versions AS (SELECT DISTINCT 'model-' || CAST(user_id // 2 AS VARCHAR) AS model, CAST(user_id % 2 + 1 AS INTEGER) AS version,
                    'run-' || CAST(user_id AS VARCHAR) AS run_id FROM events),
aliases AS (SELECT model, CASE WHEN version = 1 THEN 'champion' ELSE 'candidate' END AS alias, version FROM versions),
resolved AS (
  SELECT c.model, c.version AS cand_version, cv.run_id AS cand_run, h.version AS champ_version, hv.run_id AS champ_run,
         {q(lg.DEPLOYMENT)} AS deployment
  FROM (SELECT * FROM aliases WHERE alias = 'candidate') c
  LEFT JOIN versions cv ON cv.model = c.model AND cv.version = c.version
  LEFT JOIN (SELECT * FROM aliases WHERE alias = 'champion') h ON h.model = c.model
  LEFT JOIN versions hv ON hv.model = h.model AND hv.version = h.version),
pairs AS (
  SELECT coalesce(h.model, c.model) AS model, coalesce(h.metric, c.metric) AS metric,
         h.value AS champion, c.value AS candidate, c.value - h.value AS gap
  FROM (SELECT r.model, l.key AS metric, l.value FROM resolved r JOIN latest l ON l.run_id = r.champ_run) h
  FULL OUTER JOIN (SELECT r.model, l.key AS metric, l.value FROM resolved r JOIN latest l ON l.run_id = r.cand_run) c
    ON h.model = c.model AND h.metric = c.metric),
per_model AS (
  SELECT model, count(champion) AS n_champ, count(candidate) AS n_cand,
         min(CASE WHEN candidate IS NULL THEN metric END) AS champ_only,
         min(CASE WHEN champion IS NULL THEN metric END) AS cand_only
  FROM pairs GROUP BY model),
comp AS (
  SELECT r.*, ce.dataset_id AS cand_dataset, coalesce(ce.end_time, {now}) AS cand_evaluated_at,
         he.dataset_id AS champ_dataset,
         CASE WHEN r.champ_run IS NULL THEN {q(pm.MSG_MISSING_EVAL.format(side=pm.CHAMPION))}
              WHEN he.dataset_id <> ce.dataset_id THEN
                   {_sql_fmt(pm.MSG_DATASET_MISMATCH, {"champion": "he.dataset_id", "candidate": "ce.dataset_id"})}
              WHEN coalesce(pm_.n_champ, 0) + coalesce(pm_.n_cand, 0) = 0 THEN {q(pm.MSG_NO_METRICS)}
              WHEN pm_.champ_only IS NOT NULL THEN {_sql_fmt(pm.MSG_METRIC_MISSING, {"metric": "pm_.champ_only", "side": q(pm.CHAMPION)})}
              WHEN pm_.cand_only IS NOT NULL THEN {_sql_fmt(pm.MSG_METRIC_MISSING, {"metric": "pm_.cand_only", "side": q(pm.CANDIDATE)})}
         END AS refusal
  FROM resolved r LEFT JOIN runs ce ON ce.run_id = r.cand_run LEFT JOIN runs he ON he.run_id = r.champ_run
  LEFT JOIN per_model pm_ ON pm_.model = r.model),
envs(environment, deployment, primary_metric, margin, max_age_days, interval_hours, on_pass) AS (VALUES {env_values}),
bars(environment, kind, metric, bound) AS (VALUES {bar_values}),
per_env AS (SELECT c.*, e.environment, e.primary_metric, e.margin, e.max_age_days, e.interval_hours, e.on_pass
            FROM comp c JOIN envs e ON e.deployment = c.deployment),
comparable AS (SELECT * FROM per_env WHERE refusal IS NULL),
g_refused AS (SELECT environment, model, 'comparability' AS gate, 0 AS gate_order, CAST(NULL AS VARCHAR) AS metric,
                     'park' AS outcome, CAST(NULL AS DOUBLE) AS observed, CAST(NULL AS DOUBLE) AS required
              FROM per_env WHERE refusal IS NOT NULL),
g_bars AS (
  SELECT * FROM (
    SELECT c.environment, c.model,
           CASE WHEN b.kind = 'floor' THEN 'absolute floor' ELSE 'regression' END AS gate,
           CASE WHEN b.kind = 'floor' THEN 1 ELSE 3 END AS gate_order, b.metric, 'reject' AS outcome,
           CASE WHEN b.kind = 'floor' THEN p.candidate ELSE -p.gap END AS observed, b.bound AS required,
           CASE WHEN b.kind = 'floor' THEN (p.candidate IS NULL OR p.candidate < b.bound)
                ELSE (p.gap IS NULL OR (NOT isnan(-p.gap) AND -p.gap > b.bound)) END AS failed
    FROM comparable c JOIN bars b ON b.environment = c.environment
    LEFT JOIN pairs p ON p.model = c.model AND p.metric = b.metric) WHERE failed),
g_imp AS (
  SELECT c.environment, c.model, 'relative improvement' AS gate, 2 AS gate_order, c.primary_metric AS metric,
         'reject' AS outcome, p.gap AS observed, c.margin AS required
  FROM comparable c LEFT JOIN pairs p ON p.model = c.model AND p.metric = c.primary_metric
  WHERE p.gap IS NULL OR p.gap < c.margin),
g_age AS (
  SELECT environment, model, 'age' AS gate, 4 AS gate_order, CAST(NULL AS VARCHAR) AS metric, 'park' AS outcome,
         CAST(date_sub('day', cand_evaluated_at, {now}) AS DOUBLE) AS observed, CAST(max_age_days AS DOUBLE) AS required
  FROM comparable WHERE date_sub('day', cand_evaluated_at, {now}) > max_age_days),
g_rate AS (
  SELECT c.environment, c.model, 'environment gating' AS gate, 5 AS gate_order, CAST(NULL AS VARCHAR) AS metric,
         'park' AS outcome, CAST(NULL AS DOUBLE) AS observed, CAST(c.interval_hours AS DOUBLE) AS required
  FROM comparable c JOIN runs hr ON hr.run_id = c.champ_run
  WHERE {now} < hr.end_time + to_hours(CAST(c.interval_hours AS BIGINT))),
ledger AS (SELECT * FROM g_refused UNION ALL SELECT * EXCLUDE (failed) FROM g_bars UNION ALL SELECT * FROM g_imp
           UNION ALL SELECT * FROM g_age UNION ALL SELECT * FROM g_rate),
first_fail AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY environment, model ORDER BY gate_order, coalesce(metric, '')) AS rn,
                        count(*) OVER (PARTITION BY environment, model) AS n_failures FROM ledger) WHERE rn = 1),
decisions AS (
  SELECT e.environment, e.model,
         CASE WHEN e.champ_run IS NULL THEN 'approve' WHEN f.outcome IS NULL THEN 'approve' ELSE f.outcome END AS outcome,
         CASE WHEN e.champ_run IS NULL THEN NULL ELSE f.gate END AS gate,
         CASE WHEN e.champ_run IS NULL THEN NULL ELSE f.metric END AS metric,
         CASE WHEN e.champ_run IS NULL THEN NULL ELSE f.observed END AS observed,
         CASE WHEN e.champ_run IS NULL THEN NULL ELSE f.required END AS required,
         CAST(CASE WHEN e.champ_run IS NULL THEN 0 ELSE coalesce(f.n_failures, 0) END AS BIGINT) AS n_failures,
         e.on_pass
  FROM per_env e LEFT JOIN first_fail f ON f.environment = e.environment AND f.model = e.model),
tags AS (
  SELECT DISTINCT 'run-' || CAST(user_id AS VARCHAR) AS run_id, {tag_case} AS key FROM events
  UNION ALL SELECT run_id, 'dataset_version' FROM runs
  UNION ALL SELECT run_id, 'feature_schema_version' FROM runs),
required_tags(key) AS (VALUES {required}),
tag_audit AS (
  SELECT r.run_id, t.key AS missing_tag FROM runs r CROSS JOIN required_tags t
  WHERE NOT EXISTS (SELECT 1 FROM tags x WHERE x.run_id = r.run_id AND x.key = t.key))"""

