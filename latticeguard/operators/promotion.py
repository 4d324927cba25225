"""Model promotion: run ledger -> comparison -> ordered gates -> decision (S8, S9, J1, J2, J9,
U1, U3, W7, F4-F6, F9, G1-G14).

Everything is long-format DataFrames keyed by model (and metric), so every
model of every environment is decided in one job:

* latest metric per (run, key): `max_by(value, struct(ts, step))` (partial aggregation);
* champion vs candidate: full outer equi-join on (model, metric) (J1);
* policy bars: per-environment rules are literals exploded per model (no join
  against a rules table, no cross join), then equi-joined to the comparison on
  (model, metric) (J9);
* the gate ledger keeps every failure; the decision is the first one by
  (gate order, metric) via `min_by` (G10), so later failures stay visible.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Policy

# Gate names in evaluation order, and reason message formats.
GATES = ("comparability", "absolute floor", "relative improvement", "regression", "age", "environment gating")
MSG_MISSING_EVAL = "the {side} has no evaluation record, so there is nothing to compare"
MSG_DATASET_MISMATCH = ("the two models are evaluated with different datasets - champion on `{champion}`, "
                        "candidate on `{candidate}`. they must have the same dataset to be compared.")
MSG_METRIC_MISSING = "metric `{metric}` is included in the {side} but not the other side"
MSG_NO_METRICS = "neither side has any metrics"
MSG_BELOW_FLOOR = "{metric} is {observed:.4}, must be above {floor:.4} for this environment"
MSG_NOT_ENOUGH_BETTER = "{metric} moves {gap:+.4} against the champion. the policy requires at least {required:+.4}"
MSG_REGRESSION = "{metric} is {regression:.4} less than in the champion. it can lose at most {allowed:.4}"
MSG_NOT_EVALUATED = "metric `{metric}` is referenced by policy but is not in the comparison"
MSG_TOO_OLD = ("the candidate's evaluation is {age_days} days old; policy allows at most {max_days} days "
               "— re-evaluate before promoting")
MSG_RATE_LIMITED = "{environment} last promoted a model too recently; policy requires waiting until {until}"

CHAMPION, CANDIDATE = "champion", "candidate"


def _gate_order(name: str) -> int:
    return GATES.index(name)


# --- ledger reads ------------------------------------------------------------------

def latest_metrics(run_metrics: DataFrame) -> DataFrame:
    """Latest value per (run_id, key) by (ts, step)."""
    return run_metrics.groupBy("run_id", "key").agg(
        F.max_by("value", F.struct("ts", "step")).alias("value")
    )


def merge_metric_sets(*frames: DataFrame) -> DataFrame:
    """Union of metric sets (run_id, key, value); a later frame wins per key."""
    tagged = [f.select("run_id", "key", "value", F.lit(i).alias("_src")) for i, f in enumerate(frames)]
    u = tagged[0]
    for f in tagged[1:]:
        u = u.unionByName(f)
    return u.groupBy("run_id", "key").agg(F.max_by("value", "_src").alias("value"))


def evaluations(runs: DataFrame, run_params: DataFrame, now: Column) -> DataFrame:
    """dataset_id param (default 'unknown'), evaluated_at = end time (default now)."""
    ds = run_params.where(F.col("key") == "dataset_id").groupBy("run_id").agg(F.max("value").alias("dataset_id"))
    return runs.join(ds, "run_id", "left").select(
        "run_id",
        F.coalesce(F.col("dataset_id"), F.lit("unknown")).alias("dataset_id"),
        F.coalesce(F.col("end_time"), now).alias("evaluated_at"),
        F.col("dataset_id").isNull().alias("dataset_unknown"),
    )


def resolve_aliases(model_aliases: DataFrame, model_versions: DataFrame) -> DataFrame:
    """Per model, candidate and (optional) champion version and run.

    A missing champion alias is normal (NULL); a version without run_id is an
    error carried in `resolve_error` (T18)."""
    mv = model_versions.select("model", "version", "run_id")

    def side(alias: str, prefix: str) -> DataFrame:
        a = model_aliases.where(F.col("alias") == alias).select("model", F.col("version").alias(f"{prefix}_version"))
        return a.join(mv.withColumnRenamed("version", f"{prefix}_version").withColumnRenamed("run_id", f"{prefix}_run"),
                      ["model", f"{prefix}_version"], "left")

    cand = side(CANDIDATE, "cand")
    champ = side(CHAMPION, "champ")
    j = cand.join(champ, "model", "left")
    err = (
        F.when(F.col("cand_run").isNull(),
               F.format_string("model version %s has no run_id", F.col("cand_version").cast("string")))
        .when(F.col("champ_version").isNotNull() & F.col("champ_run").isNull(),
              F.format_string("model version %s has no run_id", F.col("champ_version").cast("string")))
    )
    return j.withColumn("resolve_error", err)


# --- comparison --------------------------------------------------------------------

def metric_pairs(resolved: DataFrame, latest: DataFrame) -> DataFrame:
    """(model, metric, champion, candidate, gap) by full outer join on (model, metric)."""
    cand = resolved.select("model", F.col("cand_run").alias("run_id")).join(latest, "run_id") \
        .select("model", F.col("key").alias("metric"), F.col("value").alias("candidate"))
    champ = resolved.where(F.col("champ_run").isNotNull()) \
        .select("model", F.col("champ_run").alias("run_id")).join(latest, "run_id") \
        .select("model", F.col("key").alias("metric"), F.col("value").alias("champion"))
    return champ.join(cand, ["model", "metric"], "full").withColumn("gap", F.col("candidate") - F.col("champion"))


def comparability(resolved: DataFrame, evals: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per model with the first refusal reason (NULL = comparable)."""
    e = evals.select("run_id", "dataset_id", "evaluated_at")
    r = (
        resolved.join(e.select(F.col("run_id").alias("cand_run"), F.col("dataset_id").alias("cand_dataset"),
                               F.col("evaluated_at").alias("cand_evaluated_at")), "cand_run", "left")
        .join(e.select(F.col("run_id").alias("champ_run"), F.col("dataset_id").alias("champ_dataset"),
                       F.col("evaluated_at").alias("champ_evaluated_at")), "champ_run", "left")
    )
    per_model = pairs.groupBy("model").agg(
        F.count_if(F.col("champion").isNotNull()).alias("n_champ_metrics"),
        F.count_if(F.col("candidate").isNotNull()).alias("n_cand_metrics"),
        F.min(F.when(F.col("candidate").isNull(), F.col("metric"))).alias("champ_only"),
        F.min(F.when(F.col("champion").isNull(), F.col("metric"))).alias("cand_only"),
    )
    r = r.join(per_model, "model", "left")
    reason = (
        F.when(F.col("champ_run").isNull(), F.lit(MSG_MISSING_EVAL.format(side=CHAMPION)))
        .when(F.col("champ_dataset") != F.col("cand_dataset"),
              F.format_string(MSG_DATASET_MISMATCH.replace("{champion}", "%s").replace("{candidate}", "%s"),
                              F.col("champ_dataset"), F.col("cand_dataset")))
        .when(F.coalesce(F.col("n_champ_metrics"), F.lit(0)) + F.coalesce(F.col("n_cand_metrics"), F.lit(0)) == 0,
              F.lit(MSG_NO_METRICS))
        .when(F.col("champ_only").isNotNull(),
              F.format_string(MSG_METRIC_MISSING.replace("{metric}", "%s").replace("{side}", CHAMPION),
                              F.col("champ_only")))
        .when(F.col("cand_only").isNotNull(),
              F.format_string(MSG_METRIC_MISSING.replace("{metric}", "%s").replace("{side}", CANDIDATE),
                              F.col("cand_only")))
    )
    return r.withColumn("refusal", reason)


# --- gates -------------------------------------------------------------------------

def _rules_array(policy: Policy) -> Column:
    """Every (environment, deployment) rule set as a literal array of structs."""
    rows = []
    for r in policy.all_rules():
        bars = [F.struct(F.lit("floor").alias("kind"), F.lit(m).alias("metric"), F.lit(float(b)).alias("bound"))
                for m, b in r.floors]
        bars += [F.struct(F.lit("regression").alias("kind"), F.lit(m).alias("metric"), F.lit(float(b)).alias("bound"))
                 for m, b in r.max_regressions]
        bar_arr = F.array(*bars) if bars else F.array().cast(
            "array<struct<kind:string,metric:string,bound:double>>")
        rows.append(F.struct(
            F.lit(r.environment).alias("environment"), F.lit(r.deployment).alias("deployment"),
            F.lit(r.primary_metric).alias("primary_metric"), F.lit(float(r.min_primary_margin)).alias("margin"),
            F.lit(int(r.max_eval_age_days)).alias("max_age_days"),
            F.lit(int(r.min_promotion_interval_hours)).alias("interval_hours"),
            F.lit(r.on_pass).alias("on_pass"), bar_arr.alias("bars"),
        ))
    return F.array(*rows)


def _fmt(template: str, *cols: Column) -> Column:
    """A message; its numbers are those of the ledger's number columns, rounded half away from zero."""
    spots = re.findall(r"%[+.0-9]*[a-z]", template)
    return F.format_string(template, *(F.round(F.round(c, 9), 4) if spot.endswith("f") else c for c, spot in zip(cols, spots, strict=True)))


def gate_ledger(comp: DataFrame, pairs: DataFrame, policy: Policy, now: Column,
                last_promoted: DataFrame | None = None, deployment_col: str = "deployment") -> DataFrame:
    """Every failing gate per (environment, model) as rows:
    (environment, model, gate, gate_order, metric, outcome, reason)."""
    per_env = (
        comp.select("model", deployment_col, "refusal", "cand_evaluated_at")
        .withColumn("rule", F.explode(_rules_array(policy)))
        .where(F.col(f"rule.deployment") == F.col(deployment_col))
        .select("model", "refusal", "cand_evaluated_at", "rule.*")
    )
    comparable = per_env.where(F.col("refusal").isNull())

    # comparability refusal -> park
    refused = per_env.where(F.col("refusal").isNotNull()).select(
        "environment", "model", F.lit(GATES[0]).alias("gate"), F.lit(0).alias("gate_order"),
        F.lit(None).cast("string").alias("metric"), F.lit("park").alias("outcome"), F.col("refusal").alias("reason"),
        F.lit(None).cast("double").alias("observed"), F.lit(None).cast("double").alias("required"))

    p = pairs.select("model", "metric", "champion", "candidate", "gap")

    # floors and regressions: explode bars, left join to the comparison
    bars = comparable.select("environment", "model", F.explode("bars").alias("bar")).select(
        "environment", "model", "bar.kind", "bar.metric", "bar.bound")
    bj = bars.join(p, ["model", "metric"], "left")
    not_eval = _fmt(MSG_NOT_EVALUATED.replace("{metric}", "%s"), F.col("metric"))
    lost = -F.col("gap")
    floor_fail = (
        F.when(F.col("candidate").isNull(), not_eval)
        .when(F.col("candidate") < F.col("bound"),
              _fmt(MSG_BELOW_FLOOR.replace("{metric}", "%s").replace("{observed:.4}", "%.4f")
                   .replace("{floor:.4}", "%.4f"), F.col("metric"), F.col("candidate"), F.col("bound")))
    )
    reg_fail = (
        F.when(F.col("gap").isNull(), not_eval)
        .when(~F.isnan(lost) & (lost > F.col("bound")),  # NaN loss passes, as in IEEE comparison
              _fmt(MSG_REGRESSION.replace("{metric}", "%s").replace("{regression:.4}", "%.4f")
                   .replace("{allowed:.4}", "%.4f"), F.col("metric"), lost, F.col("bound")))
    )
    bar_rows = bj.select(
        "environment", "model",
        F.when(F.col("kind") == "floor", F.lit(GATES[1])).otherwise(F.lit(GATES[3])).alias("gate"),
        F.when(F.col("kind") == "floor", F.lit(1)).otherwise(F.lit(3)).alias("gate_order"),
        "metric", F.lit("reject").alias("outcome"),
        F.when(F.col("kind") == "floor", floor_fail).otherwise(reg_fail).alias("reason"),
        F.when(F.col("kind") == "floor", F.col("candidate")).otherwise(lost).alias("observed"),
        F.col("bound").alias("required"),
    ).where(F.col("reason").isNotNull())

    # relative improvement on the primary metric
    prim = comparable.select("environment", "model", F.col("primary_metric").alias("metric"), "margin") \
        .join(p, ["model", "metric"], "left")
    imp_fail = (
        F.when(F.col("gap").isNull(), not_eval)
        .when(F.col("gap") < F.col("margin"),
              _fmt(MSG_NOT_ENOUGH_BETTER.replace("{metric}", "%s").replace("{gap:+.4}", "%+.4f")
                   .replace("{required:+.4}", "%+.4f"), F.col("metric"), F.col("gap"), F.col("margin")))
    )
    imp_rows = prim.select("environment", "model", F.lit(GATES[2]).alias("gate"), F.lit(2).alias("gate_order"),
                           "metric", F.lit("reject").alias("outcome"), imp_fail.alias("reason"),
                           F.col("gap").alias("observed"), F.col("margin").alias("required")) \
        .where(F.col("reason").isNotNull())

    # age: whole days (truncated) between candidate evaluation and now
    age_days = F.timestamp_diff("DAY", F.col("cand_evaluated_at").cast("timestamp"), now.cast("timestamp"))
    age_rows = comparable.select(
        "environment", "model", F.lit(GATES[4]).alias("gate"), F.lit(4).alias("gate_order"),
        F.lit(None).cast("string").alias("metric"), F.lit("park").alias("outcome"),
        F.when(age_days > F.col("max_age_days"),
               _fmt(MSG_TOO_OLD.replace("{age_days}", "%d").replace("{max_days}", "%d"),
                    age_days, F.col("max_age_days"))).alias("reason"),
        age_days.cast("double").alias("observed"), F.col("max_age_days").cast("double").alias("required"),
    ).where(F.col("reason").isNotNull())

    out = refused.unionByName(bar_rows).unionByName(imp_rows).unionByName(age_rows)

    # rate: now < last promotion + interval hours (W7 + F6)
    if last_promoted is not None:
        lp = last_promoted.groupBy("environment", "model").agg(F.max("promoted_at").alias("last_promoted_at"))
        until = F.col("last_promoted_at") + F.make_dt_interval(F.lit(0), F.col("interval_hours"))
        rate = comparable.select("environment", "model", "interval_hours").join(lp, ["environment", "model"], "inner")
        rate_rows = rate.select(
            "environment", "model", F.lit(GATES[5]).alias("gate"), F.lit(5).alias("gate_order"),
            F.lit(None).cast("string").alias("metric"), F.lit("park").alias("outcome"),
            F.when(now.cast("timestamp") < until,
                   _fmt(MSG_RATE_LIMITED.replace("{environment}", "%s").replace("{until}", "%s"),
                        F.col("environment"),
                        F.concat(F.date_format(until, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))).alias("reason"),
            F.lit(None).cast("double").alias("observed"), F.col("interval_hours").cast("double").alias("required"),
        ).where(F.col("reason").isNotNull())
        out = out.unionByName(rate_rows)
    return out


def decisions(comp: DataFrame, ledger: DataFrame, policy: Policy, deployment_col: str = "deployment",
              bootstrap: bool = True) -> DataFrame:
    """First failure per (environment, model) by (gate order, metric); none -> approve.

    With `bootstrap`, a model without a champion alias is approved (first
    promotion); the pure comparator (bootstrap=False) parks it instead."""
    first = ledger.groupBy("environment", "model").agg(
        F.min_by(F.struct("outcome", "gate", "metric", "reason", "observed", "required"),
                 F.struct("gate_order", F.coalesce(F.col("metric"), F.lit("")))).alias("f"),
        F.count(F.lit(1)).alias("n_failures"),
    )
    envs = comp.select("model", deployment_col, "champ_run", "resolve_error") \
        .withColumn("rule", F.explode(_rules_array(policy))) \
        .where(F.col("rule.deployment") == F.col(deployment_col)) \
        .select("model", "champ_run", "resolve_error", F.col("rule.environment").alias("environment"),
                F.col("rule.on_pass").alias("on_pass"))
    j = envs.join(first, ["environment", "model"], "left")
    is_boot = F.lit(bootstrap) & F.col("champ_run").isNull()
    return j.select(
        "environment", "model",
        F.when(F.col("resolve_error").isNotNull(), F.lit("error"))
        .when(is_boot, F.lit("approve"))
        .when(F.col("f").isNull(), F.lit("approve"))
        .otherwise(F.col("f.outcome")).alias("outcome"),
        F.when(F.col("resolve_error").isNotNull() | is_boot, F.lit(None).cast("string"))
        .otherwise(F.col("f.gate")).alias("gate"),
        F.when(F.col("resolve_error").isNotNull(), F.col("resolve_error"))
        .when(is_boot, F.lit("no champion alias yet: first promotion"))
        .otherwise(F.col("f.reason")).alias("reason"),
        F.when(F.col("resolve_error").isNotNull() | is_boot, F.lit(None).cast("string"))
        .otherwise(F.col("f.metric")).alias("metric"),
        F.when(F.col("resolve_error").isNotNull() | is_boot, F.lit(None).cast("double"))
        .otherwise(F.col("f.observed")).alias("observed"),
        F.when(F.col("resolve_error").isNotNull() | is_boot, F.lit(None).cast("double"))
        .otherwise(F.col("f.required")).alias("required"),
        F.when(is_boot, F.lit(0)).otherwise(F.coalesce(F.col("n_failures"), F.lit(0))).cast("long").alias("n_failures"),
        "on_pass",
    )


def alias_flip(model_aliases: DataFrame, resolved: DataFrame, decided: DataFrame, environment: str) -> DataFrame:
    """Approved models move `champion` to the candidate's version (keyed upsert)."""
    approved = decided.where((F.col("environment") == environment) & (F.col("outcome") == "approve")) \
        .join(resolved.select("model", "cand_version"), "model") \
        .select("model", F.lit(CHAMPION).alias("alias"), F.col("cand_version").alias("version"))
    keep = model_aliases.join(approved.select("model", "alias"), ["model", "alias"], "left_anti")
    return keep.unionByName(approved.select("model", "alias", "version"))

