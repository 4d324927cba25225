"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query has a DuckDB oracle of the same name in `oracle.py` unless it is
genuinely not SQL-expressible (model training, iterative loops).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions.exprs import clip01, priority_bucket
from ..operators import features as feat
from ..operators import promotion as pm
from ..schemas import FEATURES
from ..sources.tables import spread
from .inventory import Inventory, shared_inventory

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def inventory(spark: SparkSession, sf_dir: str) -> Inventory:
    return shared_inventory(spark, sf_dir)


def r9(c):
    return F.round(c, 9)


def r6(c):
    return F.round(c, 6)


# --- step 1-2: inventory -------------------------------------------------------

@register("asset_inventory")
def asset_inventory(spark, sf_dir):
    return inventory(spark, sf_dir).assets


@register("finding_dedupe")
def finding_dedupe(spark, sf_dir):
    f = inventory(spark, sf_dir).findings
    return f.select(
        "finding_id", "asset_id", "source", "algorithm", "key_size", "quantum_vulnerable",
        "signature_algorithm", "issuer",
        F.col("not_after").cast("date").alias("not_after"),
        F.col("discovered_at").cast("date").alias("discovered_at"),
    )


@register("classify_findings")
def classify_findings(spark, sf_dir):
    f = inventory(spark, sf_dir).findings
    return f.groupBy("algorithm", "quantum_vulnerable").agg(F.count(F.lit(1)).alias("n_findings"))


@register("asset_features")
def asset_features(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return inv.features.drop("qv_raw")


@register("feature_profile")
def feature_profile(spark, sf_dir):
    p = feat.feature_profile(inventory(spark, sf_dir).features)
    return p.select("feature", r9(F.col("null_rate")).alias("null_rate"), "row_count")


@register("finding_rollup")
def finding_rollup(spark, sf_dir):
    r = inventory(spark, sf_dir).rollup
    return r.select(
        "asset_id", "n_findings", "n_vulnerable", "n_unknown",
        F.col("last_discovered_at").cast("date").alias("last_discovered_at"),
        F.col("primary.finding_id").alias("primary_finding_id"),
        F.col("primary.algorithm").alias("primary_algorithm"),
    )


# --- step 3: labels and buckets --------------------------------------------------

@register("rule_label")
def rule_label(spark, sf_dir):
    return inventory(spark, sf_dir).rule_labelled.select("asset_id", r9(F.col("risk_score")).alias("risk_score"))


@register("rule_label_noisy")
def rule_label_noisy(spark, sf_dir):
    return inventory(spark, sf_dir).labelled.select("asset_id", r9(F.col("risk_score")).alias("risk_score"))


@register("priority_buckets")
def priority_buckets(spark, sf_dir):
    """Flagship: assets and mean rule score per priority bucket."""
    lab = inventory(spark, sf_dir).rule_labelled
    return (
        lab.withColumn("priority", priority_bucket(F.col("risk_score"), Thresholds()))
        .groupBy("priority")
        .agg(F.count(F.lit(1)).alias("n_assets"), r6(F.avg("risk_score")).alias("mean_score"))
    )


@register("deployment_priorities")
def deployment_priorities(spark, sf_dir):
    """J3 with thresholds as a table: each nation is a deployment, whose bars are shifted by its key."""
    from latticeguard.operators.deployments import priority_by_deployment
    from latticeguard.sources.tables import read_table

    scored = inventory(spark, sf_dir).rule_labelled.select((F.col("asset_id") % 25).alias("deployment"), "risk_score")
    sets = F.array(*(F.struct(F.lit(p).alias("priority"), F.lit(float(m)).alias("bar")) for p, m in Thresholds().buckets))
    bars = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("deployment"), F.inline(sets))
    bars = bars.select("deployment", "priority", (F.col("bar") - (F.col("deployment") % 5).cast("double") / 40).alias("min_score"))
    return priority_by_deployment(scored, bars).groupBy("deployment", "priority").agg(F.count(F.lit(1)).alias("n_assets"))


# --- step 4: strata, splits, folds ----------------------------------------------

from ..operators import splits as spl  # noqa: E402


@register("label_quantile_edges")
def label_quantile_edges(spark, sf_dir):
    lab = inventory(spark, sf_dir).labelled
    edges = spl.quantile_edges(lab, "risk_score", 4)
    rows = [(float(p), float(e)) for p, e in zip(spl.QUARTILES, edges)]
    return spark.createDataFrame(rows, "p double, edge double").select("p", r9(F.col("edge")).alias("edge"))


@register("label_strata")
def label_strata(spark, sf_dir):
    return spl.label_strata(inventory(spark, sf_dir).labelled).select("asset_id", "stratum")


@register("stratified_split")
def stratified_split(spark, sf_dir):
    return spl.stratified_split(inventory(spark, sf_dir).labelled).select("asset_id", "stratum", "split")


@register("shuffled_split")
def shuffled_split(spark, sf_dir):
    return spl.shuffled_split(inventory(spark, sf_dir).labelled).select("asset_id", "split")


@register("kfold_assignment")
def kfold_assignment(spark, sf_dir):
    return spl.kfold(inventory(spark, sf_dir).labelled).select("asset_id", "fold")


@register("kfold_sizes")
def kfold_sizes(spark, sf_dir):
    return spl.kfold(inventory(spark, sf_dir).labelled).groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"))


# --- step 5: evaluation on the stand-in prediction -----------------------------

from ..operators import evaluation as ev  # noqa: E402


def _pred(spark, sf_dir):
    return inventory(spark, sf_dir).standin_predictions


@register("test_predictions")
def test_predictions(spark, sf_dir):
    """The model's test table. The learner's scores differ between engines, so the checked form
    has the true columns and whether each prediction is a score with its own bucket."""
    p = inventory(spark, sf_dir).demo_predictions
    score = F.col("predicted_score")
    return p.select(
        "asset_id", r9(F.col("risk_score")).alias("risk_score"), "actual_priority",
        F.coalesce(score.between(0.0, 1.0), F.lit(False)).alias("score_in_range"),
        F.col("predicted_priority").eqNullSafe(priority_bucket(score, Thresholds())).alias("bucket_agrees"))


@register("test_predictions_values")
def test_predictions_values(spark, sf_dir):
    """The model's test table itself (no oracle: the learner differs between engines)."""
    return inventory(spark, sf_dir).demo_predictions.select(
        "asset_id", "risk_score", "predicted_score", "actual_priority", "predicted_priority")


@register("standin_predictions")
def standin_predictions(spark, sf_dir):
    """The fixture the metric queries read: the test label plus keyed noise, not a model."""
    return _pred(spark, sf_dir).select(
        "asset_id", r9(F.col("risk_score")).alias("risk_score"), r9(F.col("predicted_score")).alias("predicted_score"),
        "actual_priority", "predicted_priority")


@register("regression_metrics")
def regression_metrics(spark, sf_dir):
    m = ev.regression_metrics(_pred(spark, sf_dir))
    return m.select("n", *[r9(F.col(c)).alias(c) for c in ("mae", "rmse", "r2", "pearson_r")])


@register("baseline_mae_test")
def baseline_mae_test(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return ev.baseline_mae(inv.test, inv.test).select(r9(F.col("baseline_mae")).alias("baseline_mae"))


@register("baseline_mae_train")
def baseline_mae_train(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return ev.baseline_mae(inv.test, inv.train).select(r9(F.col("baseline_mae")).alias("baseline_mae"))


@register("label_stats")
def label_stats(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return ev.label_stats(inv.train).withColumn("part", F.lit("train")).unionByName(
        ev.label_stats(inv.test).withColumn("part", F.lit("test")))


@register("confusion_matrix")
def confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(_pred(spark, sf_dir))


@register("bucket_macro_f1")
def bucket_macro_f1(spark, sf_dir):
    return ev.macro_f1(ev.confusion_matrix(_pred(spark, sf_dir))).select(
        r9(F.col("bucket_macro_f1")).alias("bucket_macro_f1"))


@register("per_label_f1")
def per_label_f1(spark, sf_dir):
    f = ev.per_label_f1(ev.confusion_matrix(_pred(spark, sf_dir)))
    return f.select("priority", "support", "tp", "predicted",
                    *[r9(F.col(c)).alias(c) for c in ("precision", "recall", "f1")])


@register("under_scored")
def under_scored(spark, sf_dir):
    return ev.under_scored(_pred(spark, sf_dir)).select(
        "asset_id", "actual_priority", "predicted_priority", r9(F.col("predicted_score")).alias("predicted_score"))


@register("over_scored")
def over_scored(spark, sf_dir):
    return ev.over_scored(_pred(spark, sf_dir)).select(
        "asset_id", "actual_priority", "predicted_priority", r9(F.col("predicted_score")).alias("predicted_score"))


@register("error_counts")
def error_counts(spark, sf_dir):
    return ev.error_counts(_pred(spark, sf_dir))


@register("bucket_match_rate")
def bucket_match_rate(spark, sf_dir):
    return ev.bucket_match_rate(_pred(spark, sf_dir)).select(r9(F.col("bucket_match_rate")).alias("bucket_match_rate"))


@register("calibration_deciles")
def calibration_deciles(spark, sf_dir):
    c = ev.calibration_deciles(_pred(spark, sf_dir))
    return c.select("bin", r9(F.col("mean_predicted")).alias("mean_predicted"),
                    r9(F.col("mean_actual")).alias("mean_actual"), "n")


@register("threshold_sweep")
def threshold_sweep(spark, sf_dir):
    s = ev.threshold_sweep(_pred(spark, sf_dir))
    return s.select("cutoff", "tp", "fp", "fn", *[r9(F.col(c)).alias(c) for c in ("precision", "recall", "f1", "brier")])


@register("roc_auc")
def roc_auc(spark, sf_dir):
    a = ev.roc_auc(_pred(spark, sf_dir))
    return a.select("cutoff", r9(F.col("auc")).alias("auc"), "n_pos", "n_neg")


# --- step 6: model train / tune / score (rows-only checks: learner output) ------

from ..operators import training as trn  # noqa: E402
from ..session import checkpoint_dir  # noqa: E402


@register("cv_results")
def cv_results(spark, sf_dir):
    """M2-M4/K1: 4 configs x 5 keyed folds. Checked as bounds: every config beats predicting the mean
    at least twofold, its folds agree, and exactly one is the best."""
    inv = inventory(spark, sf_dir)
    r = inv.trained.cv_results
    base = ev.baseline_mae(inv.train, inv.train).select("baseline_mae").scalar()
    best = r.agg(F.min(F.struct("cv_mae_mean", "grid_index"))["grid_index"]).scalar()
    chosen = (F.col("n_estimators") == inv.trained.best[0]) & (F.col("max_depth") == inv.trained.best[1])
    return r.select("grid_index", "n_estimators", "max_depth", "learning_rate",
                    (F.col("cv_mae_mean") * 2 <= base).alias("beats_mean_twofold"),
                    (F.col("cv_mae_std") < F.col("cv_mae_mean")).alias("folds_agree"),
                    (chosen == (F.col("grid_index") == best)).alias("choice_is_the_best"))


@register("cv_results_values")
def cv_results_values(spark, sf_dir):
    """One row per config with mean and population std of its folds' MAE, best first (ties in grid order)."""
    trained = inventory(spark, sf_dir).trained
    chosen = (F.col("n_estimators") == trained.best[0]) & (F.col("max_depth") == trained.best[1]) & (
        F.col("learning_rate") == trained.best[2])
    return trained.cv_results.withColumn("chosen", chosen).orderBy("cv_mae_mean", "grid_index")


@register("feature_importance")
def feature_importance(spark, sf_dir):
    """M5/K2: 16 importances, each a share; all add up to one."""
    imp = spark.createDataFrame(trn.feature_importance(inventory(spark, sf_dir).demo_model), trn.IMPORTANCE_SCHEMA)
    total = imp.agg(F.sum("importance")).scalar()
    return imp.select("feature", F.col("importance").between(0.0, 1.0).alias("is_share"),
                      (F.abs(total - 1.0) < 1e-9).alias("adds_up"))


@register("feature_importance_values")
def feature_importance_values(spark, sf_dir):
    """M5/K2: the 16 importances, highest first (ties by name)."""
    imp = spark.createDataFrame(trn.feature_importance(inventory(spark, sf_dir).demo_model), trn.IMPORTANCE_SCHEMA)
    return imp.orderBy(F.desc("importance"), "feature")


def _batch_scores(inv: Inventory) -> DataFrame:
    return trn.score_all(inv.demo_model, feat.encode_features(inv.features, "strict"))


@register("batch_scores_values")
def batch_scores_values(spark, sf_dir):
    """M7: (asset_id, risk_score, priority, encode_error) of every asset."""
    return _batch_scores(inventory(spark, sf_dir))


@register("batch_scores")
def batch_scores(spark, sf_dir):
    """M7: strict (serving) encode of every asset -> model -> clip -> bucket; an asset that can't be
    encoded keeps its error instead of a score."""
    inv = inventory(spark, sf_dir)
    b = _batch_scores(inv)
    score = F.col("risk_score")
    return b.select("asset_id", "encode_error", score.isNotNull().alias("scored"),
                    score.between(0.0, 1.0).alias("score_in_range"),
                    F.col("priority").eqNullSafe(priority_bucket(score, Thresholds())).alias("bucket_agrees"))


@register("encode_errors")
def encode_errors(spark, sf_dir):
    """The error output of JSON instances: some assets' instances have text, boolean, missing,
    unknown or numeric values where the encoder must not take them."""
    f = inventory(spark, sf_dir).features
    k = F.col("asset_id")

    def member(name, kind):
        text = F.col(name).cast("string")
        value = F.concat(F.lit('"'), text, F.lit('"')) if kind == "categorical" else text
        if name == "key_size":
            value = F.when(k % 11 == 0, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(value)
        elif name == "internet_accessible":
            value = F.when(k % 13 == 0, (F.col(name) == 1).cast("string")).otherwise(value)
        elif name == "criticality":
            value = F.when(k % 17 == 0, F.lower(value)).otherwise(value)
        elif name == "loc_estimate":
            value = F.when(k % 19 != 0, value)
        elif name == "network_zone":
            value = F.when(k % 23 == 0, F.lit("1")).otherwise(value)
        return F.concat(F.lit(f'"{name}":'), value)

    members = F.concat_ws(",", *(member(name, kind) for name, kind, _ in FEATURES), F.lit('"other":[1]'))
    json = F.when(k % 29 == 0, F.lit("no instance")).otherwise(F.concat(F.lit("{"), members, F.lit("}")))
    enc = feat.encode_instances(feat.require_rows(f).select("asset_id", json.alias("instance")), "instance")
    return enc.where(F.col("encode_error").isNotNull()).select("asset_id", "encode_error")


@register("model_quality")
def model_quality(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    y, p = F.col("risk_score"), F.col("predicted_score")
    base = ev.baseline_mae(inv.test, inv.train).select("baseline_mae").scalar()
    m = inv.demo_predictions.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(y - p)).alias("mae"), F.corr(y, p).alias("r"),
        F.avg((F.col("actual_priority") == F.col("predicted_priority")).cast("double")).alias("match"))
    return m.select("n", r9(base).alias("baseline_mae"), (F.col("mae") * 2 <= base).alias("beats_mean_twofold"),
                    (F.col("mae") >= base).alias("model_worse_than_baseline"),
                    (F.col("match") >= 0.75).alias("match_rate_reached"), (F.col("r") > 0.9).alias("correlates"))


@register("model_quality_values")
def model_quality_values(spark, sf_dir):
    """The fitted model's metrics on the test split beside the mean's."""
    inv = inventory(spark, sf_dir)
    base = ev.baseline_mae(inv.test, inv.train).select("baseline_mae").scalar()
    m = ev.regression_metrics(inv.demo_predictions).crossJoin(ev.bucket_match_rate(inv.demo_predictions))
    return m.withColumn("baseline_mae", base).withColumn("model_worse_than_baseline", F.col("mae") >= base)


@register("reload_equivalence")
def reload_equivalence(spark, sf_dir):
    """Save model + manifest, reload with the manifest check, compare predictions."""
    import uuid

    inv = inventory(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    trn.save(inv.demo_model, path, spark)
    return trn.reload_equivalence(inv.demo_model, path, inv.test_encoded)


@register("model_lifecycle")
def model_lifecycle(spark, sf_dir):
    """Two training runs logged, registered, decided on and promoted, the
    champion loaded by alias, and its scores appended; returns the alias table with the ledger's counts.
    The first version is promoted because there is no champion; the second, weaker one must not be."""
    import uuid

    from ..config import DEPLOYMENT, Policy
    from ..operators.registry import Ledger, metric_rows

    inv = inventory(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/ledger/{uuid.uuid4().hex}"
    ledger, model_name = Ledger(spark, root), "asset-risk"
    y, p = F.col("risk_score"), F.col("predicted_score")
    weak = trn.fit(trn._sized(inv.train_encoded), (3, 1, 0.1), seed=inv.seed)
    runs = (("run-1", inv.demo_model, (80, 3, 0.1), "2024-02-10 00:00:00"), ("run-2", weak, (3, 1, 0.1), "2024-02-12 00:00:00"))
    for run_id, model, (trees, depth, rate), ended in runs:
        pred = ev.with_buckets(model.transform(inv.test_encoded).select(
            "asset_id", "risk_score", clip01(F.col("raw_prediction")).alias("predicted_score")))
        trained = metric_rows(run_id, pred.agg((-F.avg(F.abs(y - p))).alias("neg_test_mae"), F.lit(-1.0).alias("test_r2")))
        diagnosed = metric_rows(run_id, ev.regression_metrics(pred).select(F.col("r2").alias("test_r2"), "pearson_r"))
        f1 = metric_rows(run_id, ev.macro_f1(ev.confusion_matrix(pred)))
        params = {"dataset_id": "features", "n_features": len(FEATURES), "n_estimators": trees, "max_depth": depth,
                  "learning_rate": rate, "feature_columns": ",".join(f[0] for f in FEATURES)}
        ledger.log_run(run_id, ended, params, trained, diagnosed, f1)
        path = f"{root}/models/{run_id}"
        trn.save(model, path, spark)
        ledger.register(model_name, run_id, path)
        ledger.promote(Policy(), DEPLOYMENT, "local", ended)
    champion, thresholds = ledger.load(model_name)
    scores = trn.score_all(champion, feat.encode_features(inv.features, "strict"), thresholds=thresholds)
    ledger.append_scores(scores, model_name, 1, "run-1", "2024-02-13 00:00:00")
    r2 = pm.latest_metrics(ledger.read("run_metrics")).where("key = 'test_r2' AND value > -1").count()
    return ledger.aliases().select(
        "model", "alias", "version", F.lit(ledger.read("promotions").count()).alias("n_promotions"),
        F.lit(ledger.read("risk_scores").count()).alias("n_scores"), F.lit(ledger.read("run_params").count()).alias("n_params"),
        F.lit(ledger.read("run_metrics").count()).alias("n_metrics"), F.lit(r2).alias("n_later_metric_won"))


# --- step 7: promotion over the events-derived run ledger -----------------------

from .promotion_plan import shared_plan as PromotionPlan  # noqa: E402


@register("run_latest_metrics")
def run_latest_metrics(spark, sf_dir):
    return PromotionPlan(spark, sf_dir).latest.select("run_id", "key", r9(F.col("value")).alias("value"))


@register("metric_comparison")
def metric_comparison(spark, sf_dir):
    p = PromotionPlan(spark, sf_dir).pairs
    return p.select("model", "metric", *[r9(F.col(c)).alias(c) for c in ("champion", "candidate", "gap")])


@register("comparability")
def comparability_q(spark, sf_dir):
    c = PromotionPlan(spark, sf_dir).comparison
    return c.select("model", "cand_run", "champ_run", "cand_dataset", "champ_dataset", "refusal")


def _numeric_reason(df):
    """Reason text embeds %.4f numbers whose half-way rounding differs between engines;
    the oracle-checked forms carry the numbers as columns instead."""
    return df.drop("reason").withColumn("observed", r9(F.col("observed"))).withColumn("required", r9(F.col("required")))


@register("gate_ledger")
def gate_ledger(spark, sf_dir):
    return _numeric_reason(PromotionPlan(spark, sf_dir).ledger)


@register("promotion_decisions")
def promotion_decisions(spark, sf_dir):
    return _numeric_reason(PromotionPlan(spark, sf_dir).decisions)


@register("promotion_report")
def promotion_report(spark, sf_dir):
    """Decision with its reason text."""
    return PromotionPlan(spark, sf_dir).decisions.select("environment", "model", "outcome", "gate", "reason")


@register("run_tag_audit")
def run_tag_audit(spark, sf_dir):
    return PromotionPlan(spark, sf_dir).tag_audit()


# --- step 8: property graph and its fixed queries ------------------------------

from ..operators import graph as gr  # noqa: E402
from ..sources.inventory import AS_OF_DATE  # noqa: E402


def _graph(spark, sf_dir):
    return inventory(spark, sf_dir).graph


@register("graph_nodes")
def graph_nodes(spark, sf_dir):
    return _graph(spark, sf_dir)[0]


@register("graph_edges")
def graph_edges(spark, sf_dir):
    return _graph(spark, sf_dir)[1]


@register("graph_node_counts")
def graph_node_counts(spark, sf_dir):
    return gr.node_counts(_graph(spark, sf_dir)[0])


@register("graph_upsert_idempotent")
def graph_upsert_idempotent(spark, sf_dir):
    """A batch that holds every node twice, once with an older, wrong property, is upserted into
    the derived nodes two times: the newer row of each key must win, whole, and nothing be added."""
    nodes, _ = _graph(spark, sf_dir)
    stale = nodes.withColumn("criticality", F.lit("STALE")).withColumn("key_size", F.lit(-1)).withColumn("seen", F.lit(1))
    batch = stale.unionByName(nodes.withColumn("seen", F.lit(2)))
    once = gr.upsert(nodes, batch, ["node_type", "node_id"], recency="seen")
    twice = gr.upsert(once, batch, ["node_type", "node_id"], recency="seen")
    return twice.groupBy("node_type").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("criticality") == "STALE").alias("n_stale"),
        F.sum("key_size").alias("sum_key_size"), F.count("criticality").alias("n_criticality"),
        F.countDistinct("name").alias("n_names"))


@register("graph_merge_sink")
def graph_merge_sink(spark, sf_dir):
    """The nodes in a key-ranged table under a commit log. A batch that renames the certificates of one
    key range, each with an older, wrong row too, is merged twice. Only the files of that range may be
    rewritten (under a quarter of all), the second merge must write nothing, and the first state stays readable."""
    import uuid

    from ..sources.tablelog import KeyedTable, TableLog

    nodes, _ = _graph(spark, sf_dir)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    log = TableLog(spark, f"{checkpoint_dir(spark).rstrip('/')}/sink/{uuid.uuid4().hex}", {"nodes": schema})
    keys = ["node_type", "node_id"]
    table = KeyedTable(log, "nodes", keys, file_rows=max(1, nodes.count() // 64))
    loaded, _ = table.merge(nodes)
    renewed = nodes.where("node_type = 'Certificate' AND node_id LIKE 'cert-77%'").withColumn("name", F.lit("renewed"))
    batch = renewed.withColumn("name", F.lit("stale")).withColumn("seen", F.lit(1)).unionByName(renewed.withColumn("seen", F.lit(2)))
    once, rewritten = table.merge(batch, recency="seen")
    twice, again = table.merge(batch, recency="seen")
    few = rewritten * 4 < len(loaded.entries("nodes"))
    before = table.read(loaded).groupBy("node_type").agg(F.count_if(F.col("name") == "renewed").alias("n_renewed_before"))
    after = table.read(twice).groupBy("node_type").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("name") == "renewed").alias("n_renewed"),
        F.count_if(F.col("name") == "stale").alias("n_stale"), F.countDistinct("node_id").alias("n_ids"))
    return after.join(before, "node_type").withColumn("few_files_rewritten", F.lit(few)).withColumn(
        "second_merge_wrote_nothing", F.lit(again == 0 and once.version == twice.version))


@register("critical_apps_on_algorithm")
def critical_apps_on_algorithm(spark, sf_dir):
    return gr.critical_apps_on_algorithm(*_graph(spark, sf_dir), algorithm="RSA", criticality="CRITICAL")


@register("downstream_of_certificate")
def downstream_of_certificate(spark, sf_dir):
    return gr.downstream_of_certificates(_graph(spark, sf_dir)[1])


@register("reachable_from_certificate")
def reachable_from_certificate(spark, sf_dir):
    """R5 as a closure over the whole edge table: what lies behind each certificate, and how far."""
    _, edges = _graph(spark, sf_dir)
    typed = edges.select(F.concat_ws(":", "src_type", "src").alias("src"), F.concat_ws(":", "dst_type", "dst").alias("dst"))
    certs = edges.where("src_type = 'Certificate'").select(F.concat_ws(":", "src_type", "src")).distinct()
    return rch.reachable(typed, certs).groupBy(F.substring_index("source", ":", -1).alias("cert")).agg(
        F.count_if(F.col("node").startswith("Algorithm:")).alias("n_algorithms"),
        F.count_if(F.col("node").startswith("DataAsset:")).alias("n_data_assets"), F.max("hops").alias("max_hops"))


@register("algorithms_protecting_customer_data")
def algorithms_protecting_customer_data(spark, sf_dir):
    return gr.algorithms_protecting(*_graph(spark, sf_dir), classification="customer")


@register("apps_per_algorithm")
def apps_per_algorithm(spark, sf_dir):
    return gr.apps_per_algorithm(_graph(spark, sf_dir)[1])


@register("data_only_behind_vulnerable")
def data_only_behind_vulnerable(spark, sf_dir):
    return gr.data_only_behind_vulnerable(*_graph(spark, sf_dir))


@register("apps_without_safe_path")
def apps_without_safe_path(spark, sf_dir):
    return gr.apps_without_safe_path(*_graph(spark, sf_dir))


@register("expiring_vulnerable_certs")
def expiring_vulnerable_certs(spark, sf_dir):
    return gr.expiring_vulnerable_certs(*_graph(spark, sf_dir), as_of=AS_OF_DATE, days=90)


# --- step 9: dependency levels and migration plans ------------------------------

from ..operators import agreement as agr  # noqa: E402
from ..operators import planner as pl  # noqa: E402
from ..operators import reach as rch  # noqa: E402


@register("dependency_levels")
def dependency_levels(spark, sf_dir):
    return inventory(spark, sf_dir).levels.select("asset_id", F.col("level").cast("int").alias("level"))


@register("dependency_closure")
def dependency_closure(spark, sf_dir):
    """Everything that each asset depends on, through however many others."""
    inv = inventory(spark, sf_dir)
    return rch.reachable(inv.edges, inv.assets.select("asset_id")).groupBy(F.col("source").alias("asset_id")).agg(
        F.count(F.lit(1)).alias("n_dependencies"), F.max("hops").alias("max_hops"), F.sum("node").alias("sum_dependencies"))


@register("cyclic_dependency_levels")
def cyclic_dependency_levels(spark, sf_dir):
    """O3 with cycles: some assets' dependencies also depend on them (asset k div 9 on k, for k mod 50 = 7)."""
    inv = inventory(spark, sf_dir)
    ids = inv.assets.select("asset_id")
    back = ids.where("asset_id % 50 = 7").select(F.expr("asset_id div 9").alias("src"), F.col("asset_id").alias("dst"))
    edges = inv.edges.select("src", "dst").union(back.join(ids.withColumnRenamed("asset_id", "src"), "src", "left_semi").select("src", "dst"))
    return rch.component_levels(ids, edges).select("asset_id", "component", "n_members", F.col("level").cast("int").alias("level"))


@register("plan_baseline")
def plan_baseline(spark, sf_dir):
    b = inventory(spark, sf_dir).baseline_plan
    return b.select("asset_id", r9(F.col("baseline_key")).alias("baseline_key"), "rank", "phase")


@register("plan_weighted")
def plan_weighted(spark, sf_dir):
    w = inventory(spark, sf_dir).weighted_plan
    return w.select("asset_id", F.col("level").cast("int").alias("level"), "sub_phase", "phase", "rank",
                    r9(F.col("score")).alias("score"), "reasoning")


@register("plan_violations")
def plan_violations(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return pl.plan_violations(inv.weighted_plan, inv.edges)


@register("plan_phase_summary")
def plan_phase_summary(spark, sf_dir):
    return pl.phase_summary(inventory(spark, sf_dir).weighted_plan).withColumn("level", F.col("level").cast("int"))


@register("plan_rank_agreement")
def plan_rank_agreement(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    a = pl.rank_agreement(inv.baseline_plan, inv.weighted_plan, k=100)
    return a.select(r9(F.col("spearman")).alias("spearman"), r9(F.col("topk_overlap")).alias("topk_overlap"))



@register("system_comparison")
def system_comparison(spark, sf_dir):
    """Both migration orders against the expert order (noise-free rule score)."""
    inv = inventory(spark, sf_dir)
    a = pl.system_comparison(inv.baseline_plan, inv.weighted_plan, inv.rule_labelled, k=100)
    return a.select("system", r9(F.col("spearman")).alias("spearman"), r9(F.col("topk_overlap")).alias("topk_overlap"),
                    "n")


@register("pairwise_agreement")
def pairwise_agreement(spark, sf_dir):
    """How many of all pairs of assets each migration order puts as the expert order does. Pair counts are
    shown as text, as they may exceed 64 bits."""
    inv = inventory(spark, sf_dir)
    expert = pl.average_rank_desc(inv.rule_labelled, "asset_id", "risk_score").withColumnRenamed("avg_rank", "rank")
    a = agr.pairwise_agreement(pl.system_ranks(inv.baseline_plan, inv.weighted_plan), expert, "asset_id")
    return a.select("system", "n", *(F.col(c).cast("string").alias(c) for c in ("comparable", "concordant", "discordant", "tied")),
                    r9(F.col("agreement")).alias("agreement"))


def _expert(spark, sf_dir):
    """Held-out rows scored by the model, judged by the noise-free rule score."""
    inv = inventory(spark, sf_dir)
    return ev.expert_frame(inv.demo_predictions, inv.rule_labelled, inv.train)


@register("expert_evaluation")
def expert_evaluation(spark, sf_dir):
    """M13 as bounds: the model against the expert, on rows that were never trained on."""
    inv = inventory(spark, sf_dir)
    base = ev.baseline_mae(inv.test, inv.train).select("baseline_mae").scalar()
    m = ev.expert_evaluation(_expert(spark, sf_dir))
    return m.select("n", "n_in_train", (F.col("mae") * 2 <= base).alias("beats_mean_twofold"),
                    (F.col("rmse") >= F.col("mae")).alias("rmse_at_least_mae"),
                    (F.col("bucket_match_rate") >= 0.75).alias("match_rate_reached"))


@register("expert_evaluation_values")
def expert_evaluation_values(spark, sf_dir):
    """MAE, RMSE and bucket match rate against the expert."""
    return ev.expert_evaluation(_expert(spark, sf_dir))


@register("agreement_rate_values")
def agreement_rate_values(spark, sf_dir):
    """(category, n_judged, n_agree, agreement_rate) per expert priority."""
    return ev.agreement_rate(_expert(spark, sf_dir))


@register("agreement_rate")
def agreement_rate(spark, sf_dir):
    """The model's priorities against the expert's, per expert priority; each rate is its own quotient."""
    a = ev.agreement_rate(_expert(spark, sf_dir))
    return a.select("category", "n_judged", (F.col("n_agree") <= F.col("n_judged")).alias("agreed_among_judged"),
                    (F.abs(F.col("agreement_rate") * F.col("n_judged") - F.col("n_agree")) < 1e-6).alias("rate_is_quotient"))


# --- step 10: ingest extras, retrieval, rule hits, search ------------------------

from ..operators import ingest as ing  # noqa: E402
from ..operators import retrieval as rt  # noqa: E402
from ..operators.passage_index import PassageIndex  # noqa: E402
from ..operators.text_search import TrigramIndex  # noqa: E402
from ..operators.vector_index import CellIndex, centroid_queries  # noqa: E402

SEARCH_TERMS = ("rsa", "ml-", "repo/")


@register("scan_coverage")
def scan_coverage(spark, sf_dir):
    c = ing.scan_coverage(inventory(spark, sf_dir).scan_attempts)
    return c.select("outcome", "reason", "n_attempts", r9(F.col("coverage")).alias("coverage"))


@register("asset_resolution")
def asset_resolution(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return ing.resolve_assets(inv.findings, inv.assets)


@register("scan_target_parse")
def scan_target_parse(spark, sf_dir):
    """A target list (comments, blanks, optional ports) written as text and read back."""
    import uuid

    k = F.col("c_custkey")
    line = (F.when(k % 10 == 0, F.concat(F.lit("# group "), k.cast("string")))
            .when(k % 7 == 0, F.lit("   "))
            .otherwise(F.concat(F.lit("asset-"), k.cast("string"), F.lit(".internal"),
                                F.when(k % 3 == 0, F.lit(":8443")).otherwise(F.lit("")))))
    path = f"{checkpoint_dir(spark).rstrip('/')}/targets/{uuid.uuid4().hex}"
    inventory(spark, sf_dir).t.customer.select(line.alias("value")).write.text(path)
    return ing.parse_targets(spark.read.text(path))


@register("document_chunks")
def document_chunks(spark, sf_dir):
    return rt.chunks(spread(inventory(spark, sf_dir).t.documents.select("doc_id", "text", "source", "lang")))


@register("page_chunks")
def page_chunks(spark, sf_dir):
    """Chunks of the pages' articles with url, title and section."""
    sections = rt.page_sections(spread(inventory(spark, sf_dir).t.pages.select("page_id", "url", "html")))
    return rt.chunk_words(sections, ("page_id", "url", "title", "section_no", "section"), "text")


def _topk(spark, sf_dir, metric):
    emb = inventory(spark, sf_dir).t.embeddings.select("vec_id", "label", "embedding")
    res = rt.topk(emb, rt.class_centroid_queries(emb), k=5, metric=metric)
    return res.select("query_id", "rank", "vec_id", "label", r9(F.col("score")).alias("score"))


@register("embedding_topk_cosine")
def embedding_topk_cosine(spark, sf_dir):
    return _topk(spark, sf_dir, "cosine")


@register("embedding_topk_l2")
def embedding_topk_l2(spark, sf_dir):
    return _topk(spark, sf_dir, "l2")


def _topk_indexed(spark, sf_dir, metric):
    emb = inventory(spark, sf_dir).t.embeddings.select("vec_id", "label", "embedding")
    index = CellIndex.build(emb, _index_root(spark, f"cells-{metric}"), metric)
    res = index.search(centroid_queries(spark, rt.class_centroid_queries(emb)), k=5)
    return res.select("query_id", "rank", "vec_id", "label", r9(F.col("score")).alias("score"))


@register("embedding_topk_cosine_indexed")
def embedding_topk_cosine_indexed(spark, sf_dir):
    """K3 by the cell index: the same rows as `embedding_topk_cosine`."""
    return _topk_indexed(spark, sf_dir, "cosine")


@register("embedding_topk_l2_indexed")
def embedding_topk_l2_indexed(spark, sf_dir):
    """K3 by the cell index: the same rows as `embedding_topk_l2`."""
    return _topk_indexed(spark, sf_dir, "l2")


def _chunk_emb(spark, sf_dir):
    docs = spread(inventory(spark, sf_dir).t.documents.select("doc_id", "text", "source", "lang"))
    return rt.chunk_embeddings(rt.chunks(docs))


@register("chunk_embeddings")
def chunk_embeddings(spark, sf_dir):
    return _chunk_emb(spark, sf_dir).select("doc_id", "chunk_no", "n_tokens", "n_terms",
                                            r9(F.col("norm")).alias("norm"))


@register("retrieve_passages")
def retrieve_passages(spark, sf_dir):
    """For every benchmark passage, the 5 document chunks closest to it (and their source)."""
    bench = inventory(spark, sf_dir).t.benchmark
    res = rt.retrieve(_chunk_emb(spark, sf_dir), rt.query_terms(bench, "item_id", "text"), k=5)
    return res.select(F.col("query_id").alias("item_id"), "rank", "doc_id", "chunk_no", "source",
                      r9(F.col("score")).alias("score"))


def _index_root(spark, name):
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/index/{name}-{uuid.uuid4().hex}"


@register("retrieve_passages_indexed")
def retrieve_passages_indexed(spark, sf_dir):
    """R14 by the inverted index: the same rows as `retrieve_passages`."""
    index = PassageIndex.build(_chunk_emb(spark, sf_dir), _index_root(spark, "passages"))
    bench = inventory(spark, sf_dir).t.benchmark
    return index.search(rt.query_terms(bench, "item_id", "text"), k=5).select(
        F.col("query_id").alias("item_id"), "rank", "doc_id", "chunk_no", "source", r9(F.col("score")).alias("score"))


@register("keyword_search_indexed")
def keyword_search_indexed(spark, sf_dir):
    """R15 by the trigram index: the same rows as `keyword_search`."""
    inv = inventory(spark, sf_dir)
    index = TrigramIndex.build(rt.searchable(inv.findings, inv.assets), "hay", _index_root(spark, "trigrams"))
    return index.search(SEARCH_TERMS).select("term", "kind", "id", "asset_id")


@register("rule_hits")
def rule_hits(spark, sf_dir):
    return rt.rule_hits(spread(inventory(spark, sf_dir).t.documents.select("doc_id", "source", "text")))


@register("keyword_search")
def keyword_search(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return rt.keyword_search(inv.findings, inv.assets, SEARCH_TERMS)


@register("latest_risk_score")
def latest_risk_score(spark, sf_dir):
    """Newest score per asset from a history of two scoring runs in which every third asset was
    scored again earlier than its first run and every fifth not at all in the second."""
    inv = inventory(spark, sf_dir)
    k = F.col("asset_id")
    second = F.when(k % 3 == 0, F.lit("2001-11-03 00:00:00")).otherwise(F.lit("2001-11-05 00:00:00"))
    h1 = inv.rule_labelled.select("asset_id", "risk_score", F.lit("rule-v1").alias("model_name"),
                                  F.lit("2001-11-04 00:00:00").cast("timestamp").alias("scored_at"))
    h2 = inv.labelled.where(k % 5 != 0).select("asset_id", "risk_score", F.lit("rule-noisy-v2").alias("model_name"),
                                               second.cast("timestamp").alias("scored_at"))
    latest = rt.latest_per_key(h2.unionByName(h1), "asset_id", "scored_at", ["risk_score", "model_name"])
    return latest.select("asset_id", r9(F.col("risk_score")).alias("risk_score"), "model_name",
                         F.col("scored_at").cast("date").alias("scored_at"))


# --- step 11: reports, exports, keyed randomness ---------------------------------

from ..functions.exprs import hash_normal  # noqa: E402
from ..operators import documents as dcs  # noqa: E402
from ..operators import reports as rep  # noqa: E402


@register("posture_summary")
def posture_summary(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    exp = gr.expiring_vulnerable_certs(*inv.graph, as_of=AS_OF_DATE, days=90)
    s = rep.posture_summary(inv.rule_labelled, exp)
    return s.select(*[r9(F.col(c)).alias(c) if c.endswith("_share") else F.col(c) for c in s.columns])


@register("findings_table")
def findings_table(spark, sf_dir):
    return rep.findings_table(inventory(spark, sf_dir).findings, 50)


@register("asset_document")
def asset_document(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return rep.asset_document(inv.features, inv.rule_labelled, inv.certificates)


@register("asset_document_nested")
def asset_document_nested(spark, sf_dir):
    """Each asset's document with its findings nested, 50 to a page; shown with its findings spread again."""
    inv = inventory(spark, sf_dir)
    pages = dcs.asset_pages(rep.asset_document(inv.features, inv.rule_labelled, inv.certificates), inv.findings)
    return pages.select("asset_id", "priority", "page", "n_pages", F.size("findings").alias("n_on_page"), F.explode_outer("findings").alias("f")).select(
        "asset_id", "priority", "page", "n_pages", "n_on_page", "f.place", "f.finding_id", "f.algorithm", "f.key_size", "f.quantum_vulnerable")


@register("plan_document")
def plan_document(spark, sf_dir):
    """The weighted plan with its items nested, 50 to a page; shown with its items spread again."""
    pages = dcs.plan_pages(inventory(spark, sf_dir).weighted_plan)
    return pages.select("phase", "page", "n_items", F.size("items").alias("n_on_page"), F.inline("items")).withColumn("score", r9(F.col("score")))


@register("feature_export_roundtrip")
def feature_export_roundtrip(spark, sf_dir):
    """Versioned, partitioned export of the feature table, read back."""
    import time
    import uuid

    inv = inventory(spark, sf_dir)
    stamp = time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + "-" + uuid.uuid4().hex[:8]
    path = rep.export_versioned(inv.features.drop("qv_raw"), f"{checkpoint_dir(spark).rstrip('/')}/exports", stamp)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("schema_version").cast("string").alias("schema_version")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("key_size").alias("sum_key_size"))


@register("feature_snapshot_read")
def feature_snapshot_read(spark, sf_dir):
    """The newest of two exports, in two versions of which the older has no loc_estimate."""
    import uuid

    from latticeguard.sources.snapshots import read_snapshot

    features = inventory(spark, sf_dir).features.drop("qv_raw")
    root = f"{checkpoint_dir(spark).rstrip('/')}/exports/{uuid.uuid4().hex}"
    even = F.col("asset_id") % 2 == 0
    rep.export_versioned(features.where(even), root, "20260101T000000")
    rep.export_versioned(features.where(even).drop("loc_estimate").withColumn("schema_version", F.lit("9.1")), root, "20260201T000000")
    rep.export_versioned(features.where(~even).withColumn("schema_version", F.lit("9.10")), root, "20260201T000000")
    return read_snapshot(spark, root).groupBy("schema_version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("key_size").alias("sum_key_size"), F.sum("loc_estimate").alias("sum_loc"))


@register("feature_export_json")
def feature_export_json(spark, sf_dir):
    """Newline-JSON export of the feature table, read back under its schema."""
    import uuid

    f = inventory(spark, sf_dir).features.drop("qv_raw")
    path = rep.export_versioned(f, f"{checkpoint_dir(spark).rstrip('/')}/exports", f"json-{uuid.uuid4().hex[:12]}", fmt="json")
    back = spark.read.schema(f.schema).json(path)
    return back.groupBy("criticality").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("key_size").alias("sum_key_size"),
                                           F.sum("loc_estimate").alias("sum_loc"))


@register("split_csv_roundtrip")
def split_csv_roundtrip(spark, sf_dir):
    """S3: the split written as CSV with a header and read back by column name."""
    import uuid

    path = f"{checkpoint_dir(spark).rstrip('/')}/csv/{uuid.uuid4().hex}"
    rows = inventory(spark, sf_dir).split.select("asset_id", "split", "criticality", "asset_age_days")
    back = rep.read_csv(spark, rep.write_csv(rows, path), rows.schema)
    return back.groupBy("split", "criticality").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("asset_id").alias("sum_id"),
                                                    F.count("asset_age_days").alias("n_age"))


@register("asset_create_lookup")
def asset_create_lookup(spark, sf_dir):
    """New assets get ids after the highest, are upserted, and a few ids are looked up."""
    inv = inventory(spark, sf_dir)
    columns = ["asset_id", "hostname", "criticality"]
    new = inv.assets.where(F.col("asset_id") % 100 == 0).select(
        F.concat(F.lit("new-"), F.col("hostname")).alias("hostname"), F.lit("LOW").alias("criticality"))
    table = rep.create_assets(inv.assets.select(*columns), new)
    wanted = table.groupBy((F.col("hostname").startswith("new-")).alias("created")).agg(
        F.count(F.lit(1)).alias("n_assets"), F.min("asset_id").alias("first_id"), F.max("asset_id").alias("last_id"),
        F.countDistinct("asset_id").alias("n_ids"))
    one = rep.lookup_asset(table, 7).agg(F.max("hostname")).scalar()
    return wanted.withColumn("hostname_of_7", one)


@register("noise_moments")
def noise_moments(spark, sf_dir):
    """Moments of the keyed Gaussian noise over all assets (seed 42, std .05)."""
    a = inventory(spark, sf_dir).assets.select(hash_normal(F.col("asset_id"), 42, "", 0.05).alias("z"))
    return a.agg(F.count(F.lit(1)).alias("n"), r9(F.avg("z")).alias("mean"), r9(F.stddev_samp("z")).alias("std"))
