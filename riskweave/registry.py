"""Registered queries: name -> (spark, sf_dir) -> DataFrame over the fixture world.

Wall-clock audit columns (updated_at, scored_at, alerted_at) are left out so results
are reproducible; everything else is the library output unchanged.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import replace as _replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.config import Settings
from riskweave.operators import activity as act
from riskweave.operators import scoring
from riskweave.plans.weekly import build
from riskweave.session import scratch_path, stored
from riskweave.sources import fixtures as fx
from riskweave.sources import seeds
from riskweave.sources.staging import stage_all

Query = Callable[[SparkSession, str], DataFrame]

FIXTURE_SETTINGS = Settings(as_of=fx.AS_OF)


def _staged(spark, sf_dir):
    return stage_all(fx.raw_tables(spark, sf_dir))


def _built(spark, sf_dir, s: Settings = FIXTURE_SETTINGS):
    return build(fx.raw_tables(spark, sf_dir), s, stamp=False)


def q_stg(name: str) -> Query:
    return lambda spark, sf_dir: _staged(spark, sf_dir)[name]


def q_week_spine(spark, sf_dir):
    acc = _staged(spark, sf_dir)["accounts"]
    return act.week_spine(acc, FIXTURE_SETTINGS, carry=False)


def q_weekly_usage(spark, sf_dir):
    return act.weekly_usage(_staged(spark, sf_dir)["product_events"])


def q_weekly_usage_lookback(spark, sf_dir):
    ev = _staged(spark, sf_dir)["product_events"]
    return act.weekly_usage(act.lookback_window(ev, FIXTURE_SETTINGS))


def q_activity_weekly(spark, sf_dir):
    return _built(spark, sf_dir).activity


def q_rolling_wau(spark, sf_dir):
    return _built(spark, sf_dir).activity.select(
        "account_id", "week_start", "wau", "wau_rolling_4w", "wau_rolling_prev_4w"
    )


def q_wow_delta(spark, sf_dir):
    return _built(spark, sf_dir).activity.select("account_id", "week_start", "wau", "wau_wow_delta")


def q_usage_trend(spark, sf_dir):
    a = _built(spark, sf_dir).activity
    return a.where(F.col("week_start") == FIXTURE_SETTINGS.monday_col()).select(
        "account_id", "week_start", "wau_rolling_4w", "wau_rolling_prev_4w", "usage_trend_pct"
    )


def q_support_signals(spark, sf_dir):
    return _built(spark, sf_dir).support


def q_billing_signals(spark, sf_dir):
    return _built(spark, sf_dir).billing


def q_active_users_30d(spark, sf_dir):
    from riskweave.operators.signals import active_users_30d

    return active_users_30d(_staged(spark, sf_dir)["product_events"], FIXTURE_SETTINGS)


def q_features_current(spark, sf_dir):
    return _built(spark, sf_dir).features


def _sub(spark, sf_dir):
    return scoring.components(scoring.subscores(_built(spark, sf_dir).features))


def q_usage_components(spark, sf_dir):
    return _sub(spark, sf_dir).select("account_id", *scoring.USAGE_SUBSCORES)


def q_commercial_components(spark, sf_dir):
    return _sub(spark, sf_dir).select("account_id", *scoring.COMMERCIAL_SUBSCORES)


def q_support_components(spark, sf_dir):
    return _sub(spark, sf_dir).select("account_id", *scoring.SUPPORT_SUBSCORES)


def q_component_scores(spark, sf_dir):
    return _sub(spark, sf_dir).select("account_id", "usage_score", "commercial_score", "support_score")


def q_risk_scores(spark, sf_dir):
    return _built(spark, sf_dir).scores


def q_tier_counts(spark, sf_dir):
    from riskweave.operators.reports import tier_counts

    return tier_counts(_built(spark, sf_dir).scores)


CORE: dict[str, Query] = {
    "stg_accounts": q_stg("accounts"),
    "stg_product_events": q_stg("product_events"),
    "stg_billing_events": q_stg("billing_events"),
    "stg_support_tickets": q_stg("support_tickets"),
    "week_spine": q_week_spine,
    "weekly_usage": q_weekly_usage,
    "weekly_usage_lookback": q_weekly_usage_lookback,
    "activity_weekly": q_activity_weekly,
    "rolling_wau": q_rolling_wau,
    "wow_delta": q_wow_delta,
    "usage_trend": q_usage_trend,
    "support_signals": q_support_signals,
    "billing_signals": q_billing_signals,
    "active_users_30d": q_active_users_30d,
    "features_current": q_features_current,
    "usage_components": q_usage_components,
    "commercial_components": q_commercial_components,
    "support_components": q_support_components,
    "component_scores": q_component_scores,
    "risk_scores": q_risk_scores,
    "tier_counts": q_tier_counts,
}


# --- history, alerts, quality ----------------------------------------------------

import datetime as _dt  # noqa: E402

from riskweave.operators import alerts as al  # noqa: E402
from riskweave.operators import history as hi  # noqa: E402
from riskweave.operators import quality as dq  # noqa: E402
from riskweave.plans import backfill as bf  # noqa: E402

# FIXED fixture parameters of the score history: weekly runs and one account that
# is deactivated at the third run and comes back at the last one
HISTORY_DAYS = [fx.AS_OF - _dt.timedelta(days=d) for d in (21, 14, 7, 0)]
FLIP_ACCOUNT = "12"


def _accounts_for(spark, sf_dir):
    """Account state per history run: the flip account is inactive on the third run."""
    from riskweave.sources.staging import stg_accounts

    accounts = stg_accounts(fx.accounts(spark, sf_dir))
    flipped = accounts.where(F.col("account_id") == FLIP_ACCOUNT)
    changed = flipped.select(F.lit(HISTORY_DAYS[2]).alias(bf.RUN), "account_id", F.lit(False).alias("is_active"))
    return bf.accounts_by_run(accounts, changed, HISTORY_DAYS)


def _history(spark, sf_dir):
    return bf.history_batch(
        fx.raw_tables(spark, sf_dir), FIXTURE_SETTINGS, HISTORY_DAYS, _accounts_for(spark, sf_dir)
    )


def q_scd2_history(spark, sf_dir):
    return _history(spark, sf_dir).drop("dbt_updated_at")


def q_scd2_apply(spark, sf_dir):
    from riskweave.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return bf.history_fold(
        fx.raw_tables(spark, sf_dir), FIXTURE_SETTINGS, HISTORY_DAYS, _accounts_for(spark, sf_dir),
        cut=lambda d: d.checkpoint(),
    ).drop("dbt_updated_at")


def q_alert_history(spark, sf_dir):
    return hi.alert_history(_history(spark, sf_dir), FIXTURE_SETTINGS.as_of_col())


def q_tier_transitions(spark, sf_dir):
    return hi.tier_transitions(_history(spark, sf_dir))


def q_high_streak(spark, sf_dir):
    return hi.high_streak(_history(spark, sf_dir), FIXTURE_SETTINGS.as_of_col())


def _runs(spark, sf_dir):
    """Scores of every history run, materialised once (the stored scores table that both
    the snapshot and the alerts of the week read; a reliable checkpoint in the shared
    folder)."""
    from riskweave.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return bf.scores_by_run(
        fx.raw_tables(spark, sf_dir), FIXTURE_SETTINGS, HISTORY_DAYS, _accounts_for(spark, sf_dir)
    ).checkpoint()


def _alerts(spark, sf_dir, stamp=False):
    """Current scores are the live run of the same multi-run plan the history comes from
    (the weekly order: score, snapshot, then alerts), so they are computed once."""
    runs = _runs(spark, sf_dir)
    scores = bf.live_scores(runs, HISTORY_DAYS)
    hist = bf.history_from_scores(runs, HISTORY_DAYS)
    return al.churn_alerts(scores, hist, FIXTURE_SETTINGS, stamp=stamp)


def q_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir)


def q_alert_priority_counts(spark, sf_dir):
    return _alerts(spark, sf_dir).groupBy("alert_priority").agg(
        F.count(F.lit(1)).alias("n_alerts"), F.sum("mrr").alias("mrr_at_risk")
    )


def q_top_risk_driver(spark, sf_dir):
    return _alerts(spark, sf_dir).groupBy("top_risk_driver").agg(
        F.count(F.lit(1)).alias("n_alerts")
    )


def dq_tables(spark, sf_dir, need: set[str] | None = None) -> dict[str, DataFrame]:
    """Models of the fixture world under their names (audit columns stamped), as a build leaves
    them: staging as views, every other model stored once as Parquet and read by its consumers.
    Only the tables in `need` and what they depend on are built."""
    from riskweave.operators import compare as cmp_
    from riskweave.operators import features as feat_
    from riskweave.operators import signals as sig

    s = FIXTURE_SETTINGS
    st = stage_all(fx.raw_tables(spark, sf_dir))
    accounts, events = st["accounts"], st["product_events"]
    made = {f"stg_{k}": v for k, v in st.items()}
    plans = {
        "int_account_activity_weekly": lambda: act.activity_weekly(accounts, events, s),
        "int_account_support_signals": lambda: sig.support_signals(accounts, st["support_tickets"], s),
        "int_account_billing_signals": lambda: sig.billing_signals(accounts, st["billing_events"], events, s),
        "int_churn_features": lambda: feat_.churn_features(
            get("int_account_activity_weekly"), get("int_account_support_signals"), get("int_account_billing_signals"), s
        ),
        "mart_churn_risk_scores": lambda: scoring.risk_scores(get("int_churn_features"), s),
        "snp_churn_risk_scores": lambda: bf.history_batch(st, s, HISTORY_DAYS, _accounts_for(spark, sf_dir)),
        "mart_churn_alerts": lambda: al.churn_alerts(get("mart_churn_risk_scores"), get("snp_churn_risk_scores"), s),
        "mart_churn_risk_scores_ml": lambda: cmp_.rule_vs_ml(
            get("mart_churn_risk_scores"), cmp_.propensity_predictions(get("int_churn_features"), s)
        ),
    }

    def get(name: str) -> DataFrame:
        if name not in made:
            made[name] = stored(plans[name](), name)
        return made[name]

    need = {*plans, *made} if need is None else need
    return {name: get(name) for name in sorted(need)}


def _dq(tests: tuple[str, ...]):
    return lambda spark, sf_dir: dq.run_suite(dq_tables(spark, sf_dir, dq.needed_tables(tests)), tests=tests)


HISTORY: dict[str, Query] = {
    "scd2_history": q_scd2_history,
    "scd2_apply": q_scd2_apply,
    "alert_history": q_alert_history,
    "tier_transitions": q_tier_transitions,
    "high_streak": q_high_streak,
    "alerts": q_alerts,
    "alert_priority_counts": q_alert_priority_counts,
    "top_risk_driver": q_top_risk_driver,
    "dq_not_null": _dq(("not_null",)),
    "dq_unique": _dq(("unique",)),
    "dq_accepted_values": _dq(("accepted_values",)),
    "dq_relationships": _dq(("relationships",)),
    "dq_unique_combination": _dq(("unique_combination",)),
    "dq_suite": _dq(()),
}


# --- rule vs ML, model training ----------------------------------------------------------

from riskweave.operators import compare as cmp  # noqa: E402
from riskweave.operators import features as feat  # noqa: E402
from riskweave.operators import metrics as me  # noqa: E402
from riskweave.operators import ml  # noqa: E402
from riskweave.operators import ranking as rk  # noqa: E402


def _preds(spark, sf_dir):
    """The build over stored features, which scores and predictions both read, and predictions."""
    b = _built(spark, sf_dir)
    features = stored(b.features, "int_churn_features")
    b = _replace(b, features=features, scores=scoring.risk_scores(features, FIXTURE_SETTINGS, stamp=False))
    return b, cmp.propensity_predictions(features, FIXTURE_SETTINGS, stamp=False)


def q_prepared_features(spark, sf_dir):
    return cmp.prepare_features(_built(spark, sf_dir).features)


def q_propensity(spark, sf_dir):
    p = cmp.with_propensity(cmp.prepare_features(_built(spark, sf_dir).features))
    return p.select("account_id", "feature_week", "propensity", "weak_label")


def q_ml_tier_cut(spark, sf_dir):
    _, p = _preds(spark, sf_dir)
    return p.select("account_id", "risk_score_ml", "risk_tier_ml", "churn_probability")


def q_rule_vs_ml(spark, sf_dir):
    b, p = _preds(spark, sf_dir)
    return cmp.rule_vs_ml(b.scores, p)


def q_compare_frame(spark, sf_dir):
    b, p = _preds(spark, sf_dir)
    return cmp.compare_frame(b.scores, p)


def q_compare_summary(spark, sf_dir):
    return cmp.compare_summary(q_compare_frame(spark, sf_dir))


def q_tier_disagreements(spark, sf_dir):
    return cmp.tier_disagreements(q_compare_frame(spark, sf_dir))


def weekly_snapshots(spark, sf_dir) -> DataFrame:
    """Feature rows for every spine week (usage per week, signals as of the run)."""
    b = _built(spark, sf_dir)
    return feat.churn_features(b.activity, b.support, b.billing, FIXTURE_SETTINGS, week_col="week_start")


def q_cancel_label(spark, sf_dir):
    snaps = weekly_snapshots(spark, sf_dir).select("account_id", "feature_week")
    billing = _staged(spark, sf_dir)["billing_events"]
    return ml.cancel_labels(snaps, billing)


# FIXED fixture parameter: twelve weekly scoring runs ending at the fixture as_of
TRAINING_DAYS = [fx.AS_OF - _dt.timedelta(days=7 * k) for k in range(12)]


def training_snapshots(spark, sf_dir) -> DataFrame:
    """Point-in-time training rows: the feature row of every account on each of twelve
    weekly runs, each run seeing only what existed on its day (one multi-run plan),
    prepared for modelling, with the propensity and its weak label."""
    sr = bf.run_settings(FIXTURE_SETTINGS, TRAINING_DAYS)
    feats = build(fx.raw_tables(spark, sf_dir), sr, stamp=False).features
    prepared = cmp.prepare_features(feats, keep=(bf.RUN, "account_id", "feature_week"))
    return cmp.with_propensity(prepared)


def q_training_snapshots(spark, sf_dir):
    return training_snapshots(spark, sf_dir)


def training_frame(spark, sf_dir) -> DataFrame:
    """The snapshots, labelled by a cancellation within 90 days (the propensity and its weak label
    are functions of the features, so a model has nothing to learn from them)."""
    billing = _staged(spark, sf_dir)["billing_events"]
    return ml.cancel_labels(training_snapshots(spark, sf_dir).drop("weak_label"), billing)


def training_rows(spark, sf_dir) -> DataFrame:
    """The training frame stored, for models: their class weights, folds, fits and reports read it
    many times and do not build the snapshots again."""
    return stored(training_frame(spark, sf_dir), "training-rows")


def q_label_balance(spark, sf_dir):
    return ml.label_balance(q_cancel_label(spark, sf_dir))


def trained(spark, training: DataFrame) -> "ml.TrainResult":
    """Fits, stores the model and its figures, and loads it again for scoring."""
    res = ml.train(training)
    path = scratch_path(spark, "ml_model")
    tb.save_model(res.model, path, {"model_name": res.model_name, "cv_auc": res.cv_auc, "n_training": res.n_training})
    return _replace(res, model=tb.load_model(spark, path)[0])


def q_ml_train_score(spark, sf_dir):
    res = trained(spark, training_rows(spark, sf_dir))
    return ml.score(res, _built(spark, sf_dir).features, FIXTURE_SETTINGS, stamp=False)


def q_ml_importance(spark, sf_dir):
    return ml.importance(trained(spark, training_rows(spark, sf_dir)), spark)


def q_class_weights(spark, sf_dir):
    return ml.class_weights(training_frame(spark, sf_dir))


def q_fold_sizes(spark, sf_dir):
    return ml.fold_sizes(training_frame(spark, sf_dir))


def q_rule_classification_report(spark, sf_dir):
    """How well the rule's HIGH tier tells the cancellations of the next 90 days."""
    scores = _built(spark, sf_dir).scores.withColumnRenamed("scored_week", "feature_week")
    labelled = ml.cancel_labels(scores, _staged(spark, sf_dir)["billing_events"])
    return ml.classification_report(labelled.withColumn("prediction", (F.col("risk_tier") == "HIGH").cast("double")))


@contextmanager
def _own_database(spark, layer: str):
    """A database of this run alone, dropped by its own name; its tables are external, so frames
    that were read from them stay valid."""
    name = f"{layer}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def q_predictions_table(spark, sf_dir):
    """Predictions written to the prediction table, replaced once, counted, read back, and set
    beside the rules."""
    b, p = _preds(spark, sf_dir)
    with _own_database(spark, tb.LAYER_SCHEMAS["ml"]) as database:
        name, path = f"{database}.ml_predictions", scratch_path(spark, "ml_predictions")
        tb.replace_predictions(p.where("false"), name, path=path)
        n = tb.replace_predictions(p, name, path=path)
        both = cmp.rule_vs_ml(b.scores, seeds.read_predictions(spark, name))
    return both.withColumn("n_predictions", F.lit(n).cast("long"))


def q_ml_mart_ranked(spark, sf_dir):
    return rk.ranked_within(q_rule_vs_ml(spark, sf_dir), "risk_tier_ml", F.desc("risk_score_ml"), "account_id").select(
        "risk_tier_ml", "rank", "account_id", "risk_score_ml"
    )


def q_risk_scores_ranked(spark, sf_dir):
    return rk.ranked_within(_built(spark, sf_dir).scores, "risk_tier", F.desc("risk_score"), "account_id").select(
        "risk_tier", "rank", "account_id", "risk_score"
    )


def q_alerts_ranked(spark, sf_dir):
    return rk.ranked_within(_alerts(spark, sf_dir), "alert_priority", F.desc("risk_score"), "account_id").select(
        "alert_priority", "rank", "account_id", "risk_score"
    )


def _scores_in_order(spark, sf_dir):
    return scoring.in_order(_built(spark, sf_dir).scores.select("account_id", "risk_tier", "risk_score"))


def q_scores_global_rank(spark, sf_dir):
    return _scores_in_order(spark, sf_dir).ranked().select("rank", "account_id", "risk_tier", "risk_score")


def q_alerts_global_rank(spark, sf_dir):
    alerts = _alerts(spark, sf_dir).select("account_id", "alert_priority", "risk_score")
    return al.in_order(alerts).ranked().select("rank", "account_id", "alert_priority", "risk_score")


def q_ml_mart_global_rank(spark, sf_dir):
    mart = q_rule_vs_ml(spark, sf_dir).select("account_id", "risk_tier_ml", "risk_score_ml")
    return cmp.in_order(mart).ranked().select("rank", "account_id", "risk_tier_ml", "risk_score_ml")


def q_scores_quantiles(spark, sf_dir):
    """The account at every tenth of the order, highest risk first."""
    at = _scores_in_order(spark, sf_dir).quantiles([0, *range(100, 1001, 100)])
    return at.select("per_mille", "rank", "account_id", "risk_score")


def q_scores_page(spark, sf_dir):
    """The second page of ten."""
    return _scores_in_order(spark, sf_dir).page(2, 10).select("rank", "account_id", "risk_score")


def _rule_labelled(spark, sf_dir, scores):
    """Rows with account_id and scored_week, labelled by a cancellation in the next 90 days."""
    rows = scores.withColumnRenamed("scored_week", "feature_week")
    return ml.cancel_labels(rows, _staged(spark, sf_dir)["billing_events"])


def q_rule_auc(spark, sf_dir):
    return me.auc(_rule_labelled(spark, sf_dir, _built(spark, sf_dir).scores), "risk_score", ml.LABEL)


def q_rule_pr_curve(spark, sf_dir):
    return me.threshold_curve(_rule_labelled(spark, sf_dir, _built(spark, sf_dir).scores), "risk_score", ml.LABEL)


def q_rule_permutation_importance(spark, sf_dir):
    labelled = ml.cancel_labels(_built(spark, sf_dir).features, _staged(spark, sf_dir)["billing_events"])
    inputs = labelled.select("account_id", *scoring.RULE_INPUTS, ml.LABEL)

    def rescore(rows):
        rows = rows.withColumn("is_zero_usage_week", F.col("wau") == 0)
        return scoring.components(scoring.subscores(rows)).withColumn("score", scoring.risk_score_col(FIXTURE_SETTINGS))

    return me.importance(inputs, "account_id", scoring.RULE_INPUTS, None, ml.LABEL, rescore=rescore)


def q_lr_optimality(spark, sf_dir):
    """The gradient of the logistic loss at the fitted coefficients, to four decimals."""
    model, weighted = ml.fit_logistic(training_rows(spark, sf_dir))
    rounded = F.round("gradient", 4)
    return ml.lr_gradient(model, weighted).select("term", "n_rows", F.when(rounded == 0, 0.0).otherwise(rounded).alias("gradient"))


def q_training_auc(spark, sf_dir):
    """In-sample AUC of the logistic fit by ranks: its rows, and whether the trapezes under the
    curve give the same."""
    model, weighted = ml.fit_logistic(training_rows(spark, sf_dir))
    scored = stored(ml.probability(model, weighted).select(F.col("__prob").alias("score"), ml.LABEL), "scored-training")
    curve = float(ml.area_under_roc(scored, "score"))
    same = (F.abs(F.col("auc") - curve) < 1e-9) & (F.col("auc") > 0.5)
    return me.auc(scored, "score", ml.LABEL).select("n_positive", "n_negative", same.alias("agrees"))


def q_model_round_trip(spark, sf_dir):
    """Rows whose probability changes when the fitted model is stored and loaded."""
    model, weighted = ml.fit_logistic(training_rows(spark, sf_dir))
    path = scratch_path(spark, "ml_model")
    tb.save_model(model, path, {"model_name": "Logistic Regression", "n_training": 0})
    key = ["run_as_of", "account_id"]
    before = ml.probability(model, weighted).select(*key, F.col("__prob").alias("before"))
    after = ml.probability(tb.load_model(spark, path)[0], weighted).select(*key, F.col("__prob").alias("after"))
    return before.join(after, key).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") != F.col("after")).alias("n_different"))


# FIXED fixture parameter: a year of weekly runs ending at the fixture as_of
YEAR_DAYS = [fx.AS_OF - _dt.timedelta(days=7 * k) for k in range(52)]


def q_active_users_by_run(spark, sf_dir):
    """Distinct users of the trailing 30 days for 52 weekly runs."""
    sr = bf.run_settings(FIXTURE_SETTINGS, YEAR_DAYS)
    from riskweave.operators.signals import active_users_30d

    return active_users_30d(_staged(spark, sf_dir)["product_events"], sr)


def q_classification_report(spark, sf_dir):
    training = training_rows(spark, sf_dir)
    return ml.classification_report(trained(spark, training).model.transform(training))


MODELS: dict[str, Query] = {
    "prepared_features": q_prepared_features,
    "propensity": q_propensity,
    "ml_tier_cut": q_ml_tier_cut,
    "rule_vs_ml": q_rule_vs_ml,
    "compare_frame": q_compare_frame,
    "compare_summary": q_compare_summary,
    "tier_disagreements": q_tier_disagreements,
    "cancel_label": q_cancel_label,
    "label_balance": q_label_balance,
    "training_snapshots": q_training_snapshots,
    "class_weights": q_class_weights,
    "fold_sizes": q_fold_sizes,
    "rule_classification_report": q_rule_classification_report,
    "predictions_table": q_predictions_table,
    "ml_mart_ranked": q_ml_mart_ranked,
    "risk_scores_ranked": q_risk_scores_ranked,
    "alerts_ranked": q_alerts_ranked,
    "scores_global_rank": q_scores_global_rank,
    "alerts_global_rank": q_alerts_global_rank,
    "ml_mart_global_rank": q_ml_mart_global_rank,
    "scores_quantiles": q_scores_quantiles,
    "scores_page": q_scores_page,
    "active_users_by_run": q_active_users_by_run,
    "rule_auc": q_rule_auc,
    "rule_pr_curve": q_rule_pr_curve,
    "rule_permutation_importance": q_rule_permutation_importance,
    "lr_optimality": q_lr_optimality,
    "training_auc": q_training_auc,
    "model_round_trip": q_model_round_trip,
    "ml_train_score": q_ml_train_score,
    "ml_importance": q_ml_importance,
    "classification_report": q_classification_report,
}


# --- reporting frames -----------------------------------------------------------------

from riskweave.operators import reports as rp  # noqa: E402


def _scores_alerts(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    scores = bf.live_scores(runs, HISTORY_DAYS)
    hist = bf.history_from_scores(runs, HISTORY_DAYS)
    return scores, al.churn_alerts(scores, hist, FIXTURE_SETTINGS, stamp=False)


def q_kpis(spark, sf_dir):
    return rp.kpis(*_scores_alerts(spark, sf_dir))


def q_priority_queue(spark, sf_dir):
    return rp.priority_queue(*_scores_alerts(spark, sf_dir))


def q_bubble_points(spark, sf_dir):
    return rp.bubble_points(_built(spark, sf_dir).scores)


def q_component_share(spark, sf_dir):
    return rp.component_share(_built(spark, sf_dir).scores)


def q_display_buckets(spark, sf_dir):
    return rp.display_buckets(_built(spark, sf_dir).scores)


def q_digest_lines(spark, sf_dir):
    return rp.digest_lines(_alerts(spark, sf_dir))


def q_digest_groups(spark, sf_dir):
    return rp.digest_groups(_alerts(spark, sf_dir))


def q_digest_summary(spark, sf_dir):
    return rp.digest_summary(_alerts(spark, sf_dir), FIXTURE_SETTINGS)


REPORTS: dict[str, Query] = {
    "kpis": q_kpis,
    "priority_queue": q_priority_queue,
    "bubble_points": q_bubble_points,
    "component_share": q_component_share,
    "display_buckets": q_display_buckets,
    "digest_lines": q_digest_lines,
    "digest_groups": q_digest_groups,
    "digest_summary": q_digest_summary,
}


# --- sinks and streaming ------------------------------------------------------------------

from riskweave.sinks import tables as tb  # noqa: E402
from riskweave.functions.exprs import week_start  # noqa: E402
from riskweave.operators import sketches as sk  # noqa: E402
from riskweave.streaming import activity_stream as stream  # noqa: E402

ACTIVITY_KEYS = ["account_id", "week_start"]
PREVIOUS_RUN = fx.AS_OF - _dt.timedelta(days=7)


def _spine_mondays(as_of: _dt.date, weeks: int = 12) -> list[_dt.date]:
    monday = as_of - _dt.timedelta(days=as_of.weekday())
    return [monday - _dt.timedelta(days=7 * n) for n in range(weeks)]


def _previous_activity(spark, sf_dir):
    s = _replace(FIXTURE_SETTINGS, as_of=PREVIOUS_RUN, bound_future=True)
    return build(fx.raw_tables(spark, sf_dir), s, stamp=False).activity


def q_upsert_activity(spark, sf_dir):
    """Two weekly incremental runs into one table; the second deactivates an account, whose
    rows in the overwritten weeks stay (stale rows are never deleted)."""
    path = scratch_path(spark, "int_account_activity_weekly")
    tb.upsert(_previous_activity(spark, sf_dir), path, ACTIVITY_KEYS, "week_start")
    st = stage_all(fx.raw_tables(spark, sf_dir, inactive_ids=(FLIP_ACCOUNT,)))
    batch = act.activity_weekly(
        st["accounts"], st["product_events"], FIXTURE_SETTINGS, incremental=True, stamp=False
    )
    return tb.upsert(batch, path, ACTIVITY_KEYS, "week_start", touched=_spine_mondays(fx.AS_OF))


def q_schema_sync(spark, sf_dir):
    """The earlier run's table lacks usage_trend_pct and carries a since-removed column;
    after the upsert the table has exactly the new run's columns."""
    path = scratch_path(spark, "int_account_activity_weekly")
    old = _previous_activity(spark, sf_dir).drop("usage_trend_pct").withColumn(
        "legacy_flag", F.lit(True)
    )
    tb.upsert(old, path, ACTIVITY_KEYS, "week_start")
    new = _built(spark, sf_dir).activity
    return tb.upsert(new, path, ACTIVITY_KEYS, "week_start")


def q_schema_widening(spark, sf_dir):
    """The earlier run's counts are int, the later run's long: the table widens, its rows stay."""
    path = scratch_path(spark, "int_account_activity_weekly")
    counts = ["wau", "session_count", "event_count", "distinct_features_used", "days_to_renewal"]
    old = _previous_activity(spark, sf_dir)
    tb.upsert(old.withColumns({c: F.col(c).cast("int") for c in counts}), path, ACTIVITY_KEYS, "week_start")
    return tb.upsert(_built(spark, sf_dir).activity, path, ACTIVITY_KEYS, "week_start")


def _snapshots(spark, sf_dir, days, path):
    scores = _runs(spark, sf_dir)
    for day in days:
        run = scores.where(F.col(bf.RUN) == F.lit(day)).select(*hi.SNAPSHOT_COLUMNS)
        out = tb.apply_snapshot(spark, path, run, bf.snapshot_ts(day))
    return out.drop("dbt_updated_at")


def q_snapshot_table(spark, sf_dir):
    """The stored history after the four weekly runs."""
    return _snapshots(spark, sf_dir, HISTORY_DAYS, scratch_path(spark, "snp"))


def q_snapshot_rerun(spark, sf_dir):
    """The same with the third run done twice: the repetition replaces it."""
    return _snapshots(spark, sf_dir, [*HISTORY_DAYS[:3], *HISTORY_DAYS[2:]], scratch_path(spark, "snp"))


def q_seed_accounts(spark, sf_dir):
    """Accounts written as a seed CSV and read with the declared schema."""
    path = scratch_path(spark, "seed_accounts")
    fmt = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    fx.accounts(spark, sf_dir).write.options(**fmt).csv(path)
    return seeds.read_seed_csv(spark, path, "accounts")


def q_catalog_layers(spark, sf_dir):
    """Raw tables written to the seed layer's schema, read as named sources, the support signals
    rebuilt as a table of their layer and the staged accounts as a view; rows of each. The layers
    stand in databases of this run."""
    with _own_database(spark, tb.LAYER_SCHEMAS["seeds"]) as raw_layer, _own_database(spark, tb.LAYER_SCHEMAS["intermediate"]) as layer:
        for name, df in fx.raw_tables(spark, sf_dir).items():
            tb.write_table(df, tb.qualify(name, raw_layer), path=scratch_path(spark, name))
        raw = seeds.RawSources(raw_layer).load(spark)
        b = build(raw, FIXTURE_SETTINGS, stamp=False)
        view = f"stg_accounts_{uuid.uuid4().hex[:12]}"
        tb.as_view(b.staged["accounts"], view)
        for name, df in (("int_account_support_signals", b.support), ("int_churn_features", b.features)):
            tb.write_table(df, tb.qualify(name, layer), path=scratch_path(spark, name))
        feats = seeds.load_current_features(
            spark, ["account_id", "feature_week", "open_tickets_count"], (f"{layer}_absent.int_churn_features", f"{layer}.int_churn_features")
        )
        out = feats.join(spark.table(view).select("account_id", "plan_name"), "account_id")
        spark.catalog.dropTempView(view)
    return out


def q_json_records(spark, sf_dir):
    tiers = _built(spark, sf_dir).scores.select("account_id", "plan_name", "risk_tier")
    return rp.as_json_records(tiers)


def q_activity_stream(spark, sf_dir):
    """Weekly usage maintained by the stream over the fixture events, one batch per file."""
    events = _staged(spark, sf_dir)["product_events"]
    src = scratch_path(spark, "events_in")
    events.repartition("event_id").write.parquet(src)
    return stream.run_available(
        spark, src, scratch_path(spark, "event_store"), scratch_path(spark, "weekly_usage"),
        scratch_path(spark, "stream_ckpt"), max_files_per_trigger=1,
    )


# FIXED fixture parameter: the days at which the next quarter of the events arrives
ARRIVALS = [fx.AS_OF - _dt.timedelta(days=d) for d in (270, 180, 90)]


def q_activity_stream_windowed(spark, sf_dir):
    """Weekly event counts from event-time windows with a watermark, the events arriving in four
    parts in the order of time."""
    events = _staged(spark, sf_dir)["product_events"]
    src, target, checkpoint = (scratch_path(spark, n) for n in ("events_in", "weekly_usage", "stream_ckpt"))
    bounds = [None, *(F.lit(d).cast("timestamp_ntz") for d in ARRIVALS), None]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        part = events if lo is None else events.where(F.col("event_ts") >= lo)
        (part if hi is None else part.where(F.col("event_ts") < hi)).write.mode("append").parquet(src)
        out = stream.run_windowed(spark, src, target, checkpoint)
    return out.usage.select("account_id", "week_start", "event_count", "last_event_ts")


def q_weekly_usage_sketch(spark, sf_dir):
    """Months of plans from stored weekly sketches: exact event counts, and whether the estimated
    users and sessions are within the sketches' error of the exact numbers."""
    st = _staged(spark, sf_dir)
    weekly = stored(sk.weekly_sketches(st["product_events"]), "weekly-sketches")
    plans = st["accounts"].select("account_id", "plan_name")
    month = F.trunc("week_start", "month").alias("month")
    found = sk.estimated(sk.merged(weekly.join(plans, "account_id"), "plan_name", month))
    weeks = act.weekly_usage(st["product_events"]).select("account_id", "week_start").join(plans, "account_id")
    distinct = st["product_events"].select("account_id", "user_id", "session_id", week_start("event_ts").alias("week_start")).join(plans, "account_id")
    exact = distinct.groupBy("plan_name", month).agg(
        F.count_distinct("account_id", "user_id").alias("exact_users"), F.count_distinct("account_id", "session_id").alias("exact_sessions")
    )
    near = lambda c: F.abs(F.col(c) - F.col(f"exact_{c}")) <= F.col(f"exact_{c}") * sk.relative_error() + 1
    n_weeks = weeks.groupBy("plan_name", month).agg(F.count(F.lit(1)).alias("n_account_weeks"))
    return (
        found.join(exact, ["plan_name", "month"]).join(n_weeks, ["plan_name", "month"])
        .select("plan_name", "month", "n_account_weeks", "event_count", "last_event_ts", near("users").alias("users_near"), near("sessions").alias("sessions_near"))
    )


SINKS: dict[str, Query] = {
    "upsert_activity": q_upsert_activity,
    "schema_sync": q_schema_sync,
    "schema_widening": q_schema_widening,
    "snapshot_table": q_snapshot_table,
    "snapshot_rerun": q_snapshot_rerun,
    "seed_accounts": q_seed_accounts,
    "catalog_layers": q_catalog_layers,
    "json_records": q_json_records,
    "activity_stream": q_activity_stream,
    "activity_stream_windowed": q_activity_stream_windowed,
    "weekly_usage_sketch": q_weekly_usage_sketch,
}


def queries() -> dict[str, Query]:
    return {**CORE, **HISTORY, **MODELS, **REPORTS, **SINKS}

