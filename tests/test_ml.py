"""ML: labels, training and scoring shape on the small fixture (logistic model only, to
keep the suite fast; the tree model runs through the same code in the registry)."""

import pytest
from pyspark.sql import functions as F

from riskweave import registry
from riskweave.operators import ml
from riskweave.operators.alerts import ordered
from riskweave.operators.compare import FEATURE_COLS, ordered_ml

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark):
    tr = registry.training_frame(spark, SF)
    return tr, ml.train(tr, models=("Logistic Regression",))


def test_training_metadata(trained):
    tr, res = trained
    assert res.model_name == "Logistic Regression"
    assert 0.0 <= res.cv_auc <= 1.0 and res.cv_std >= 0.0
    assert res.n_training == tr.count() and 0.0 < res.churn_rate < 1.0


def test_scores_are_probabilities_with_tiers(spark, trained):
    _, res = trained
    feats = registry._built(spark, SF).features
    out = ml.score(res, feats, registry.FIXTURE_SETTINGS, stamp=False)
    assert out.count() == feats.count()
    bad = out.where(
        (F.col("churn_probability") < 0) | (F.col("churn_probability") > 1)
        | F.col("risk_tier_ml").isNull()
        | (F.abs(F.col("risk_score_ml") - F.col("churn_probability") * 100) > 0.01)
    )
    assert bad.count() == 0


def test_importance_and_report(spark, trained):
    tr, res = trained
    imp = ml.importance(res, spark).collect()
    assert len(imp) == 10 and {r.feature for r in imp} <= set(FEATURE_COLS)
    assert abs(imp[0].value) >= abs(imp[-1].value)
    rep = {r.label: r for r in ml.classification_report(res.model.transform(tr)).collect()}
    assert set(rep) == {"Retained", "Churned", "accuracy", "macro avg", "weighted avg"}
    assert rep["accuracy"].support == tr.count()
    assert 0.0 <= rep["accuracy"].f1 <= 1.0


def test_cancel_labels_match_range_predicate(spark):
    snaps = registry.weekly_snapshots(spark, SF).select("account_id", "feature_week")
    billing = registry._staged(spark, SF)["billing_events"]
    got = ml.cancel_labels(snaps, billing)
    c = billing.where(F.col("event_type") == "cancellation").select(
        "account_id", F.col("event_ts").cast("date").alias("d"))
    brute = snaps.join(c, "account_id").where(
        (F.col("d") >= F.col("feature_week")) & (F.col("d") <= F.date_add("feature_week", 90))
    ).select("account_id", "feature_week").distinct()
    assert got.where("label = 1").select("account_id", "feature_week").exceptAll(brute).count() == 0
    assert brute.exceptAll(got.where("label = 1").select("account_id", "feature_week")).count() == 0
    assert got.count() == snaps.count()


def test_folds_are_stratified_and_hold_whole_accounts(spark):
    rows = [(str(a), w, int(a % 5 == 0 and w == 0)) for a in range(200) for w in range(3)]
    folds = ml.with_folds(spark.createDataFrame(rows, "account_id string, week int, label int"))
    assert folds.groupBy("account_id").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    sizes = ml.fold_sizes(spark.createDataFrame(rows, "account_id string, week int, label int")).collect()
    assert {(r.n_rows, r.n_positive, r.n_accounts) for r in sizes} == {(120, 8, 40)}


def test_in_sample_auc_and_read_time_orders(spark, trained):
    tr, res = trained
    assert 0.5 <= ml.training_auc(res, tr) <= 1.0
    rows = [("b", 1, 50.0), ("a", 1, 50.0), ("c", 2, 99.0), ("d", 1, 60.0)]
    df = spark.createDataFrame(rows, "account_id string, alert_priority int, risk_score double")
    assert [r.account_id for r in ordered(df).collect()] == ["d", "a", "b", "c"]
    mart = df.withColumnRenamed("risk_score", "risk_score_ml")
    assert [r.account_id for r in ordered_ml(mart).collect()] == ["c", "d", "a", "b"]


def test_training_snapshots_keep_the_weak_label_and_training_leaves_it_out(spark):
    snaps = registry.training_snapshots(spark, SF)
    assert snaps.where((F.col("weak_label") == 1) != (F.col("propensity") > 0.45)).count() == 0
    assert "weak_label" not in registry.training_frame(spark, SF).columns


def test_training_rows_are_built_once(spark):
    """Every reader of a model's rows reads the stored ones, not the tables under them."""
    files = registry.training_rows(spark, SF).inputFiles()
    assert files and all("training-rows" in f for f in files)
