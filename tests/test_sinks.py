"""Snapshot table, model persistence, namespace routing, JSON records."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskweave import registry
from riskweave.operators import ml
from riskweave.operators.reports import as_json_records
from riskweave.session import scratch_path, shared_dir
from riskweave.sinks import tables as tb
from riskweave.sources.seeds import read_predictions

S = "account_id string, risk_tier string, risk_score double"


def test_apply_snapshot_twice(spark):
    path = scratch_path(spark, "t_snp")
    d1, d2 = dt.datetime(2001, 10, 31), dt.datetime(2001, 11, 7)
    tb.apply_snapshot(spark, path, spark.createDataFrame([("a", "LOW", 1.0), ("b", "HIGH", 80.0)], S), d1)
    out = tb.apply_snapshot(spark, path, spark.createDataFrame([("a", "HIGH", 75.0)], S), d2)
    rows = {(r.account_id, r.dbt_valid_from, r.dbt_valid_to) for r in out.collect()}
    assert rows == {("a", d1, d2), ("a", d2, None), ("b", d1, d2)}


def test_model_round_trip(spark):
    sf = "/root/testdata/sf0.001"
    tr = registry.training_frame(spark, sf)
    res = ml.train(tr, models=("Logistic Regression",))
    path = scratch_path(spark, "t_model")
    tb.save_model(res.model, path, {"model_name": res.model_name, "cv_auc": res.cv_auc,
                                    "features": ml.FEATURE_COLS, "n_training": res.n_training})
    model, meta = tb.load_model(spark, path)
    assert meta["model_name"] == res.model_name and meta["features"] == ml.FEATURE_COLS
    a = res.model.transform(tr).select("account_id", "feature_week", "probability")
    b = model.transform(tr).select("account_id", "feature_week", F.col("probability").alias("p2"))
    j = a.join(b, ["account_id", "feature_week"])
    assert j.count() == tr.count()


def test_namespaces_and_json(spark):
    assert tb.qualify("mart_churn_alerts", " marts ") == "marts.mart_churn_alerts"
    assert tb.qualify("x", None, target="dev") == "dev.x"
    df = spark.createDataFrame([("a", 1)], "id string, n int")
    assert as_json_records(df).first()[0] == '{"id":"a","n":1}'


D0, D1, D2 = (dt.datetime(2001, 10, 24) + dt.timedelta(days=7 * k) for k in range(3))


def _versions(df):
    return {(r.account_id, r.risk_score, r.dbt_valid_from, r.dbt_valid_to) for r in df.collect()}


def test_repeated_snapshot_replaces_the_run(spark):
    path = scratch_path(spark, "t_snp")
    frame = lambda *rows: spark.createDataFrame(list(rows), S)
    tb.apply_snapshot(spark, path, frame(("a", "LOW", 1.0), ("b", "LOW", 2.0)), D0)
    tb.apply_snapshot(spark, path, frame(("a", "HIGH", 80.0)), D1)
    # the data was wrong: a had not changed so much, and b was still there
    out = tb.apply_snapshot(spark, path, frame(("a", "HIGH", 75.0), ("b", "LOW", 2.0)), D1)
    want = {("a", 1.0, D0, D1), ("a", 75.0, D1, None), ("b", 2.0, D0, None)}
    assert _versions(out) == want
    ids = [r.dbt_scd_id for r in out.collect()]
    assert len(ids) == len(set(ids))
    assert _versions(tb.read_snapshot(spark, path)) == want
    with pytest.raises(ValueError, match="older"):
        tb.apply_snapshot(spark, path, frame(("a", "LOW", 1.0)), D0)
    assert _versions(tb.read_snapshot(spark, path)) == want
    out = tb.apply_snapshot(spark, path, frame(("b", "LOW", 3.0)), D2)
    assert _versions(out) == {("a", 1.0, D0, D1), ("a", 75.0, D1, D2), ("b", 2.0, D0, D2), ("b", 3.0, D2, None)}


def test_a_run_that_never_published_leaves_the_history(spark, monkeypatch):
    path = scratch_path(spark, "t_snp")
    first = tb.apply_snapshot(spark, path, spark.createDataFrame([("a", "LOW", 1.0)], S), D0)
    want = _versions(first)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(tb, "_publish_runs", lost)
        with pytest.raises(OSError):
            tb.apply_snapshot(spark, path, spark.createDataFrame([("a", "LOW", 9.0)], S), D1)
    assert _versions(tb.read_snapshot(spark, path)) == want


def test_views_tables_and_predictions(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "account_id string, risk_score_ml double")
    assert tb.as_view(df, "t_view").count() == spark.table("t_view").count() == 2
    for n in (2, 1):
        assert tb.replace_predictions(df.limit(n), "ml_output.t_predictions", path=scratch_path(spark, "t_pred")) == n
    assert read_predictions(spark, "ml_output.t_predictions").count() == 1


def test_shared_folder_is_required_on_a_cluster():
    class Cluster:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Cluster

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)
