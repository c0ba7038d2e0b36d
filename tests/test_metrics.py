"""AUC, threshold curve, permutation importance and the LR gradient against plain computations."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskweave import registry
from riskweave.config import Settings
from riskweave.operators import metrics as me
from riskweave.operators import ml
from riskweave.operators.history import scd2_apply, scd2_from_log
from riskweave.operators.signals import active_users_30d

S = "id string, score double, label int"


def data(spark, n=300, seed=1):
    r = random.Random(seed)
    rows = [(f"k{k}", float(r.randint(0, 12)), int(r.random() < 0.3)) for k in range(n)]
    return spark.createDataFrame(rows, S), rows


def plain_auc(rows):
    pos, neg = [s for _, s, y in rows if y], [s for _, s, y in rows if not y]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / (len(pos) * len(neg)) if pos and neg else None


def test_auc_with_ties(spark):
    df, rows = data(spark)
    got = me.auc(df, "score", "label").first()
    assert got.auc == pytest.approx(plain_auc(rows), abs=1e-12)
    assert (got.n_positive, got.n_negative) == (sum(r[2] for r in rows), sum(1 - r[2] for r in rows))
    trapezes = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert got.auc == pytest.approx(trapezes, abs=1e-9)


def test_auc_by_group_in_one_sort(spark):
    df, rows = data(spark)
    got = {r.g: r.auc for r in me.auc(df.withColumn("g", F.col("score") % 3), "score", "label", by="g").collect()}
    assert got == {g: pytest.approx(plain_auc([r for r in rows if r[1] % 3 == g]), abs=1e-12) for g in (0.0, 1.0, 2.0)}


def test_one_class_and_no_rows(spark):
    df, _ = data(spark)
    assert me.auc(df.where("label = 0"), "score", "label").first().auc is None
    assert me.auc(df.limit(0), "score", "label").count() == 0
    assert me.threshold_curve(df.limit(0), "score", "label").count() == 0


def test_threshold_curve(spark):
    df, rows = data(spark)
    got = {r.threshold: r for r in me.threshold_curve(df, "score", "label").collect()}
    total = sum(r[2] for r in rows)
    for t in {r[1] for r in rows}:
        flagged = [r for r in rows if r[1] >= t]
        hits = sum(r[2] for r in flagged)
        assert (got[t].n_flagged, got[t].true_positives) == (len(flagged), hits)
        assert got[t].precision == hits / len(flagged) and got[t].recall == hits / total
        assert got[t].f1 == pytest.approx(2 * hits / (len(flagged) + total))
    assert [t for t, r in got.items() if r.best] == [max(got, key=lambda t: (got[t].f1, t))]


def test_permuted_columns_keep_their_values(spark):
    df = spark.createDataFrame([(f"k{k}", k, float(-k)) for k in range(40)], "id string, a int, b double")
    out = me.permuted(df, "id", ["a", "b"]).collect()
    keys = sorted(f"k{k}" for k in range(40))
    for column in ("a", "b"):
        dealt = sorted(keys, key=lambda k: (hashlib.md5(f"{k}|{column}|42".encode()).hexdigest(), k))
        want = {k: int(d[1:]) for k, d in zip(keys, dealt, strict=True)}
        own = [r for r in out if r.permuted == column]
        assert {r.id: abs(int(r[column])) for r in own} == want
        other = "b" if column == "a" else "a"
        assert all(abs(int(r[other])) == int(r.id[1:]) for r in own)


def test_importance_order(spark):
    """The column that makes the score loses most, one that it ignores loses nothing."""
    r = random.Random(2)
    rows = [(f"k{k}", r.random(), r.random(), r.random()) for k in range(400)]
    df = spark.createDataFrame(rows, "id string, strong double, weak double, unused double")
    df = df.withColumn("label", (F.col("strong") + 0.3 * F.col("weak") > 0.8).cast("int"))
    out = me.importance(df, "id", ["strong", "weak", "unused"], F.col("strong") + 0.3 * F.col("weak"), "label").collect()
    assert [x.feature for x in sorted(out, key=lambda x: x["rank"])] == ["strong", "weak", "unused"]
    assert [x.auc_drop for x in out if x.feature == "unused"] == [0.0]


def test_gradient_vanishes_at_the_fit_only(spark):
    training = registry.training_frame(spark, "/root/testdata/sf0.001")
    model, weighted = ml.fit_logistic(training)
    at_fit = [abs(r.gradient) for r in ml.lr_gradient(model, weighted).collect()]
    assert len(at_fit) == len(ml.FEATURE_COLS) + 1 and max(at_fit) < 1e-5
    # the same coefficients on other rows are no optimum
    assert max(abs(r.gradient) for r in ml.lr_gradient(model, weighted.where(F.col("wau_rolling_4w") > 0)).collect()) > 1e-4


def test_active_users_of_many_runs(spark):
    r = random.Random(3)
    day = dt.datetime(2001, 11, 7)
    events = [(f"a{r.randint(0, 3)}", f"u{r.randint(0, 5)}", day - dt.timedelta(days=r.randint(-20, 400), hours=r.randint(0, 23))) for _ in range(400)]
    df = spark.createDataFrame(events, "account_id string, user_id string, event_ts timestamp_ntz")
    runs = [day.date() - dt.timedelta(days=7 * k) for k in range(52)] + [dt.date(2001, 11, 30)]
    for bounded in (runs[1:], runs, []):
        s = Settings.runs(runs, bounded=bounded, run_col="run_as_of")
        got = {(x.run_as_of, x.account_id): x.active_users_30d for x in active_users_30d(df, s).collect()}
        want: dict = {}
        for run in runs:
            for a, u, t in events:
                if t >= dt.datetime.combine(run - dt.timedelta(days=30), dt.time()) and (run not in bounded or t < dt.datetime.combine(run + dt.timedelta(days=1), dt.time())):
                    want.setdefault((run, a), set()).add(u)
        assert got == {k: len(v) for k, v in want.items()}


def test_no_event_is_copied_per_run(spark):
    """The plan explodes runs per account only: days, intervals and pieces do not grow with runs."""
    one = [("a", "u", dt.datetime(2001, 10, 1, h)) for h in range(24)]
    df = spark.createDataFrame(one, "account_id string, user_id string, event_ts timestamp_ntz")
    runs = [dt.date(2001, 10, 1) + dt.timedelta(days=k) for k in range(30)]
    s = Settings.runs(runs, bounded=runs, run_col="run_as_of")
    assert [r.active_users_30d for r in active_users_30d(df, s).collect()] == [1] * 30
    plan = active_users_30d(df, s)._jdf.queryExecution().analyzed().toString()
    assert "explode(filter(" not in plan and plan.count("explode(sequence(0") == 1


def test_history_of_many_runs(spark):
    """500 runs of one account: the batch form by lead equals the fold, and has no growing frame."""
    r = random.Random(5)
    start = dt.datetime(2000, 1, 1)
    log = [("a", "LOW", float(r.randint(0, 2)), start + dt.timedelta(days=7 * k)) for k in range(500) if r.random() < 0.9]
    cols = "account_id string, risk_tier string, risk_score double, snapshot_ts timestamp_ntz"
    runs = spark.createDataFrame([(start + dt.timedelta(days=7 * k),) for k in range(500)], "ts timestamp_ntz")
    out = scd2_from_log(spark.createDataFrame(log, cols), runs=runs)
    assert "unboundedfollowing" not in out._jdf.queryExecution().analyzed().toString().lower()
    have = {x[3]: x[2] for x in log}
    want, open_ = [], None
    for k in range(500):
        ts = start + dt.timedelta(days=7 * k)
        now = have.get(ts)
        if open_ and now != open_[0]:
            want.append((*open_, ts))
            open_ = None
        if now is not None and open_ is None:
            open_ = (now, ts)
    want += [(*open_, None)] if open_ else []
    assert sorted(((x.risk_score, x.dbt_valid_from, x.dbt_valid_to) for x in out.collect()), key=lambda x: x[1]) == want


def test_history_keeps_deleted_keys_when_told(spark):
    d = [dt.datetime(2001, 1, 1) + dt.timedelta(days=k) for k in range(4)]
    cols = "account_id string, risk_tier string, risk_score double, snapshot_ts timestamp_ntz"
    log = [("a", "LOW", 1.0, d[0]), ("a", "LOW", 1.0, d[2]), ("a", "LOW", 2.0, d[3]), ("b", "LOW", 1.0, d[0])]
    runs = spark.createDataFrame([(x,) for x in d], "ts timestamp_ntz")
    for hard in (True, False):
        out = scd2_from_log(spark.createDataFrame(log, cols), runs=runs, invalidate_hard_deletes=hard)
        hist = None
        for x in d:
            now = spark.createDataFrame([r[:3] for r in log if r[3] == x], "account_id string, risk_tier string, risk_score double")
            hist = scd2_apply(hist, now, x, invalidate_hard_deletes=hard)
        key = ["account_id", "risk_score", "dbt_valid_from", "dbt_valid_to"]
        assert sorted(map(str, out.select(key).collect())) == sorted(map(str, hist.select(key).collect()))


def test_weekly_usage_shuffles_events_once(spark):
    from riskweave.functions.exprs import week_start
    from riskweave.operators.activity import weekly_usage

    rows = [(f"a{i % 3}" if i % 11 else None, None if i % 5 == 0 else f"u{i % 4}", None if i % 3 else f"s{i}", None if i % 2 else "f", i % 20) for i in range(300)]
    ev = spark.createDataFrame(rows + rows[:40], "account_id string, user_id string, session_id string, feature_name string, d int")
    ev = ev.withColumn("event_ts", F.when(F.col("d") != 7, F.date_add(F.lit("2001-10-22").cast("date"), F.col("d")).cast("timestamp_ntz")))
    got = weekly_usage(ev)
    want = ev.groupBy("account_id", week_start("event_ts").alias("week_start")).agg(
        F.count_distinct("user_id").alias("wau"), F.count_distinct("session_id").alias("session_count"), F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("feature_name").alias("distinct_features_used"), F.max("event_ts").alias("last_event_ts"))
    assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    plan = weekly_usage(ev)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" not in plan
