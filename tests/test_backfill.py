"""The one-plan backfill equals independent single-run builds, run by run."""

import datetime as dt
from dataclasses import replace

from riskweave import registry
from riskweave.config import Settings
from riskweave.operators.activity import weekly_usage
from riskweave.plans import backfill as bf
from riskweave.plans.weekly import build
from riskweave.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
DAYS = [fx.AS_OF - dt.timedelta(days=d) for d in (15, 8, 0)]  # mixed weekdays


def test_multi_run_scores_equal_single_runs(spark):
    s = Settings(as_of=fx.AS_OF)
    raw = fx.raw_tables(spark, SF)
    runs = bf.scores_by_run(raw, s, DAYS)
    for d in DAYS:
        single = build(raw, replace(s, as_of=d, bound_future=d != max(DAYS)), stamp=False).scores
        multi = runs.where(runs[bf.RUN] == d).drop(bf.RUN)
        assert multi.exceptAll(single).count() == 0, d
        assert single.exceptAll(multi).count() == 0, d


def test_approx_weekly_usage_is_close(spark):
    ev = registry._staged(spark, SF)["product_events"]
    exact = {(r.account_id, r.week_start): r.session_count for r in weekly_usage(ev).collect()}
    approx = {(r.account_id, r.week_start): r.session_count
              for r in weekly_usage(ev, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - v) <= max(2, 0.05 * v) for k, v in exact.items())


def test_run_weekly_job_two_weeks(spark):
    from pyspark.sql import functions as F

    from riskweave.session import scratch_path

    root = scratch_path(spark, "t_job")
    raw = fx.raw_tables(spark, SF)
    prev = fx.AS_OF - dt.timedelta(days=7)
    bf_settings = Settings(as_of=prev, bound_future=True)
    from riskweave.plans.weekly import run_weekly
    from riskweave.sinks import versions
    from riskweave.sinks.tables import read_snapshot

    run_weekly(raw, bf_settings, root)
    paths = run_weekly(raw, Settings(as_of=fx.AS_OF), root)
    act = versions.read(spark, paths["int_account_activity_weekly"])
    assert act.select("week_start").distinct().count() == 13  # 12 spine weeks + the oldest kept
    assert act.groupBy("account_id", "week_start").count().where("count > 1").count() == 0
    snp = read_snapshot(spark, paths["snp_churn_risk_scores"])
    assert snp.where(F.col("dbt_valid_to").isNull()).groupBy("account_id").count().where("count > 1").count() == 0
    scores = spark.read.parquet(paths["mart_churn_risk_scores"])
    assert scores.count() == registry.q_risk_scores(spark, SF).count()
    alerts = spark.read.parquet(paths["mart_churn_alerts"])
    assert alerts.where(F.col("alert_priority").isNull()).count() == 0
    mart = spark.read.parquet(paths["mart_churn_risk_scores_ml"])
    assert mart.count() == spark.read.parquet(paths["ml_predictions"]).count() == scores.count()
    tests = spark.read.parquet(paths["data_tests"])
    # event_id is repeated once at this scale
    assert [(r.table_name, r.column_name) for r in tests.where("not passed").collect()] in ([], [("stg_product_events", "event_id")])
    assert tests.count() > 70


def test_incremental_activity_equals_full_refresh_on_spine(spark):
    from riskweave.operators.activity import activity_weekly
    from riskweave.sources.staging import stage_all

    st = stage_all(fx.raw_tables(spark, SF))
    s = Settings(as_of=fx.AS_OF)
    full = activity_weekly(st["accounts"], st["product_events"], s, stamp=False)
    inc = activity_weekly(st["accounts"], st["product_events"], s, incremental=True, stamp=False)
    assert full.exceptAll(inc).count() == 0 and inc.exceptAll(full).count() == 0


def test_wall_clock_default_runs(spark):
    from pyspark.sql import functions as F

    b = build(fx.raw_tables(spark, SF), Settings(), stamp=True)
    out = b.scores.select("scored_week", "scored_at").distinct().collect()
    assert len(out) == 1 and out[0].scored_at is not None
    assert b.scores.where(F.col("risk_tier").isNull()).count() == 0


def test_account_states_of_runs_come_from_one_scan(spark):
    now = spark.createDataFrame([("1", True, 5.0), ("2", True, None), ("3", False, 7.0)], "account_id string, is_active boolean, mrr double")
    runs = [dt.date(2024, 1, 8), dt.date(2024, 1, 1)]
    rows = [(runs[1], "1", False, None), (runs[0], "3", True, 8.0), (dt.date(2020, 1, 1), "2", False, 0.0), (runs[0], "9", True, 1.0)]
    changed = spark.createDataFrame(rows, "run_as_of date, account_id string, is_active boolean, mrr double")
    got = bf.accounts_by_run(now, changed, runs)
    assert got.columns == ["account_id", "is_active", "mrr", "run_as_of"]
    assert sorted(map(tuple, got.select("run_as_of", "account_id", "is_active", "mrr").collect()), key=str) == [
        (runs[1], "1", False, None), (runs[1], "2", True, None), (runs[1], "3", False, 7.0),
        (runs[0], "1", True, 5.0), (runs[0], "2", True, None), (runs[0], "3", True, 8.0),
    ]
