"""Fan-out of a multi-run backfill, and what reaches the scan."""

import datetime as dt

from pyspark.sql import functions as F

from riskweave.config import Settings
from riskweave.operators import signals
from riskweave.plans.backfill import run_settings
from riskweave.session import scratch_path

RUNS = [dt.date(2001, 11, 7) - dt.timedelta(days=7 * k) for k in range(52)]
BILLING = "event_id string, account_id string, event_type string, amount double, event_ts timestamp_ntz"


def billing(spark):
    start = dt.datetime(2000, 9, 1)
    kinds = ["payment_failure", "downgrade", "renewal"]
    rows = [(str(i), str(i % 5), kinds[i % 3], 1.0, start + dt.timedelta(hours=16 * i)) for i in range(700)]
    return spark.createDataFrame(rows, BILLING)


def test_runs_get_only_the_rows_they_keep(spark):
    s = run_settings(Settings(as_of=RUNS[0], bound_future=True), RUNS)
    tagged = s.tag_runs(billing(spark), "event_ts", 30)
    kept = signals._bounded(tagged.where(F.col("event_ts") >= s.days_back_ts(30)), "event_ts", s)
    assert 0 < tagged.count() == kept.count()
    assert tagged.groupBy("event_id").count().agg(F.max("count")).first()[0] <= 5


def test_backfill_equals_single_runs(spark):
    df, days = billing(spark), RUNS[::17]
    many = signals.billing_aggregate(df, run_settings(Settings(as_of=days[0], bound_future=True), days))
    for day in days:
        one = signals.billing_aggregate(df, Settings(as_of=day, bound_future=True))
        got = many.where(F.col("run_as_of") == F.lit(day)).drop("run_as_of")
        assert sorted(map(str, got.collect())) == sorted(map(str, one.collect()))


def test_billing_filter_reaches_a_stored_table(spark):
    path = scratch_path(spark, "t_billing")
    billing(spark).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        agg = signals.billing_aggregate(spark.read.parquet(path), Settings(as_of=RUNS[0]))
        plan = agg._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    pushed, read = scan.split("PushedFilters")[1].split("ReadSchema")
    assert "GreaterThanOrEqual(event_ts,2001-08-09" in pushed and "In(event_type" in pushed
    assert "amount" not in read
