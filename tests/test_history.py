"""SCD2: the sequential fold of scd2_apply equals the batch lag/lead form; invariants."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskweave.functions.exprs import week_diff
from riskweave.operators.history import (
    alert_history,
    high_streak,
    scd2_apply,
    scd2_from_log,
    tier_transitions,
)

SCHEMA = "account_id string, risk_tier string, risk_score double, snapshot_ts timestamp_ntz"
DAYS = [dt.datetime(2001, 10, 17) + dt.timedelta(days=7 * i) for i in range(5)]


def _random_log(seed: int):
    rng = random.Random(seed)
    rows = []
    for k in range(12):
        present = True
        tier, score = "LOW", 10.0
        for d in DAYS:
            if rng.random() < 0.2:
                present = not present
            if rng.random() < 0.4:
                tier = rng.choice(["LOW", "MEDIUM", "HIGH"])
            if rng.random() < 0.3:
                score = rng.choice([10.0, 45.5, 72.0, None])
            if present:
                rows.append((f"a{k}", tier, score, d))
    return rows


def _fold(spark, rows):
    hist = None
    for d in DAYS:
        cur = spark.createDataFrame([r for r in rows if r[3] == d] or [], SCHEMA).drop("snapshot_ts")
        hist = scd2_apply(hist, cur, d).checkpoint()
    return hist


def _key(df):
    cols = ["account_id", "risk_tier", "risk_score", "dbt_scd_id", "dbt_valid_from", "dbt_valid_to"]
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_fold_equals_batch(spark):
    for seed in (1, 2, 3):
        rows = _random_log(seed)
        log = spark.createDataFrame(rows, SCHEMA)
        batch = scd2_from_log(log)
        assert _key(_fold(spark, rows)) == _key(batch), seed


def test_invariants(spark):
    rows = _random_log(4)
    h = scd2_from_log(spark.createDataFrame(rows, SCHEMA))
    # at most one open version per key
    assert h.where(F.col("dbt_valid_to").isNull()).groupBy("account_id").count().where("count > 1").count() == 0
    # versions of a key never overlap: each starts at or after the previous one ends
    w = Window.partitionBy("account_id").orderBy("dbt_valid_from")
    prev_end = F.lag("dbt_valid_to").over(w)
    prev_open = F.lag(F.col("dbt_valid_to").isNull()).over(w)
    bad = h.select(prev_end.alias("pe"), prev_open.alias("po"), "dbt_valid_from").where(
        F.col("po") | (F.col("pe") > F.col("dbt_valid_from"))
    )
    assert bad.count() == 0
    assert h.select("dbt_scd_id").distinct().count() == h.count()


def test_delete_then_reappear(spark):
    rows = [("x", "HIGH", 80.0, DAYS[0]), ("x", "HIGH", 80.0, DAYS[2])]
    runs = spark.createDataFrame([(d,) for d in DAYS[:3]], "ts timestamp_ntz")
    h = scd2_from_log(spark.createDataFrame(rows, SCHEMA), runs=runs)
    h = h.orderBy("dbt_valid_from").collect()
    assert [(r.dbt_valid_from, r.dbt_valid_to) for r in h] == [(DAYS[0], DAYS[1]), (DAYS[2], None)]


def test_unchanged_keeps_first_version_values(spark):
    s = "account_id string, risk_tier string, risk_score double, scored_week date, snapshot_ts timestamp_ntz"
    rows = [("x", "LOW", 5.0, DAYS[0].date(), DAYS[0]), ("x", "LOW", 5.0, DAYS[1].date(), DAYS[1])]
    h = scd2_from_log(spark.createDataFrame(rows, s)).collect()
    assert len(h) == 1 and h[0].scored_week == DAYS[0].date()  # check columns only


def test_streak_restarts_on_score_change_but_true_streak_does_not(spark):
    rows = [("x", "HIGH", 75.0, DAYS[0]), ("x", "HIGH", 80.0, DAYS[1]), ("x", "HIGH", 80.0, DAYS[2])]
    h = scd2_from_log(spark.createDataFrame(rows, SCHEMA))
    as_of = F.lit(DAYS[2].date())
    ah = alert_history(h, as_of).first()
    assert ah.consecutive_high_weeks == 2  # counted from the open version (score changed)
    assert ah.first_alerted_at == DAYS[0]
    hs = high_streak(h, as_of).first()
    assert hs.high_streak_weeks == 3 and hs.high_since == DAYS[0]
    assert tier_transitions(h).count() == 0


def test_tier_round_trip_is_audited(spark):
    rows = [("x", "HIGH", 75.0, DAYS[0]), ("x", "LOW", 20.0, DAYS[1]), ("x", "HIGH", 71.0, DAYS[2])]
    t = tier_transitions(scd2_from_log(spark.createDataFrame(rows, SCHEMA))).orderBy("changed_at")
    assert [(r.from_tier, r.to_tier) for r in t.collect()] == [("HIGH", "LOW"), ("LOW", "HIGH")]
    d = spark.createDataFrame([(DAYS[0].date(),)], "d date")
    assert d.select(week_diff("d", F.lit(DAYS[2].date()))).first()[0] == 2
