"""Alert routing, driver ties and the rule vs ML tier edges."""

import datetime as dt

from pyspark.sql import functions as F

from riskweave.config import Settings
from riskweave.operators import alerts as al
from riskweave.operators.compare import ml_tier, tier_agreement
from riskweave.operators.scoring import tier_col

COLS = ("account_id string, risk_tier string, days_to_renewal long, is_in_renewal_window boolean, "
        "usage_score double, commercial_score double, support_score double")


def test_alert_priority_covers_all_four_levels(spark):
    rows = [
        ("p1", "HIGH", 14, True, 1.0, 0.0, 0.0),
        ("p1neg", "HIGH", -5, False, 1.0, 0.0, 0.0),  # past renewal still counts as <= 14
        ("p2", "HIGH", 15, True, 1.0, 0.0, 0.0),
        ("p2b", "HIGH", 30, True, 1.0, 0.0, 0.0),
        ("p3", "HIGH", 31, True, 1.0, 0.0, 0.0),
        ("p4", "MEDIUM", 90, True, 1.0, 0.0, 0.0),
        ("none", "MEDIUM", 91, False, 1.0, 0.0, 0.0),
        ("low", "LOW", 3, True, 1.0, 0.0, 0.0),
    ]
    df = spark.createDataFrame(rows, COLS)
    got = {r[0]: r[1] for r in df.select("account_id", al.alert_priority()).collect()}
    assert got == {"p1": 1, "p1neg": 1, "p2": 2, "p2b": 2, "p3": 3, "p4": 4, "none": None, "low": None}
    scoped = {r[0] for r in df.where(al.in_scope()).select("account_id").collect()}
    assert scoped == {"p1", "p1neg", "p2", "p2b", "p3", "p4"}


def test_top_driver_ties_prefer_usage_then_commercial(spark):
    rows = [("a", "HIGH", 1, True, 50.0, 50.0, 50.0), ("b", "HIGH", 1, True, 10.0, 60.0, 60.0),
            ("c", "HIGH", 1, True, 10.0, 20.0, 60.0)]
    df = spark.createDataFrame(rows, COLS)
    got = {r[0]: r[1] for r in df.select("account_id", al.top_risk_driver()).collect()}
    assert got == {"a": "usage", "b": "commercial", "c": "support"}


def test_rule_tiers_closed_below_ml_tiers_closed_above(spark):
    s = Settings(as_of=dt.date(2001, 11, 7))
    df = spark.createDataFrame([(x,) for x in (39.99, 40.0, 40.01, 69.99, 70.0, 70.01, 0.0, 100.0)], "x double")
    got = df.select("x", tier_col(F.col("x"), s).alias("rule"), ml_tier("x").alias("ml")).collect()
    table = {r.x: (r.rule, r.ml) for r in got}
    assert table[40.0] == ("MEDIUM", "LOW")
    assert table[70.0] == ("HIGH", "MEDIUM")
    assert table[70.01] == ("HIGH", "HIGH")
    assert table[39.99] == ("LOW", "LOW")
    assert table[0.0] == ("LOW", "LOW") and table[100.0] == ("HIGH", "HIGH")


def test_tier_agreement_labels(spark):
    rows = [("HIGH", "HIGH"), ("LOW", "HIGH"), ("HIGH", "MEDIUM"), ("LOW", "MEDIUM")]
    df = spark.createDataFrame(rows, "rule string, ml string")
    got = [r[0] for r in df.select(tier_agreement(F.col("rule"), F.col("ml"))).collect()]
    assert got == ["AGREE", "ML_HIGHER", "ML_LOWER", "DIFFER"]
