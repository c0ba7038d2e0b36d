"""Rule vs ML: propensity scoring (ML2, ML3), prediction frame shape (ML12), the
side-by-side mart (ML14: JN9, SCR17, SCR18) and the comparison report (ML15: AGG11,
FLT7, SCR19). All projections and one key join; the summary is a single global agg.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.config import Settings
from riskweave.functions.exprs import clamp, round_half_up, round_scaled_even
from riskweave.operators.ranking import Ordered, ordered

# FIXED VALUES: model feature list and the NULL fills applied before modelling
FEATURE_COLS = [
    "wau_rolling_4w",
    "usage_trend_pct",
    "active_user_ratio",
    "distinct_features_used",
    "days_since_last_event",
    "is_zero_usage_week",
    "is_low_utilization",
    "days_to_renewal",
    "seat_contracted_ratio",
    "had_payment_failure_30d",
    "had_downgrade_90d",
    "is_in_renewal_window",
    "p1_p2_tickets_30d",
    "open_tickets_count",
    "avg_ticket_resolution_days",
]
NULL_FILL = {
    "usage_trend_pct": 0.0,
    "days_since_last_event": 30.0,
    "avg_ticket_resolution_days": 0.0,
    "active_user_ratio": 0.0,
    "wau_rolling_4w": 0.0,
}
# ML tiers use right-closed bins (-1, 40], (40, 70], (70, 101]
ML_TIER_EDGES = (-1.0, 40.0, 70.0, 101.0)
LABEL_THRESHOLD = 0.45


def prepare_features(features: DataFrame, keep: tuple[str, ...] = ("account_id", "feature_week")) -> DataFrame:
    """ML2: every feature as double, NULLs filled per column, then 0."""
    cols = [
        F.coalesce(F.col(c).cast("double"), F.lit(NULL_FILL.get(c, 0.0))).alias(c)
        for c in FEATURE_COLS
    ]
    return features.select(*keep, *cols)


def propensity(prepared: DataFrame) -> Column:
    """ML3: deterministic churn propensity of the prepared features. FIXED VALUES: the weights."""
    c = F.col
    usage = (
        0.30 * clamp(c("days_since_last_event") / 60.0, 0.0, 1.0)
        + 0.25 * (1.0 - clamp(c("active_user_ratio"), 0.0, 1.0))
        + 0.20 * (-clamp(c("usage_trend_pct"), -1.0, 0.0))
        + 0.15 * c("is_zero_usage_week")
        + 0.10 * (c("distinct_features_used") < 2).cast("double")
    )
    commercial = (
        0.35 * clamp(clamp(c("days_to_renewal"), 0.0, 90.0) / 90.0, 0.0, 1.0)
        + 0.30 * (1.0 - clamp(c("seat_contracted_ratio"), 0.0, 1.0))
        + 0.25 * c("had_payment_failure_30d")
        + 0.10 * c("had_downgrade_90d")
    )
    commercial = commercial * (1.0 - clamp(c("days_to_renewal"), 0.0, 365.0) / 365.0 * 0.3)
    support = (
        0.50 * clamp(c("p1_p2_tickets_30d") / 4.0, 0.0, 1.0)
        + 0.30 * clamp(c("open_tickets_count") / 6.0, 0.0, 1.0)
        + 0.20 * clamp(c("avg_ticket_resolution_days") / 14.0, 0.0, 1.0)
    )
    return 0.45 * usage + 0.30 * commercial + 0.25 * support


def with_propensity(prepared: DataFrame) -> DataFrame:
    p = propensity(prepared)
    return prepared.withColumns(
        {"propensity": p, "weak_label": (p > LABEL_THRESHOLD).cast("int")}
    )


def ml_tier(score) -> Column:
    """FN16: right-closed bins; scores outside (-1, 101] get no tier."""
    x = F.col(score) if isinstance(score, str) else score
    lo, med, high, top = ML_TIER_EDGES
    return (
        F.when((x > lo) & (x <= med), "LOW")
        .when((x > med) & (x <= high), "MEDIUM")
        .when((x > high) & (x <= top), "HIGH")
    )


def prediction_frame(
    scored: DataFrame, prob: Column, model_name: str, cv_auc: float | None, s: Settings,
    stamp: bool = True,
) -> DataFrame:
    """ML12: probability -> score (x100, 2 dp) and tier; numpy-style half-even rounding."""
    score = round_scaled_even(prob * 100.0, 2)
    out = scored.select(
        "account_id",
        "feature_week",
        *FEATURE_COLS,
        score.alias("risk_score_ml"),
        ml_tier(score).alias("risk_tier_ml"),
        round_scaled_even(prob, 4).alias("churn_probability"),
        F.lit(model_name).alias("model_name"),
        F.lit(cv_auc).cast("double").alias("cv_auc"),
    )
    return out.withColumn("scored_at", s.run_ts_col()) if stamp else out


def propensity_predictions(features: DataFrame, s: Settings, stamp: bool = True) -> DataFrame:
    """Predictions whose probability is the clipped ML3 propensity (no fitted model)."""
    scored = with_propensity(prepare_features(features))
    prob = clamp(F.col("propensity"), 0.0, 1.0)
    return prediction_frame(scored, prob, "weak_label_propensity", None, s, stamp=stamp)


MART_COLUMNS = [
    "account_id", "scored_week", "plan_name", "mrr", "renewal_date", "days_to_renewal",
    "is_in_renewal_window", "risk_score_ml", "risk_tier_ml", "churn_probability",
    "model_name", "cv_auc", "risk_score_rule", "risk_tier_rule", "usage_score",
    "commercial_score", "support_score", "wau", "usage_trend_pct", "active_user_ratio",
    "distinct_features_used", "days_since_last_event", "had_payment_failure_30d",
    "p1_p2_tickets_30d", "scored_at", "score_delta", "tier_agreement",
]


def tier_agreement(rule: Column, ml: Column) -> Column:
    return (
        F.when(ml == rule, "AGREE")
        .when((ml == "HIGH") & (rule != "HIGH"), "ML_HIGHER")
        .when((rule == "HIGH") & (ml != "HIGH"), "ML_LOWER")
        .otherwise("DIFFER")
    )


def rule_vs_ml(scores: DataFrame, predictions: DataFrame) -> DataFrame:
    """ML14: inner join on account only (a stale prediction pairs with a new score)."""
    p = predictions.select(
        "account_id", "risk_score_ml", "risk_tier_ml", "churn_probability", "model_name",
        "cv_auc", *(["scored_at"] if "scored_at" in predictions.columns else []),
    )
    r = scores.drop("scored_at").withColumnsRenamed(
        {"risk_score": "risk_score_rule", "risk_tier": "risk_tier_rule"}
    )
    j = r.join(p, "account_id", "inner").withColumns(
        {
            "score_delta": round_half_up(F.col("risk_score_ml") - F.col("risk_score_rule"), 2),
            "tier_agreement": tier_agreement(F.col("risk_tier_rule"), F.col("risk_tier_ml")),
        }
    )
    return j.select(*[c for c in MART_COLUMNS if c in j.columns])


def ordered_ml(mart: DataFrame) -> DataFrame:
    """ORD3: the side-by-side mart by ML score, highest first (account_id breaks ties)."""
    return mart.orderBy(F.col("risk_score_ml").desc(), "account_id")


def in_order(mart: DataFrame) -> Ordered:
    """ORD3 with places: rank, quantiles and pages over the whole mart."""
    return ordered(mart, F.desc("risk_score_ml"), F.asc("account_id"))


def compare_frame(scores: DataFrame, predictions: DataFrame) -> DataFrame:
    """ML15: the side-by-side listing (scores to 1 dp, probability to 3 dp)."""
    r, m = scores, predictions
    j = r.select(
        "account_id", "plan_name", "mrr", "risk_score", "risk_tier",
        "usage_score", "commercial_score", "support_score",
    ).join(m.select("account_id", "risk_score_ml", "risk_tier_ml", "churn_probability"), "account_id")
    return j.select(
        "account_id",
        "plan_name",
        "mrr",
        round_half_up("risk_score", 1).alias("score_rule"),
        F.col("risk_tier").alias("tier_rule"),
        round_half_up("risk_score_ml", 1).alias("score_ml"),
        F.col("risk_tier_ml").alias("tier_ml"),
        round_half_up("churn_probability", 3).alias("churn_prob"),
        round_half_up(F.col("risk_score_ml") - F.col("risk_score"), 1).alias("delta"),
        "usage_score",
        "commercial_score",
        "support_score",
    )


def compare_summary(frame: DataFrame) -> DataFrame:
    """AGG11: agreement, mean delta, correlation and HIGH counts/MRR per method."""
    agree = F.col("tier_rule") == F.col("tier_ml")
    rule_high = F.col("tier_rule") == "HIGH"
    ml_high = F.col("tier_ml") == "HIGH"
    return frame.agg(
        F.count(F.lit(1)).alias("n_accounts"),
        F.count_if(agree).alias("n_agree"),
        F.avg(agree.cast("double")).alias("agreement_rate"),
        F.avg("delta").alias("mean_delta"),
        F.corr("score_rule", "score_ml").alias("score_corr"),
        F.count_if(rule_high).alias("n_rule_high"),
        F.sum(F.when(rule_high, F.col("mrr")).otherwise(0.0)).alias("mrr_rule_high"),
        F.count_if(ml_high).alias("n_ml_high"),
        F.sum(F.when(ml_high, F.col("mrr")).otherwise(0.0)).alias("mrr_ml_high"),
    )


def tier_disagreements(frame: DataFrame) -> DataFrame:
    """FLT7 + SCR19: accounts whose tiers differ, with the direction of the change."""
    rule, ml = F.col("tier_rule"), F.col("tier_ml")
    direction = (
        F.when((ml == "HIGH") & (rule != "HIGH"), "upgraded")
        .when((rule == "HIGH") & (ml != "HIGH"), "downgraded")
        .otherwise("differ")
    )
    return frame.where(rule != ml).select(
        "account_id", "tier_rule", "tier_ml", direction.alias("direction"), "score_rule", "score_ml"
    )
