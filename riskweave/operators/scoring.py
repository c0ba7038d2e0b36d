"""Rule model SCR1-14: eleven banded signals, three components, weighted score, tier.

All of it is a single projection over the feature rows (no join, no shuffle); the
reference's self-joins of the feature table on account_id collapse into one select.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.config import Settings
from riskweave.functions import bands as B
from riskweave.functions.exprs import band, round_half_up
from riskweave.operators.ranking import Ordered, ordered

SCORE_COLUMNS = [
    "account_id",
    "scored_week",
    "plan_name",
    "mrr",
    "renewal_date",
    "days_to_renewal",
    "is_in_renewal_window",
    "usage_score",
    "commercial_score",
    "support_score",
    "wau",
    "usage_trend_pct",
    "active_user_ratio",
    "distinct_features_used",
    "days_since_last_event",
    "had_payment_failure_30d",
    "p1_p2_tickets_30d",
    "risk_score",
    "risk_tier",
]


def usage_subscores() -> dict[str, Column]:
    return {
        "usage_trend_score": band(
            "usage_trend_pct", B.USAGE_TREND, when_null=B.USAGE_TREND_NULL
        ),
        "active_user_score": band(
            "active_user_ratio",
            B.ACTIVE_USER,
            pre=[(F.col("is_zero_usage_week"), B.ACTIVE_USER_ZERO_WEEK)],
        ),
        "feature_breadth_score": band("distinct_features_used", B.FEATURE_BREADTH),
        "recency_score": band("days_since_last_event", B.RECENCY, when_null=B.RECENCY_NULL),
    }


def commercial_subscores() -> dict[str, Column]:
    return {
        "renewal_urgency_score": band("days_to_renewal", B.RENEWAL_URGENCY),
        "seat_utilization_score": band("seat_contracted_ratio", B.SEAT_UTILIZATION),
        "payment_failure_score": F.when(
            F.col("had_payment_failure_30d"), F.lit(B.PAYMENT_FAILURE_POINTS)
        ).otherwise(F.lit(0)),
        "downgrade_score": F.when(F.col("had_downgrade_90d"), F.lit(B.DOWNGRADE_POINTS)).otherwise(
            F.lit(0)
        ),
    }


def support_subscores() -> dict[str, Column]:
    return {
        "critical_ticket_score": band("p1_p2_tickets_30d", B.CRITICAL_TICKETS),
        "open_ticket_score": band("open_tickets_count", B.OPEN_TICKETS),
        "resolution_time_score": band(
            "avg_ticket_resolution_days", B.RESOLUTION_DAYS, when_null=B.RESOLUTION_NULL
        ),
    }


USAGE_SUBSCORES = ["usage_trend_score", "active_user_score", "feature_breadth_score", "recency_score"]
COMMERCIAL_SUBSCORES = [
    "renewal_urgency_score", "seat_utilization_score", "payment_failure_score", "downgrade_score",
]
SUPPORT_SUBSCORES = ["critical_ticket_score", "open_ticket_score", "resolution_time_score"]


def _mean(cols: list[str]) -> Column:
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return round_half_up(total / F.lit(float(len(cols))), 2, nonneg=True)


def subscores(features: DataFrame) -> DataFrame:
    """Features plus the eleven banded signal scores (ints 0..100)."""
    return features.withColumns(
        {**usage_subscores(), **commercial_subscores(), **support_subscores()}
    )


def components(scored: DataFrame) -> DataFrame:
    """SCR12: the three component means, rounded to 2 decimals."""
    return scored.withColumns(
        {
            "usage_score": _mean(USAGE_SUBSCORES),
            "commercial_score": _mean(COMMERCIAL_SUBSCORES),
            "support_score": _mean(SUPPORT_SUBSCORES),
        }
    )


def risk_score_col(s: Settings) -> Column:
    w = s.weights
    raw = (
        F.col("usage_score") * w.usage
        + F.col("commercial_score") * w.commercial
        + F.col("support_score") * w.support
    )
    return round_half_up(raw, 2, nonneg=True)


def tier_col(score: Column, s: Settings) -> Column:
    """SCR14: closed-below thresholds."""
    return (
        F.when(score >= s.tier_high, "HIGH").when(score >= s.tier_medium, "MEDIUM").otherwise("LOW")
    )


def risk_scores(features: DataFrame, s: Settings, stamp: bool = True) -> DataFrame:
    """mart_churn_risk_scores: one row per account (unordered; see `ranked`)."""
    comp = components(subscores(features)).withColumn("risk_score", risk_score_col(s))
    out = comp.withColumns(
        {"risk_tier": tier_col(F.col("risk_score"), s), "scored_week": F.col("feature_week")}
    )
    if stamp:
        return out.select(*s.keys(), *SCORE_COLUMNS, s.run_ts_col().alias("scored_at"))
    return out.select(*s.keys(), *SCORE_COLUMNS)


def in_order(scores: DataFrame) -> Ordered:
    """ORD1 with places: rank, quantiles and pages over all accounts."""
    return ordered(scores, F.desc("risk_score"), F.asc("account_id"))


def ranked(scores: DataFrame) -> DataFrame:
    """ORD1: read-time order, highest risk first, account_id as the tie-break."""
    return scores.orderBy(F.col("risk_score").desc(), F.col("account_id"))


#: the feature columns that the rule scores read
RULE_INPUTS = [
    "usage_trend_pct", "active_user_ratio", "wau", "distinct_features_used", "days_since_last_event", "days_to_renewal",
    "seat_contracted_ratio", "had_payment_failure_30d", "had_downgrade_90d", "p1_p2_tickets_30d", "open_tickets_count", "avg_ticket_resolution_days",
]
