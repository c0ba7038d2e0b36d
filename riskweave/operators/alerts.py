"""mart_churn_alerts (SCR15, SCR16, FLT5, JN8): accounts needing action this week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.config import Settings
from riskweave.functions import bands as B
from riskweave.operators.history import alert_history
from riskweave.operators import ranking

ALERT_COLUMNS = [
    "account_id",
    "scored_week",
    "plan_name",
    "mrr",
    "renewal_date",
    "days_to_renewal",
    "is_in_renewal_window",
    "risk_score",
    "risk_tier",
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
    "first_alerted_at",
    "alert_priority",
    "top_risk_driver",
    "consecutive_high_weeks",
]


def alert_priority() -> Column:
    """1 CRITICAL / 2 URGENT / 3 HIGH / 4 WATCH; NULL outside the alert scope."""
    tier, days = F.col("risk_tier"), F.col("days_to_renewal")
    crit, urgent = B.ALERT_PRIORITY_DAYS
    return (
        F.when((tier == "HIGH") & (days <= crit), 1)
        .when((tier == "HIGH") & (days <= urgent), 2)
        .when(tier == "HIGH", 3)
        .when((tier == "MEDIUM") & F.col("is_in_renewal_window"), 4)
    )


def top_risk_driver() -> Column:
    """Component equal to the row maximum; ties resolve usage > commercial > support."""
    top = F.greatest("usage_score", "commercial_score", "support_score")
    return (
        F.when(top == F.col("usage_score"), "usage")
        .when(top == F.col("commercial_score"), "commercial")
        .otherwise("support")
    )


def in_scope() -> Column:
    tier = F.col("risk_tier")
    return (tier == "HIGH") | ((tier == "MEDIUM") & F.col("is_in_renewal_window"))


def churn_alerts(
    scores: DataFrame, snapshot: DataFrame, s: Settings, stamp: bool = True
) -> DataFrame:
    """Scope filter first (it only reads score columns), then the history join."""
    hist = alert_history(snapshot, s.as_of_col())
    out = (
        scores.where(in_scope())
        .join(hist, "account_id", "left")
        .withColumns(
            {
                "alert_priority": alert_priority(),
                "top_risk_driver": top_risk_driver(),
                "consecutive_high_weeks": F.coalesce(
                    "consecutive_high_weeks", F.lit(0).cast("bigint")
                ),
            }
        )
        .select(*ALERT_COLUMNS)
    )
    return out.withColumn("alerted_at", s.run_ts_col()) if stamp else out


def _order() -> list[Column]:
    """ORD2: priority ascending, then highest risk, account_id as the tie-break."""
    return [F.asc("alert_priority"), F.desc("risk_score"), F.asc("account_id")]


def ordered(alerts: DataFrame) -> DataFrame:
    """The read-time order of a whole listing."""
    return alerts.orderBy(*_order())


def in_order(alerts: DataFrame) -> ranking.Ordered:
    """The same order with rank, quantiles and pages."""
    return ranking.ordered(alerts, *_order())
