"""int_churn_features (PRJ7, PRJ10, JN6, FLT4): the current-week feature row per account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.config import Settings

FEATURE_COLUMNS = [
    "account_id",
    "feature_week",
    "wau",
    "wau_rolling_4w",
    "wau_rolling_prev_4w",
    "wau_wow_delta",
    "usage_trend_pct",
    "active_user_ratio",
    "distinct_features_used",
    "days_since_last_event",
    "mrr",
    "plan_name",
    "renewal_date",
    "days_to_renewal",
    "seats_contracted",
    "seat_contracted_ratio",
    "had_payment_failure_30d",
    "had_downgrade_90d",
    "open_tickets_count",
    "p1_p2_tickets_30d",
    "avg_ticket_resolution_days",
    "is_in_renewal_window",
    "is_zero_usage_week",
    "is_low_utilization",
]


def churn_features(
    activity: DataFrame,
    support: DataFrame,
    billing: DataFrame,
    s: Settings,
    week_col: str | None = None,
) -> DataFrame:
    """Join the three signal layers on account_id for the as_of week.

    week_col: pass a column name to keep every week of `activity` instead of filtering
    to the current one (used to build multi-week training snapshots).
    """
    a = activity if week_col else activity.where(F.col("week_start") == s.monday_col())
    keys = s.keys("account_id")
    j = a.join(support, keys, "left").join(billing, keys, "left")
    return j.select(
        *keys,
        F.col("week_start").alias("feature_week"),
        *FEATURE_COLUMNS[2:21],
        F.col("days_to_renewal").between(0, s.renewal_window_days).alias("is_in_renewal_window"),
        (F.col("wau") == 0).alias("is_zero_usage_week"),
        (F.col("active_user_ratio") < s.low_utilization).alias("is_low_utilization"),
    )
