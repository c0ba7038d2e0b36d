"""Reporting frames (RPT1-7, AGG8-10): the data behind the digest and the dashboard.

All are DataFrames; nothing is collected. Global aggregates produce one row, the
per-priority groups collect at most the alerts of one priority (bounded by the
alert scope, see digest_groups).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import bands as B


def _tiers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, i) for i, t in enumerate(B.TIERS)], "risk_tier string, ord int")


def tier_counts(scores: DataFrame, tier_col: str = "risk_tier") -> DataFrame:
    """AGG8: accounts per tier, all three tiers present (zero-filled)."""
    counts = scores.groupBy(F.col(tier_col).alias("risk_tier")).agg(
        F.count(F.lit(1)).alias("n_accounts")
    )
    tiers = _tiers(scores.sparkSession).select("risk_tier")
    # counts holds at most one row per tier value (three), a proven broadcast bound
    return tiers.join(F.broadcast(counts), "risk_tier", "left").select(
        "risk_tier", F.coalesce("n_accounts", F.lit(0).cast("bigint")).alias("n_accounts")
    )


from riskweave.config import Settings  # noqa: E402
from riskweave.functions.exprs import py_round  # noqa: E402

# FIXED VALUES: digest labels per alert priority, and the texts of the digest below
DIGEST_LABELS = {
    1: ":rotating_light: CRITICAL",
    2: ":warning: URGENT",
    3: ":red_circle: HIGH",
    4: ":large_yellow_circle: WATCH",
}
NO_ALERTS_TEXT = "No accounts require attention this week."


def _label(mapping: dict, col: str) -> F.Column:
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(col) == k, v) if out is None else out.when(F.col(col) == k, v)
    return out.otherwise(F.concat(F.lit("Priority "), F.col(col).cast("string")))


def kpis(scores: DataFrame, alerts: DataFrame) -> DataFrame:
    """RPT1 (AGG8 + AGG9) in one aggregate: alerted accounts are marked by a key join
    (one row per account on both sides), so no cross join of one-row frames is needed."""
    flag = alerts.select("account_id", F.lit(True).alias("__alert"))
    j = scores.join(flag, "account_id", "left")
    alerted = F.coalesce(F.col("__alert"), F.lit(False))
    tier = F.col("risk_tier")
    return j.agg(
        F.max("scored_week").alias("scored_week"),
        F.count_if(alerted).alias("alert_count"),
        F.coalesce(F.sum(F.when(alerted, F.col("mrr"))), F.lit(0.0)).alias("mrr_at_risk"),
        F.count_if(tier == "HIGH").alias("high_count"),
        F.count_if(tier == "MEDIUM").alias("medium_count"),
        F.count_if(tier == "LOW").alias("low_count"),
        F.coalesce(F.avg("risk_score"), F.lit(0.0)).alias("avg_score"),
        F.count(F.lit(1)).alias("total_count"),
    )


def priority_queue(scores: DataFrame, alerts: DataFrame) -> DataFrame:
    """RPT2 (JN10): scored accounts that carry an alert, with the alert's routing fields.
    Unordered; read with `.orderBy("alert_priority", desc("risk_score"), "account_id")`."""
    a = alerts.select(
        "account_id", "alert_priority", "top_risk_driver", "consecutive_high_weeks", "first_alerted_at"
    )
    return scores.join(a, "account_id", "inner").select(
        "account_id",
        "alert_priority",
        _label({k: v.split(" ")[-1] for k, v in DIGEST_LABELS.items()}, "alert_priority").alias(
            "priority_label"
        ),
        "plan_name",
        "mrr",
        "days_to_renewal",
        "risk_score",
        "risk_tier",
        "top_risk_driver",
        "usage_score",
        "commercial_score",
        "support_score",
        "usage_trend_pct",
        "active_user_ratio",
        "consecutive_high_weeks",
        "first_alerted_at",
    )


def bubble_points(scores: DataFrame) -> DataFrame:
    """RPT3: renewal x score scatter; radius = min(max(round(sqrt(mrr/400), 1), 4), 22)."""
    r = py_round(F.sqrt(F.col("mrr") / 400.0), 1)
    return scores.select(
        "account_id",
        F.col("days_to_renewal").alias("days"),
        py_round("risk_score", 1).alias("score"),
        F.col("risk_tier").alias("tier"),
        "mrr",
        F.least(F.greatest(r, F.lit(4.0)), F.lit(22.0)).alias("radius"),
    )


def component_share(scores: DataFrame) -> DataFrame:
    """RPT4: each component's share of u + c + s in percent (divisor at least 1)."""
    u, c, s = F.col("usage_score"), F.col("commercial_score"), F.col("support_score")
    total = F.greatest(u + c + s, F.lit(1.0))
    return scores.select(
        "account_id",
        (u / total * 100.0).alias("usage_share"),
        (c / total * 100.0).alias("commercial_share"),
        (s / total * 100.0).alias("support_share"),
    )


def as_json_records(df: DataFrame, name: str = "json") -> DataFrame:
    """FN19: each row as one JSON object (the payload format of the digest and the
    dashboard data), produced per row on the executors."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def _fmt0(x: F.Column) -> F.Column:
    return F.format_string("%.0f", py_round(x, 0))


def display_buckets(scores: DataFrame) -> DataFrame:
    """RPT5: dashboard text and classes for MRR, trend, utilisation and renewal urgency."""
    mrr = F.col("mrr")
    mrr_text = F.when(
        mrr >= 1000, F.format_string("$%.1fK", py_round(mrr / 1000.0, 1))
    ).otherwise(F.concat(F.lit("$"), mrr.cast("string")))
    pct = F.col("usage_trend_pct") * 100.0
    trend_class = (
        F.when(F.col("usage_trend_pct").isNull(), "muted")
        .when(pct > 0, "trend-up")
        .when(pct < -10, "trend-down")
        .otherwise("muted")
    )
    trend_text = F.when(F.col("usage_trend_pct").isNull(), "—").otherwise(
        F.concat(F.when(pct > 0, "↑").otherwise("↓"), F.lit(" "), _fmt0(F.abs(pct)), F.lit("%"))
    )
    util = F.col("active_user_ratio") * 100.0
    util_class = (
        F.when(util.isNull(), "muted")
        .when(util >= 60, "trend-up")
        .when(util < 25, "trend-down")
        .otherwise("muted-light")
    )
    util_text = F.when(util.isNull(), "—").otherwise(F.concat(_fmt0(util), F.lit("%")))
    return scores.select(
        "account_id",
        mrr_text.alias("mrr_text"),
        trend_class.alias("trend_class"),
        trend_text.alias("trend_text"),
        util_class.alias("util_class"),
        util_text.alias("util_text"),
        (F.col("days_to_renewal") <= 30).alias("renewal_urgent"),
    )


def digest_lines(alerts: DataFrame) -> DataFrame:
    """RPT6: one digest line per alert (rows, never one concatenated string)."""
    trend = F.when(F.col("usage_trend_pct").isNull(), "n/a").otherwise(
        F.concat(F.format_string("%+.0f", py_round(F.col("usage_trend_pct") * 100.0, 0)), F.lit("%"))
    )
    util = F.when(F.col("active_user_ratio").isNull(), "n/a").otherwise(
        F.concat(_fmt0(F.col("active_user_ratio") * 100.0), F.lit("%"))
    )
    p12 = F.col("p1_p2_tickets_30d")
    flags = F.concat_ws(
        ", ",
        F.when(F.col("had_payment_failure_30d"), F.lit("payment fail")),
        F.when(p12 > 0, F.concat(p12.cast("string"), F.lit(" P1/P2 tickets"))),
    )
    flag_str = F.when(flags != "", F.concat(F.lit(" | "), flags)).otherwise(F.lit(""))
    mrr = F.regexp_replace(F.format_number(py_round("mrr", 0), 0), r"\.0*$", "")
    line = F.concat(
        F.lit("  • *"), F.col("account_id"), F.lit("* ("), F.col("plan_name"),
        F.lit(", $"), mrr, F.lit(" MRR) — "),
        F.col("days_to_renewal").cast("string"), F.lit("d to renewal | score "),
        _fmt0(F.col("risk_score")), F.lit(" | driver: "), F.col("top_risk_driver"),
        F.lit(" | usage "), trend, F.lit(", util "), util, flag_str,
    )
    return alerts.select("alert_priority", "account_id", "risk_score", line.alias("line"))


def digest_groups(alerts: DataFrame) -> DataFrame:
    """RPT7: one header per priority with its label and count (AGG10 without collecting
    members; the lines stay rows in digest_lines)."""
    g = alerts.groupBy("alert_priority").agg(F.count(F.lit(1)).alias("n_accounts"))
    label = _label(DIGEST_LABELS, "alert_priority")
    n = F.col("n_accounts")
    header = F.concat(
        F.lit("*"), label, F.lit("* ("), n.cast("string"), F.lit(" account"),
        F.when(n > 1, "s").otherwise(""), F.lit(")"),
    )
    return g.select("alert_priority", label.alias("priority_label"), "n_accounts", header.alias("header"))


def digest_summary(alerts: DataFrame, s: Settings) -> DataFrame:
    """RPT7 envelope: title and the count sentence, or the empty-week message."""
    day = s.as_of_col().cast("string")
    n = F.count(F.lit(1))
    return alerts.agg(n.alias("n_alerts")).select(
        "n_alerts",
        F.when(
            F.col("n_alerts") == 0,
            F.concat(F.lit(":white_check_mark: *Churn Alert Digest — "), day, F.lit("*\n"), F.lit(NO_ALERTS_TEXT)),
        )
        .otherwise(
            F.concat(F.lit("*"), F.col("n_alerts").cast("string"), F.lit(" account(s)* require CSM attention this week."))
        )
        .alias("text"),
        F.concat(F.lit("⚠️ Churn Alert Digest — "), day).alias("title"),
    )
