"""Account x week usage history: spine (JN1), weekly aggregate (AGG1), dense join (JN2/JN3),
rolling windows (WIN1-4).

Plan shape: the spine is a Generate over the account scan (no shuffle, no nested-loop
join). The weekly aggregate has three exact distinct counts: the events are shuffled once,
by (account, week), and become one row per counted value only behind that shuffle, so
no copy of an event is ever shuffled and both aggregates stay in their tasks; these are
hash aggregates that spill, so a group of any size is held by none. A hot account spreads
over tasks by its weeks. The windows share one partitioning (account_id) and one sort.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.config import Settings
from riskweave.functions.exprs import day_diff, round_half_up, week_start

ACTIVITY_COLUMNS = [
    "account_id",
    "week_start",
    "week_end",
    "wau",
    "session_count",
    "event_count",
    "distinct_features_used",
    "last_event_ts",
    "seats_contracted",
    "active_user_ratio",
    "days_since_last_event",
    "mrr",
    "plan_name",
    "renewal_date",
    "days_to_renewal",
    "wau_rolling_4w",
    "wau_rolling_prev_4w",
    "wau_wow_delta",
    "usage_trend_pct",
]


def week_spine(accounts: DataFrame, s: Settings, carry: bool = True) -> DataFrame:
    """Active accounts x the last `spine_weeks` Mondays (current week included).

    With carry=True the account attributes used downstream ride along, which replaces
    the second account join of the SQL formulation (account_id is unique).
    """
    cols = s.keys("account_id")
    if carry:
        cols += ["seats_contracted", "mrr", "plan_name", "renewal_date"]
    n = F.explode(F.sequence(F.lit(0), F.lit(s.spine_weeks - 1))).alias("n")
    return (
        accounts.where(F.col("is_active"))
        .select(*cols, n)
        .select(*cols, F.date_sub(s.monday_col(), F.col("n") * 7).alias("week_start"))
    )


def spine_window(events: DataFrame, s: Settings, weeks: int | None = None) -> DataFrame:
    """Events that can land in the spine (or the lookback); the bare event_ts comparison
    reaches the Parquet scan as a pushed filter."""
    weeks = s.spine_weeks if weeks is None else weeks
    lo, hi = s.spine_bounds(weeks)
    out = events.where((F.col("event_ts") >= lo) & (F.col("event_ts") < hi))
    if s.run_col:  # bounded runs get their partial current week from partial_current_week
        return out
    keep = s.below_upper(F.col("event_ts"))
    return out.where(keep) if keep is not None else out


def lookback_window(events: DataFrame, s: Settings) -> DataFrame:
    """FLT2: incremental-run filter event_ts >= Monday - lookback_weeks."""
    lo = F.date_sub(s.monday_col(), 7 * s.lookback_weeks).cast("timestamp_ntz")
    out = events.where(F.col("event_ts") >= lo)
    keep = s.below_upper(F.col("event_ts"))
    return out.where(keep) if keep is not None else out


USAGE_COLUMNS = ["wau", "session_count", "event_count", "distinct_features_used", "last_event_ts"]


def partial_current_week(events: DataFrame, s: Settings) -> DataFrame | None:
    """Multi-run mode: usage of each bounded run's own week up to its as_of (the only
    week whose aggregate differs between runs). Each event belongs to at most the
    bounded runs of its own week, so the fan-out is tiny."""
    if not (s.run_col and s.bounded_dates):
        return None
    ts = F.col("event_ts")
    runs = F.array(*[F.lit(d) for d in s.bounded_dates])
    mine = F.filter(
        runs,
        lambda r: (ts >= F.trunc(r, "week").cast("timestamp_ntz"))
        & (ts < F.date_add(r, 1).cast("timestamp_ntz")),
    )
    lo = min(d - dt.timedelta(days=d.weekday()) for d in s.bounded_dates)
    hi = max(s.bounded_dates) + dt.timedelta(days=1)
    ev = events.where((ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz")))
    tagged = ev.withColumn(s.run_col, F.explode(mine))
    return weekly_usage(tagged, keys=[s.run_col])


def weekly_usage(events: DataFrame, approx: bool = False, keys: list[str] | None = None) -> DataFrame:
    """AGG1: per (account, Monday) distinct users/sessions/features, events, last event.

    approx=True swaps the exact distinct counts for HyperLogLog++ (rsd 1%), which are combined
    before the shuffle, so no event is shuffled at all.
    """
    by = [*(keys or []), "account_id", "week_start"]
    distinct = {"user_id": "wau", "session_id": "session_count", "feature_name": "distinct_features_used"}
    ev = events.withColumn("week_start", week_start("event_ts")).select(*by, *distinct, "event_ts")
    if approx:
        counts = {name: F.approx_count_distinct(c, 0.01) for c, name in distinct.items()}
        n_events, last = F.count(F.lit(1)), F.max("event_ts")
    else:
        # one row per event and kind; those of the last kind carry the event and its time
        *others, carrier = distinct
        none = (F.lit(None).cast("long").alias("n"), F.lit(None).cast("timestamp_ntz").alias("last_ts"))
        kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("value"), *none) for c in others]
        kinds.append(F.struct(F.lit(carrier).alias("kind"), F.col(carrier).alias("value"), F.lit(1).cast("long").alias("n"), F.col("event_ts").alias("last_ts")))
        ev = ev.repartition(*by).select(*by, F.inline(F.array(*kinds)))
        ev = ev.groupBy(*by, "kind", "value").agg(F.sum("n").alias("n"), F.max("last_ts").alias("last_ts"))
        counts = {name: F.count_if((F.col("kind") == c) & F.col("value").isNotNull()) for c, name in distinct.items()}
        n_events, last = F.sum("n"), F.max("last_ts")
    return ev.groupBy(*by).agg(
        *(counts[c].alias(c) for c in ("wau", "session_count")),
        n_events.alias("event_count"),
        counts["distinct_features_used"].alias("distinct_features_used"),
        last.alias("last_event_ts"),
    )


def dense_activity(
    spine: DataFrame, usage: DataFrame, s: Settings | None = None, partial: DataFrame | None = None
) -> DataFrame:
    """JN2 + derived per-week columns, before the windows.

    partial: multi-run mode, the bounded runs' current-week usage, which replaces the
    shared full-week values on those (run, account, current week) rows."""
    j = spine.join(usage, ["account_id", "week_start"], "left")
    if partial is not None:
        p = partial.select(
            *s.keys("account_id"), "week_start", *[F.col(c).alias(f"__p_{c}") for c in USAGE_COLUMNS]
        )
        j = j.join(p, s.keys("account_id", "week_start"), "left")
        run = F.col(s.run_col)
        use_p = (F.col("week_start") == F.trunc(run, "week")) & run.isin(
            [F.lit(d) for d in s.bounded_dates]
        )
        j = j.withColumns({c: F.when(use_p, F.col(f"__p_{c}")).otherwise(F.col(c)) for c in USAGE_COLUMNS})
    keys = s.keys() if s is not None else []
    week_end = F.date_add("week_start", 6)
    wau = F.coalesce("wau", F.lit(0).cast("bigint"))
    seats = F.col("seats_contracted")
    return j.select(
        *keys,
        "account_id",
        "week_start",
        week_end.alias("week_end"),
        wau.alias("wau"),
        F.coalesce("session_count", F.lit(0).cast("bigint")).alias("session_count"),
        F.coalesce("event_count", F.lit(0).cast("bigint")).alias("event_count"),
        F.coalesce("distinct_features_used", F.lit(0).cast("bigint")).alias(
            "distinct_features_used"
        ),
        "last_event_ts",
        "seats_contracted",
        F.when(seats > 0, round_half_up(wau / seats, 4)).alias("active_user_ratio"),
        day_diff("last_event_ts", week_end).alias("days_since_last_event"),
        "mrr",
        "plan_name",
        "renewal_date",
        day_diff(week_end, "renewal_date").alias("days_to_renewal"),
    )


def with_trends(activity: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """WIN1-4 over one window spec (one sort per account partition)."""
    w = Window.partitionBy(*(keys or ["account_id"])).orderBy("week_start")
    cur = F.avg("wau").over(w.rowsBetween(-3, 0))
    prev = F.avg("wau").over(w.rowsBetween(-7, -4))
    out = activity.select(
        "*",
        cur.alias("wau_rolling_4w"),
        prev.alias("wau_rolling_prev_4w"),
        (F.col("wau") - F.lag("wau", 1).over(w)).alias("wau_wow_delta"),
    )
    r4, p4 = F.col("wau_rolling_4w"), F.col("wau_rolling_prev_4w")
    trend = F.when(p4 != 0, round_half_up((r4 - p4) / p4, 4))
    return out.withColumn("usage_trend_pct", trend)


def activity_weekly(
    accounts: DataFrame,
    events: DataFrame,
    s: Settings,
    incremental: bool = False,
    approx: bool = False,
    stamp: bool = True,
) -> DataFrame:
    """int_account_activity_weekly for the spine weeks of `s.as_of`.

    Events outside the spine can never join a spine week, so the scan is limited to
    the spine window (or the 13-week lookback for incremental runs).
    """
    window = lookback_window(events, s) if incremental else spine_window(events, s)
    usage = weekly_usage(window, approx=approx)
    dense = dense_activity(week_spine(accounts, s), usage, s, partial_current_week(events, s))
    out = with_trends(dense, s.keys("account_id")).select(*s.keys(), *ACTIVITY_COLUMNS)
    if stamp:
        out = out.withColumn("updated_at", s.run_ts_col())
    return out
