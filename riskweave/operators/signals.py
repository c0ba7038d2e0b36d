"""Per-account support (AGG4/AGG5, JN4) and billing (AGG2/AGG3, JN5) signals.

Each aggregate is decomposable (count_if, bool_or, avg) or a single distinct count, so
Spark combines map-side before the account_id shuffle; a hot account therefore costs one
partial row per task, not its raw rows. The account joins then co-partition on account_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.config import Settings
from riskweave.functions.exprs import day_diff, round_half_up


def _bounded(df: DataFrame, ts: str, s: Settings) -> DataFrame:
    keep = s.below_upper(F.col(ts))
    return df.where(keep) if keep is not None else df


def ticket_aggregate(tickets: DataFrame, s: Settings) -> DataFrame:
    """Counts and mean resolution per account. Tickets are summed per account and day first;
    only these sums are copied to the runs that see the day, not the tickets."""
    resolution = F.when(F.col("resolved_at").isNotNull(), day_diff("created_at", "resolved_at"))
    daily = tickets.groupBy("account_id", F.to_date("created_at").cast("timestamp_ntz").alias("day")).agg(
        F.count_if(F.col("status") == "open").alias("n_open"),
        F.count_if(F.col("severity").isin("P1", "P2")).alias("n_urgent"),
        F.sum(resolution).alias("days"),
        F.count(resolution).alias("n_resolved"),
    )
    t = _bounded(s.tag_runs(daily, "day"), "day", s)
    recent = F.col("day") >= s.days_back_ts(s.recent_days)
    return t.groupBy(*s.keys("account_id")).agg(
        F.sum("n_open").alias("open_tickets_count"),
        F.sum(F.when(recent, F.col("n_urgent")).otherwise(0)).alias("p1_p2_tickets_30d"),
        (F.sum("days") / F.nullif(F.sum("n_resolved"), F.lit(0))).alias("avg_ticket_resolution_days"),
    )


def support_signals(accounts: DataFrame, tickets: DataFrame, s: Settings) -> DataFrame:
    """int_account_support_signals: every account, zero-filled counts."""
    agg = ticket_aggregate(tickets, s)
    return (
        accounts.select(*s.keys("account_id"))
        .join(agg, s.keys("account_id"), "left")
        .select(
            *s.keys("account_id"),
            "avg_ticket_resolution_days",
            F.coalesce("open_tickets_count", F.lit(0).cast("bigint")).alias("open_tickets_count"),
            F.coalesce("p1_p2_tickets_30d", F.lit(0).cast("bigint")).alias("p1_p2_tickets_30d"),
        )
    )


def active_users_30d(events: DataFrame, s: Settings) -> DataFrame:
    """AGG2: distinct users with an event in the trailing window (pushed-down filter)."""
    ev = events.where(F.col("event_ts") >= s.first_day_back(s.recent_days))
    if s.run_col:
        return active_users_by_run(ev, s)
    return _bounded(ev, "event_ts", s).groupBy("account_id").agg(F.countDistinct("user_id").alias("active_users_30d"))


def active_users_by_run(events: DataFrame, s: Settings) -> DataFrame:
    """AGG2 for many runs by a sweep over the runs, without a row per event and run.

    The runs stand in a list, bounded ones first. The runs that see an event day in their trailing
    window are one interval of the bounded runs and one of the others. Of a user's intervals only
    the part that no earlier interval covers is kept, so the pieces are disjoint; each adds one at
    its first run and takes it away behind its last. An account's running sum over the runs is its
    number of active users; runs without any have no row."""
    runs = [*s.bounded_dates, *(d for d in s.run_dates if d not in s.bounded_dates)]
    n_bounded = len(s.bounded_dates)
    days = events.select("account_id", "user_id", F.col("event_ts").cast("date").alias("day")).distinct()

    def before(dates, limit) -> Column:
        """How many of the dates are before the limit."""
        return sum((F.when(F.lit(d) < limit, 1).otherwise(0) for d in dates), F.lit(0))

    last_seen = F.date_add("day", s.recent_days + 1)
    bounded = F.struct(before(runs[:n_bounded], F.col("day")).alias("lo"), (before(runs[:n_bounded], last_seen) - 1).alias("hi"))
    free = F.struct(F.lit(n_bounded).alias("lo"), (before(runs[n_bounded:], last_seen) + n_bounded - 1).alias("hi"))
    spans = days.select("account_id", "user_id", F.inline(F.filter(F.array(bounded, free), lambda x: x.lo <= x.hi))).distinct()
    earlier = Window.partitionBy("account_id", "user_id").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    piece = spans.withColumn("covered", F.max("hi").over(earlier)).withColumn("lo", F.greatest("lo", F.col("covered") + 1)).where("lo <= hi")
    steps = piece.select("account_id", F.inline(F.array(F.struct(F.col("lo").alias("run"), F.lit(1).alias("step")), F.struct((F.col("hi") + 1).alias("run"), F.lit(-1).alias("step")))))
    # every run of an account that has a piece, so the running sum has a row for it
    every = steps.select("account_id").distinct().select("account_id", F.explode(F.sequence(F.lit(0), F.lit(len(runs) - 1))).alias("run"), F.lit(0).alias("step"))
    change = steps.union(every).groupBy("account_id", "run").agg(F.sum("step").alias("step"))
    users = F.sum("step").over(Window.partitionBy("account_id").orderBy("run"))
    date_of = F.array(*(F.lit(d) for d in runs))[F.col("run")]
    return (
        change.withColumn("active_users_30d", users).where((F.col("active_users_30d") > 0) & (F.col("run") < len(runs)))
        .select(date_of.alias(s.run_col), "account_id", "active_users_30d")
    )


def billing_aggregate(billing: DataFrame, s: Settings) -> DataFrame:
    """Flags of the two kinds of event that set one, within the longer of their windows; an
    account without such an event has no row."""
    longest = max(s.recent_days, s.downgrade_days)
    b = billing.where(
        F.col("event_type").isin("payment_failure", "downgrade")
        & (F.col("event_ts") >= s.first_day_back(longest))
    )
    b = _bounded(s.tag_runs(b, "event_ts", longest), "event_ts", s)
    ts = F.col("event_ts")
    kind = F.col("event_type")
    return b.groupBy(*s.keys("account_id")).agg(
        F.bool_or((kind == "payment_failure") & (ts >= s.days_back_ts(s.recent_days))).alias(
            "had_payment_failure_30d"
        ),
        F.bool_or((kind == "downgrade") & (ts >= s.days_back_ts(s.downgrade_days))).alias(
            "had_downgrade_90d"
        ),
    )


def billing_signals(
    accounts: DataFrame, billing: DataFrame, events: DataFrame, s: Settings
) -> DataFrame:
    """int_account_billing_signals: flags plus active-user / contracted-seat ratio."""
    seats = F.col("seats_contracted")
    users = F.coalesce("active_users_30d", F.lit(0).cast("bigint"))
    keys = s.keys("account_id")
    return (
        accounts.select(*keys, "seats_contracted")
        .join(billing_aggregate(billing, s), keys, "left")
        .join(active_users_30d(events, s), keys, "left")
        .select(
            *keys,
            F.coalesce("had_payment_failure_30d", F.lit(False)).alias("had_payment_failure_30d"),
            F.coalesce("had_downgrade_90d", F.lit(False)).alias("had_downgrade_90d"),
            F.when(seats > 0, round_half_up(users / seats, 4)).alias("seat_contracted_ratio"),
        )
    )
