"""Run settings shared by every operator.

Every "now" of the reference (current_date, current_timestamp) is an explicit
parameter here so that any week can be reproduced or backfilled.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Weights:
    usage: float = 0.45
    commercial: float = 0.30
    support: float = 0.25


@dataclass(frozen=True)
class Settings:
    """Parameters of one scoring run.

    as_of        scoring date; None means the session's current_date().
    run_ts       audit timestamp stamped on outputs; None means current_timestamp().
    spine_weeks  weeks of dense account x week history (current week included).
    lookback_weeks  incremental recompute window for weekly usage.
    bound_future if True every dated source is limited to event_ts < as_of + 1 day,
                 which a backfill needs; False reproduces the lower-bound-only filters.
    """

    as_of: dt.date | None = None
    run_ts: dt.datetime | None = None
    spine_weeks: int = 12
    lookback_weeks: int = 13
    recent_days: int = 30
    downgrade_days: int = 90
    renewal_window_days: int = 90
    low_utilization: float = 0.25
    tier_high: float = 70.0
    tier_medium: float = 40.0
    weights: Weights = field(default_factory=Weights)
    bound_future: bool = False
    # multi-run mode: several as_of dates in one plan, the run date carried as a column
    run_col: str | None = None
    run_dates: tuple[dt.date, ...] = ()
    bounded_dates: tuple[dt.date, ...] = ()

    @classmethod
    def runs(
        cls, dates, bounded=(), run_col: str = "run_as_of", base: "Settings | None" = None
    ) -> "Settings":
        """Settings for a multi-run plan over `dates` (bounded ones see no later events)."""
        base = base or cls()
        return replace(
            base, as_of=None, run_col=run_col, run_dates=tuple(sorted(dates)),
            bounded_dates=tuple(sorted(bounded)), bound_future=False,
        )

    def keys(self, *cols: str) -> list[str]:
        """Grouping / join keys: the run column (multi-run mode) plus `cols`."""
        return ([self.run_col] if self.run_col else []) + list(cols)

    def tag_runs(self, df, ts_col: str | None = None, window_days: int | None = None):
        """Multi-run mode: one copy of each row per run that can see it: the row is not after
        the end of a bounded run and, with a trailing window, not before it. A copy is made only
        for those runs, so with a window the fan-out is the number of overlapping windows."""
        if not self.run_col:
            return df
        runs = F.array(*[F.lit(d) for d in self.run_dates])
        if ts_col is not None:
            ts = F.col(ts_col)
            bounded = F.array(*[F.lit(d) for d in self.bounded_dates]).cast("array<date>")
            if self.bounded_dates:
                runs = F.filter(
                    runs,
                    lambda r: ~F.array_contains(bounded, r) | (ts < F.date_add(r, 1).cast("timestamp_ntz")),
                )
            if window_days is not None:
                runs = F.filter(runs, lambda r: ts >= F.date_sub(r, window_days).cast("timestamp_ntz"))
        return df.withColumn(self.run_col, F.explode(runs))

    # -- Column views of the clock ------------------------------------------------
    def as_of_col(self) -> Column:
        if self.run_col:
            return F.col(self.run_col)
        return F.lit(self.as_of) if self.as_of is not None else F.current_date()

    def run_ts_col(self) -> Column:
        if self.run_ts is not None:
            return F.lit(self.run_ts).cast("timestamp")
        return F.current_timestamp()

    def monday_col(self) -> Column:
        """Monday of the as_of week."""
        return F.trunc(self.as_of_col(), "week")

    def days_back_ts(self, days: int) -> Column:
        """Midnight `days` before as_of, as timestamp_ntz (date - interval in SQL)."""
        return F.date_sub(self.as_of_col(), days).cast("timestamp_ntz")

    def first_day_back(self, days: int) -> Column:
        """Midnight `days` before the earliest run: a literal bound for the scan."""
        if self.run_col:
            return F.lit(min(self.run_dates) - dt.timedelta(days=days)).cast("timestamp_ntz")
        return self.days_back_ts(days)

    def upper_ts(self) -> Column | None:
        """Exclusive upper bound for dated sources, or None when unbounded (in multi-run
        mode NULL for the runs that are not bounded)."""
        if self.run_col:
            if not self.bounded_dates:
                return None
            run = F.col(self.run_col)
            return F.when(
                run.isin([F.lit(d) for d in self.bounded_dates]),
                F.date_add(run, 1).cast("timestamp_ntz"),
            )
        if not self.bound_future:
            return None
        return F.date_add(self.as_of_col(), 1).cast("timestamp_ntz")

    def below_upper(self, ts: Column) -> Column | None:
        """Predicate keeping rows before the upper bound, or None when nothing is bounded."""
        upper = self.upper_ts()
        if upper is None:
            return None
        return (upper.isNull() | (ts < upper)) if self.run_col else ts < upper

    def spine_bounds(self, weeks: int) -> tuple[Column, Column]:
        """Literal [first spine Monday, end of last spine week) over every run, so the
        event range filter reaches the scan even in multi-run mode."""
        if self.run_col:
            mondays = [d - dt.timedelta(days=d.weekday()) for d in self.run_dates]
            lo = min(mondays) - dt.timedelta(days=7 * (weeks - 1))
            hi = max(mondays) + dt.timedelta(days=7)
            return F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")
        lo = F.date_sub(self.monday_col(), 7 * (weeks - 1)).cast("timestamp_ntz")
        hi = F.date_add(self.monday_col(), 7).cast("timestamp_ntz")
        return lo, hi
