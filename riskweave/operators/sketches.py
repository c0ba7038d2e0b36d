"""AGG1 with mergeable sketches: distinct users, sessions and features of any group of account
weeks, from stored sketches instead of events.

A sketch is a HyperLogLog of 2**lg_k registers, one per account, week and kind of value; its size
does not grow with the events. Merging sketches gives the sketch of the united events, so months,
portfolios or trailing windows never read events again. Estimates have a relative standard error
of about 1.04 / sqrt(2**lg_k), 1.6 % for lg_k 12; small counts are nearly exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.exprs import week_start

LG_K = 12
VALUES = {"users": "user_id", "sessions": "session_id", "features": "feature_name"}


def relative_error(lg_k: int = LG_K, sigmas: float = 3.0) -> float:
    """Bound of the relative error at so many standard errors."""
    return sigmas * 1.04 / 2 ** (lg_k / 2)


def weekly_sketches(events: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Per account and week: event_count, last_event_ts and a sketch of each kind. A user, session
    or feature counts per account, so the account is part of the sketched value."""
    own = lambda c: F.concat_ws("|", "account_id", F.col(c))
    return events.groupBy("account_id", week_start("event_ts").alias("week_start")).agg(
        F.count(F.lit(1)).alias("event_count"), F.max("event_ts").alias("last_event_ts"),
        *(F.hll_sketch_agg(F.when(F.col(c).isNotNull(), own(c)), lg_k).alias(f"{name}_sketch") for name, c in VALUES.items()),
    )


def merged(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Sketches of groups of account weeks; by: columns or expressions."""
    return sketches.groupBy(*by).agg(
        F.sum("event_count").alias("event_count"), F.max("last_event_ts").alias("last_event_ts"),
        *(F.hll_union_agg(f"{name}_sketch").alias(f"{name}_sketch") for name in VALUES),
    )


def estimated(sketches: DataFrame, names: Sequence[str] = tuple(VALUES)) -> DataFrame:
    """Sketch columns replaced by their estimates."""
    keep = [c for c in sketches.columns if not c.endswith("_sketch")]
    return sketches.select(*keep, *(F.hll_sketch_estimate(f"{n}_sketch").alias(n) for n in names))


__all__ = ["LG_K", "relative_error", "weekly_sketches", "merged", "estimated"]
