"""SCD type 2 history of risk scores (SCD1-7).

Two equivalent forms:
  scd2_apply      one snapshot run against the stored history (check strategy on the
                  check columns, null-safe compare, hard deletes closed). Open rows and
                  the current frame meet in hash joins on the key.
  scd2_from_log   the batch form for backfills: a log of weekly score frames becomes
                  versions with lag/lead over (key ordered by snapshot time) - one
                  shuffle on the key, no self-join.
Folding scd2_apply over the snapshots in order equals scd2_from_log (tested).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.exprs import week_diff

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]
SNAPSHOT_COLUMNS = [
    "account_id",
    "scored_week",
    "plan_name",
    "mrr",
    "risk_tier",
    "risk_score",
    "usage_score",
    "commercial_score",
    "support_score",
]
CHECK_COLUMNS = ("risk_tier", "risk_score")


def scd_id(key: str, ts: Column) -> Column:
    """Surrogate version key: md5 of 'key|timestamp'."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), ts.cast("string")))


def _ts(ts) -> Column:
    """A zone-less timestamp; Python datetimes go through their text so the session
    time zone never shifts them."""
    if isinstance(ts, Column):
        return ts.cast("timestamp_ntz")
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def _open_versions(df: DataFrame, key: str, ts: Column) -> DataFrame:
    return df.select(
        "*",
        scd_id(key, ts).alias("dbt_scd_id"),
        ts.alias("dbt_updated_at"),
        ts.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def _changed(check_cols: Sequence[str], left: str, right: str) -> Column:
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}")) for c in check_cols],
    )
    return ~same


def scd2_apply(
    history: DataFrame | None,
    current: DataFrame,
    ts,
    key: str = "account_id",
    check_cols: Sequence[str] = CHECK_COLUMNS,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """One snapshot run: close changed/deleted open versions, open new ones."""
    ts = _ts(ts)
    if history is None:
        return _open_versions(current, key, ts)
    cols = current.columns
    closed = history.where(F.col("dbt_valid_to").isNotNull())
    open_ = history.where(F.col("dbt_valid_to").isNull())

    cur_keys = current.select(
        key, *[F.col(c).alias(f"__n_{c}") for c in check_cols], F.lit(True).alias("__present")
    )
    j = open_.join(cur_keys, key, "left")
    present = F.coalesce(F.col("__present"), F.lit(False))
    close_now = (present & _changed(check_cols, "", "__n_")) | (
        ~present if invalidate_hard_deletes else F.lit(False)
    )
    open_out = j.select(
        *cols,
        "dbt_scd_id",
        "dbt_updated_at",
        "dbt_valid_from",
        F.when(close_now, ts).otherwise(F.col("dbt_valid_to")).alias("dbt_valid_to"),
    )

    old_keys = open_.select(
        key, *[F.col(c).alias(f"__o_{c}") for c in check_cols], F.lit(True).alias("__had")
    )
    k = current.join(old_keys, key, "left")
    fresh = F.col("__had").isNull() | _changed(check_cols, "__o_", "")
    inserts = _open_versions(k.where(fresh).select(*cols), key, ts)
    return closed.unionByName(open_out).unionByName(inserts)


def scd2_from_log(
    log: DataFrame,
    ts_col: str = "snapshot_ts",
    key: str = "account_id",
    check_cols: Sequence[str] = CHECK_COLUMNS,
    invalidate_hard_deletes: bool = True,
    runs: DataFrame | None = None,
) -> DataFrame:
    """Batch SCD2 over a log of snapshot frames (one row per key per snapshot it was in).

    runs: optional one-column frame of every run's timestamp.
    A version starts when the key first appears, reappears after missing a snapshot
    (hard delete), or its check columns change. It ends at the next version's start,
    or at the first snapshot the key is absent from.
    """
    ts = F.col(ts_col).cast("timestamp_ntz")
    data_cols = [c for c in log.columns if c != ts_col]
    # the ordered list of snapshot runs (taken from the log unless given, e.g. when a run
    # saw no rows at all): one row per run, so this single-partition window sorts only
    # as many rows as there were runs
    if runs is None:
        runs = log.select(ts.alias("__ts")).distinct()
    else:
        runs = runs.select(F.col(runs.columns[0]).cast("timestamp_ntz").alias("__ts")).distinct()
    order = Window.orderBy("__ts")
    runs = runs.select(
        "__ts",
        F.lag("__ts").over(order).alias("__prev_run"),
        F.lead("__ts").over(order).alias("__next_run"),
    )
    w = Window.partitionBy(key).orderBy("__ts")
    x = log.select(*data_cols, ts.alias("__ts")).join(F.broadcast(runs), "__ts")
    lag_ts = F.lag("__ts").over(w)
    x = x.select(
        "*",
        lag_ts.alias("__lag_ts"),
        F.lead("__ts").over(w).alias("__lead_ts"),
        *[F.lag(c).over(w).alias(f"__p_{c}") for c in check_cols],
    )
    gap = F.col("__lag_ts") != F.col("__prev_run")
    starts = F.col("__lag_ts").isNull() | _changed(check_cols, "__p_", "")
    if invalidate_hard_deletes:
        starts = starts | gap
    x = x.withColumn("__starts", starts)
    if invalidate_hard_deletes:
        # a version ends at the run its key is first absent from, told by its last row
        ends = F.col("__lead_ts").isNull() | (F.col("__lead_ts") != F.col("__next_run"))
        x = x.withColumn("__ends", ends).where(F.col("__starts") | F.col("__ends"))
        after = F.when(F.lead("__starts").over(w), F.lead("__ts").over(w)).otherwise(F.lead("__next_run").over(w))
        valid_to = F.when(F.col("__ends"), F.col("__next_run")).otherwise(after)
    else:
        x = x.where("__starts")
        valid_to = F.lead("__ts").over(w)
    x = x.withColumn("__valid_to", valid_to)
    return x.where("__starts").select(
        *data_cols,
        scd_id(key, F.col("__ts")).alias("dbt_scd_id"),
        F.col("__ts").alias("dbt_updated_at"),
        F.col("__ts").alias("dbt_valid_from"),
        F.col("__valid_to").alias("dbt_valid_to"),
    )


# --- consumers of the history (SCD6, SCD7) ------------------------------------------


def alert_history(snapshot: DataFrame, as_of: Column) -> DataFrame:
    """first_alerted_at and consecutive_high_weeks per account (AGG6, AGG7).

    consecutive_high_weeks counts from the open version's valid_from, so it restarts
    whenever the score changes while HIGH (the reference's computed behaviour); see
    high_streak for the tier-entry variant.
    """
    high = F.col("risk_tier") == "HIGH"
    weeks = week_diff(F.col("dbt_valid_from").cast("date"), as_of) + 1
    return snapshot.groupBy("account_id").agg(
        F.min(F.when(high, F.col("dbt_valid_from"))).alias("first_alerted_at"),
        F.max(
            F.when(high & F.col("dbt_valid_to").isNull(), weeks).otherwise(F.lit(0).cast("bigint"))
        ).alias("consecutive_high_weeks"),
    )


def tier_transitions(snapshot: DataFrame) -> DataFrame:
    """SCD7 audit: every change of risk_tier between consecutive versions of an account."""
    w = Window.partitionBy("account_id").orderBy("dbt_valid_from")
    x = snapshot.select(
        "account_id",
        "risk_tier",
        "dbt_valid_from",
        F.lag("risk_tier").over(w).alias("from_tier"),
        F.lag("dbt_valid_to").over(w).alias("prev_valid_to"),
    )
    return x.where(F.col("from_tier").isNotNull() & (F.col("from_tier") != F.col("risk_tier"))).select(
        "account_id",
        "from_tier",
        F.col("risk_tier").alias("to_tier"),
        F.col("dbt_valid_from").alias("changed_at"),
        (F.col("prev_valid_to") != F.col("dbt_valid_from")).alias("after_gap"),
    )


def high_streak(snapshot: DataFrame, as_of: Column) -> DataFrame:
    """SCD7 true streak: weeks since the account entered HIGH without leaving it.

    Gaps-and-islands over versions: an island breaks when the tier is not HIGH or the
    versions are not contiguous (a delete in between).
    """
    w = Window.partitionBy("account_id").orderBy("dbt_valid_from")
    high = F.col("risk_tier") == "HIGH"
    contiguous = F.lag("dbt_valid_to").over(w) == F.col("dbt_valid_from")
    continues = high & F.coalesce(F.lag(high).over(w) & contiguous, F.lit(False))
    x = snapshot.select(
        "account_id", "risk_tier", "dbt_valid_from", "dbt_valid_to", continues.alias("__cont")
    )
    x = x.withColumn(
        "__island", F.sum(F.when(F.col("__cont"), 0).otherwise(1)).over(w)
    )
    wi = Window.partitionBy("account_id", "__island")
    x = x.withColumn("__entered", F.min("dbt_valid_from").over(wi))
    cur = x.where(F.col("dbt_valid_to").isNull())
    weeks = week_diff(F.col("__entered").cast("date"), as_of) + 1
    return cur.select(
        "account_id",
        F.when(F.col("risk_tier") == "HIGH", F.col("__entered")).alias("high_since"),
        F.when(F.col("risk_tier") == "HIGH", weeks).otherwise(F.lit(0).cast("bigint")).alias(
            "high_streak_weeks"
        ),
    )
