"""Derive the four raw account-risk tables from the driver's TPC-H-ish tables.

Only integer arithmetic and calendar-day differences are used so that any SQL
engine computes identical rows. Every row of supplier, lineitem and orders is used:
an order is a billing event or a ticket, a line item a usage event. Every derivation is a narrow
projection over one scan (no shuffle); the supplier count N enters as a scalar subquery.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.exprs import day_diff

# FIXED VALUES of the fixture mapping
AS_OF = dt.date(2001, 11, 7)  # a Wednesday
WEEK_END = dt.date(2001, 11, 11)  # Sunday of the as_of week
FOLD_DAYS = 364  # fold years onto one, keeping the weekday
PLANS_BY_MOD3 = ["starter", "growth", "enterprise"]
EVENT_TYPE_BY_PRIORITY = {
    "1-URGENT": "payment_failure",
    "2-HIGH": "downgrade",
    "3-MEDIUM": "upgrade",
    "4-NOT SPECIFIED": "renewal",
    "5-LOW": "cancellation",
}
SEVERITY_BY_PRIORITY = {
    "1-URGENT": "P1",
    "2-HIGH": "P2",
    "3-MEDIUM": "P3",
    "4-NOT SPECIFIED": "P4",
    "5-LOW": "P4",
}
STATUS_BY_ORDERSTATUS = {"O": "open", "F": "resolved", "P": "closed"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map(col, mapping: dict) -> F.Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out


def _plus_hours(ts, hours) -> F.Column:
    return F.timestamp_add("HOUR", hours.cast("int"), ts)


def accounts(
    spark: SparkSession,
    sf_dir: str,
    as_of: dt.date = AS_OF,
    inactive_ids: Iterable[str] = (),
) -> DataFrame:
    """Accounts from supplier. `inactive_ids` forces is_active = false (delete fixtures)."""
    k = F.col("s_suppkey")
    t = F.lit(as_of)
    active = (k % 10) != 9
    inactive_ids = list(inactive_ids)
    if inactive_ids:
        active = active & ~k.cast("string").isin(inactive_ids)
    return read_table(spark, sf_dir, "supplier").select(
        k.cast("string").alias("account_id"),
        F.col("s_name").alias("account_name"),
        F.element_at(F.array(*[F.lit(p) for p in PLANS_BY_MOD3]), (k % 3 + 1).cast("int")).alias(
            "plan_name"
        ),
        F.abs(F.col("s_acctbal")).alias("mrr"),
        ((k % 13) * 3).cast("int").alias("seats_contracted"),
        F.date_add(t, ((k * 37) % 150 - 10).cast("int")).alias("renewal_date"),
        active.alias("is_active"),
        F.date_sub(t, (k % 700).cast("int")).cast("timestamp_ntz").alias("created_at"),
    )


def product_events(spark: SparkSession, sf_dir: str, week_end: dt.date = WEEK_END) -> DataFrame:
    """Usage events from lineitem, folded onto the year before `week_end`; the cohorts come from
    events that happened a year earlier."""
    li = read_table(spark, sf_dir, "lineitem")
    k = F.col("l_suppkey")
    part = F.col("l_partkey")
    folded = day_diff(F.col("l_shipdate"), F.lit(week_end)) % FOLD_DAYS
    cohort = k % 10
    back = folded
    earlier = (
        (cohort == 0)
        | ((cohort == 1) & (back < 40))
        | ((cohort == 2) & (back < 28) & (part % 4 != 0))
        | ((cohort == 3) & (back >= 28) & (part % 3 != 0))
        | (cohort.isin(4, 5) & (part % 8 != 0))
    )
    back = folded + F.when(earlier, FOLD_DAYS).otherwise(0)
    day = F.date_sub(F.lit(week_end), back.cast("int")).cast("timestamp_ntz")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("event_id"),
        k.cast("string").alias("account_id"),
        (part % 40).cast("string").alias("user_id"),
        F.col("l_orderkey").cast("string").alias("session_id"),
        F.concat(
            F.col("l_returnflag"), F.col("l_linestatus"), (F.col("l_linenumber") % 2).cast("string")
        ).alias("feature_name"),
        _plus_hours(day, F.col("l_orderkey") % 24).alias("event_ts"),
    )


def _n_accounts(spark: SparkSession, sf_dir: str) -> F.Column:
    """Supplier count N (keys are 0..N-1) as a scalar subquery of the plan."""
    return read_table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()


def _order_ts(as_of: dt.date) -> F.Column:
    """Tickets (remainder 0) and a seventh of the billing events (remainder 1) fall into the last
    year, the other billing events into the years before."""
    years = F.greatest(F.col("o_orderkey") % 8 - 1, F.lit(0))
    back = day_diff(F.col("o_orderdate"), F.lit(as_of)) % FOLD_DAYS + years * FOLD_DAYS
    day = F.date_sub(F.lit(as_of), back.cast("int")).cast("timestamp_ntz")
    return _plus_hours(day, F.col("o_orderkey") % 24)


def billing_events(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    n = _n_accounts(spark, sf_dir)
    return o.where(F.col("o_orderkey") % 8 != 0).select(
        F.col("o_orderkey").cast("string").alias("event_id"),
        (F.col("o_custkey") % n).cast("string").alias("account_id"),
        _map(F.col("o_orderpriority"), EVENT_TYPE_BY_PRIORITY).alias("event_type"),
        F.col("o_totalprice").alias("amount"),
        _order_ts(as_of).alias("event_ts"),
    )


def support_tickets(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    n = _n_accounts(spark, sf_dir)
    created = _order_ts(as_of)
    status = _map(F.col("o_orderstatus"), STATUS_BY_ORDERSTATUS)
    resolved = F.when(
        status != "open",
        F.timestamp_add("DAY", (F.col("o_orderkey") % 21 - 2).cast("int"), created),
    )
    return o.where(F.col("o_orderkey") % 8 == 0).select(
        F.col("o_orderkey").cast("string").alias("ticket_id"),
        (F.col("o_custkey") % n).cast("string").alias("account_id"),
        _map(F.col("o_orderpriority"), SEVERITY_BY_PRIORITY).alias("severity"),
        status.alias("status"),
        created.alias("created_at"),
        resolved.alias("resolved_at"),
    )


def raw_tables(
    spark: SparkSession, sf_dir: str, inactive_ids: Iterable[str] = ()
) -> dict[str, DataFrame]:
    """The four raw tables of the fixture world (all anchored at AS_OF)."""
    return {
        "accounts": accounts(spark, sf_dir, inactive_ids=inactive_ids),
        "product_events": product_events(spark, sf_dir),
        "billing_events": billing_events(spark, sf_dir),
        "support_tickets": support_tickets(spark, sf_dir),
    }
