"""STR1: weekly usage kept current over an arriving product-events table.

Exact form (run_available): readStream (file source) -> foreachBatch
  1. the batch's distinct keys go to a log-structured key store (streaming/key_store.py),
  2. the (account, week) rows it touches are counted from the keys of their slots alone; events of
     earlier batches are never read again,
  3. the rows are upserted into the weekly usage table, a versioned table.
Late events of any age are folded in exactly. The store knows the last batch it holds and the
upsert is by key, so a batch that is repeated after a crash changes nothing.

Windowed form (run_windowed): a week is a 7-day event-time window that begins on Monday; counts,
the latest event and approximate distinct sketches live in the state store, and a week's state is
dropped once the watermark, `delay` behind the newest event, has passed its end. Events that come
later are not counted; their number is reported. Nothing but the state and the result is kept.

trigger(availableNow=True) drains what has arrived and stops, so both can run on a schedule.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.exprs import week_start
from riskweave.sinks import versions
from riskweave.sinks.tables import upsert
from riskweave.sources import schemas
from riskweave.streaming import key_store

KEYS = ["account_id", "week_start"]
USAGE = ["account_id", "week_start", "wau", "session_count", "event_count", "distinct_features_used", "last_event_ts"]
# windows of 7 days count from 1970-01-01, a Thursday
MONDAY = "4 days"
ADAPTIVE = "spark.sql.adaptive.enabled"


def _reader(spark: SparkSession, events_dir: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schemas.PRODUCT_EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(events_dir)


@contextmanager
def _planned_as(spark: SparkSession, adaptive: str) -> Iterator[None]:
    """A stream's own session plans without adaptive execution, which state needs; the jobs inside
    a batch are ordinary ones and follow the setting of the session that began the stream."""
    before = spark.conf.get(ADAPTIVE)
    spark.conf.set(ADAPTIVE, adaptive)
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE, before)


def _process(store: str, target: str, buckets: int, fanout: int, adaptive: str):
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        with _planned_as(spark, adaptive):
            held, slots = key_store.apply(spark, store, batch, epoch_id, buckets, fanout)
            if slots:
                touched = key_store.batch_rows(spark, store, held)
                upsert(key_store.touched_usage(spark, store, held, slots, touched).select(*USAGE), target, KEYS, "week_start")

    return run


def start(
    spark: SparkSession,
    events_dir: str,
    store: str,
    target: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    buckets: int = key_store.BUCKETS,
    fanout: int = key_store.FANOUT,
):
    return (
        _reader(spark, events_dir, max_files_per_trigger)
        .writeStream.foreachBatch(_process(store, target, buckets, fanout, spark.conf.get(ADAPTIVE)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_available(
    spark: SparkSession, events_dir: str, store: str, target: str, checkpoint: str,
    max_files_per_trigger: int | None = None, buckets: int = key_store.BUCKETS, fanout: int = key_store.FANOUT,
) -> DataFrame:
    q = start(spark, events_dir, store, target, checkpoint, max_files_per_trigger, buckets, fanout)
    q.awaitTermination()
    return versions.read(spark, target).select(*USAGE)


# --- windowed form ------------------------------------------------------------------------


@dataclass(frozen=True)
class Windowed:
    usage: DataFrame
    rows_read: int
    late_groups: int


def windowed_usage(events: DataFrame, delay: str = "14 days", rsd: float = 0.05) -> DataFrame:
    """Streaming aggregate by account and Monday week with bounded state."""
    if events.sparkSession.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        raise ValueError("event-time windows need the session time zone UTC")
    ev = events.withColumn("event_time", F.col("event_ts").cast("timestamp")).withWatermark("event_time", delay)
    week = F.window("event_time", "7 days", "7 days", MONDAY)
    distinct = (F.approx_count_distinct(c, rsd).alias(name) for c, name in key_store.KINDS.values())
    out = ev.groupBy(week.alias("week"), "account_id").agg(F.count(F.lit(1)).alias("event_count"), F.max("event_ts").alias("last_event_ts"), *distinct)
    return out.select("account_id", F.col("week.start").cast("date").alias("week_start"), *USAGE[2:])


def run_windowed(
    spark: SparkSession, events_dir: str, target: str, checkpoint: str, delay: str = "14 days", rsd: float = 0.05,
    max_files_per_trigger: int | None = None,
) -> Windowed:
    """Drain what has arrived. Each batch writes the weeks whose state changed. late_groups counts
    the (account, week) updates that came behind the watermark; the events lost with them are
    rows_read less the growth of the table's event counts."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        upsert(batch, target, KEYS, "week_start")

    events = _reader(spark, events_dir, max_files_per_trigger)
    q = (
        windowed_usage(events, delay, rsd).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    progress = q.recentProgress
    read = sum(p["numInputRows"] for p in progress)
    late = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    return Windowed(versions.read(spark, target).select(*USAGE), read, late)


__all__ = ["start", "run_available", "windowed_usage", "run_windowed", "Windowed"]
