"""Keyed upsert (idempotence, stale rows, schema sync) and the streaming weekly usage."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskweave.operators.activity import weekly_usage
from riskweave.registry import _staged
from riskweave.session import scratch_path
from riskweave.sinks import versions
from riskweave.sinks.tables import upsert
from riskweave.streaming import activity_stream

W1, W2, W3 = dt.date(2001, 10, 22), dt.date(2001, 10, 29), dt.date(2001, 11, 5)
S = "account_id string, week_start date, wau long"


def _rows(df):
    return sorted((r.account_id, r.week_start, r.wau) for r in df.collect())


def test_same_batch_twice_equals_once(spark):
    path = scratch_path(spark, "t_upsert")
    b = spark.createDataFrame([("a", W1, 1), ("b", W1, 2), ("a", W2, 3)], S)
    once = _rows(upsert(b, path, ["account_id", "week_start"], "week_start"))
    twice = _rows(upsert(b, path, ["account_id", "week_start"], "week_start"))
    assert once == twice


def test_second_batch_replaces_keys_and_keeps_stale_rows(spark):
    path = scratch_path(spark, "t_upsert")
    keys = ["account_id", "week_start"]
    upsert(spark.createDataFrame([("a", W1, 1), ("b", W2, 2), ("c", W2, 9)], S), path, keys, "week_start")
    out = upsert(spark.createDataFrame([("b", W2, 5), ("a", W3, 7)], S), path, keys, "week_start",
                 touched=[W2, W3])
    # (a, W1): untouched week kept; (c, W2): stale row in a touched week kept; (b, W2) replaced
    assert _rows(out) == [("a", W1, 1), ("a", W3, 7), ("b", W2, 5), ("c", W2, 9)]


def test_schema_sync_adds_and_drops_columns(spark):
    path = scratch_path(spark, "t_upsert")
    keys = ["account_id", "week_start"]
    old = spark.createDataFrame([("a", W1, 1, "x")], S + ", legacy string")
    upsert(old, path, keys, "week_start")
    new = spark.createDataFrame([("b", W2, 2, 0.5)], S + ", ratio double")
    out = upsert(new, path, keys, "week_start")
    assert out.columns == new.columns
    got = {r.account_id: r.ratio for r in out.collect()}
    assert got == {"a": None, "b": 0.5}


def test_stream_equals_batch(spark):
    sf = "/root/testdata/sf0.001"
    ev = _staged(spark, sf)["product_events"]
    src = scratch_path(spark, "t_events")
    ev.repartition(3, "event_id").write.parquet(src)
    got = activity_stream.run_available(
        spark, src, scratch_path(spark, "t_store"), scratch_path(spark, "t_usage"),
        scratch_path(spark, "t_ckpt"), max_files_per_trigger=1)
    want = weekly_usage(ev)
    cols = ["account_id", "week_start", "wau", "session_count", "event_count",
            "distinct_features_used", "last_event_ts"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0
    assert got.where(F.col("wau") <= 0).count() == 0


def test_rows_outside_the_touched_partitions_are_an_error_not_a_loss(spark):
    path = scratch_path(spark, "t_upsert")
    keys = ["account_id", "week_start"]
    target = [("a", W1, 1), ("b", W1, 2), ("a", W2, 3), ("b", W2, 4)]
    upsert(spark.createDataFrame(target, S), path, keys, "week_start")
    batch = spark.createDataFrame([("a", W1, 10), ("a", W2, 30)], S)
    with pytest.raises(ValueError, match="outside the touched"):
        upsert(batch, path, keys, "week_start", touched=[W1])
    assert _rows(versions.read(spark, path)) == sorted(target)
    out = upsert(batch, path, keys, "week_start", touched=[W1, W2, W3])
    assert _rows(out) == [("a", W1, 10), ("a", W2, 30), ("b", W1, 2), ("b", W2, 4)]


def test_empty_batch_changes_nothing(spark):
    path = scratch_path(spark, "t_upsert")
    keys = ["account_id", "week_start"]
    upsert(spark.createDataFrame([("a", W1, 1)], S), path, keys, "week_start")
    assert _rows(upsert(spark.createDataFrame([], S), path, keys, "week_start")) == [("a", W1, 1)]
