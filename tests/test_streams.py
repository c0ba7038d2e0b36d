"""Key store levels, replays and reads; event-time windows; mergeable sketches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import sketches as sk
from riskweave.operators.activity import weekly_usage
from riskweave.session import scratch_path
from riskweave.sinks import versions as vs
from riskweave.sources import schemas
from riskweave.streaming import activity_stream as st
from riskweave.streaming import key_store as ks

DAY = dt.datetime(2001, 10, 22)


def events(spark, n, seed=1, days=28, start=DAY):
    r = random.Random(seed)
    rows = [
        (f"{seed}-{k}", f"a{r.randint(0, 4)}", f"u{r.randint(0, 9)}", f"s{r.randint(0, 60)}", r.choice(["f1", "f2"]), start + dt.timedelta(hours=r.randint(0, 24 * days - 1)))
        for k in range(n)
    ]
    return spark.createDataFrame(rows, schemas.PRODUCT_EVENTS)


def rows(df):
    return sorted(tuple(r) for r in df.select(*st.USAGE).collect())


def store(spark, batches, path, **kw):
    for epoch, b in enumerate(batches):
        v, slots = ks.apply(spark, path, b, epoch, **kw)
    return v


def test_levels_hold_few_runs_and_every_key(spark):
    path = scratch_path(spark, "t_keys")
    batches = [events(spark, 40, seed=k, days=14) for k in range(9)]
    v = store(spark, batches, path, buckets=2, fanout=2)
    everything = batches[0]
    for b in batches[1:]:
        everything = everything.union(b)
    assert rows(ks.usage(vs.read(spark, path))) == rows(weekly_usage(everything))
    levels = v.note["levels"]
    # nine runs merged by twos: no slot holds two runs of a level
    assert all(len({levels[r] for r in runs}) == len(runs) for runs in v.parts.values())
    assert max(levels.values()) == 3 and set(levels) == {r for p in v.parts.values() for r in p}


def test_a_batch_reads_only_the_slots_it_touches(spark):
    path = scratch_path(spark, "t_keys")
    old = events(spark, 50, seed=1, days=14)
    ks.apply(spark, path, old, 0)
    new = events(spark, 10, seed=2, days=7, start=DAY + dt.timedelta(days=14))
    v, slots = ks.apply(spark, path, new, 1)
    touched = new.select("account_id", F.lit((DAY + dt.timedelta(days=14)).date()).alias("week_start"))
    frame = ks.touched_usage(spark, path, v, slots, touched)
    first = next(iter(vs.version(spark, path, 1).runs))
    read = vs.read_version(spark, path, v, slots).inputFiles()
    assert read and not any(first in f for f in read) and all(f"{vs.RUN}=" in f for f in read)
    assert rows(frame) == rows(weekly_usage(new))


def test_a_repeated_batch_is_not_counted_twice(spark):
    path = scratch_path(spark, "t_keys")
    b = [events(spark, 30, seed=k, days=7) for k in range(2)]
    store(spark, b, path)
    again, slots = ks.apply(spark, path, b[1], 1)
    assert again.number == 2 and slots
    assert rows(ks.usage(vs.read(spark, path))) == rows(weekly_usage(b[0].union(b[1])))


def test_crash_between_store_and_table(spark, monkeypatch):
    """The store has the batch, the table not: the repeated batch mends the table."""
    src, keys, target, ckpt = (scratch_path(spark, n) for n in ("t_src", "t_keys", "t_usage", "t_ckpt"))
    batch = events(spark, 60, seed=4)
    batch.write.parquet(src)
    upsert = st.upsert
    monkeypatch.setattr(st, "upsert", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(Exception, match="driver lost"):
        st.run_available(spark, src, keys, target, ckpt)
    assert vs.version(spark, keys).number == 1 and vs.version(spark, target) is None
    monkeypatch.setattr(st, "upsert", upsert)
    assert rows(st.run_available(spark, src, keys, target, ckpt)) == rows(weekly_usage(batch))
    assert vs.version(spark, keys).number == 1


def test_rows_list_the_keys_of_an_account_and_week(spark, monkeypatch):
    """A store that is read whole with every batch: a row per key made its joins sort and copy them all."""
    path = scratch_path(spark, "t_keys")
    batches = [events(spark, 300, seed=k, days=14).repartition(1) for k in range(3)]
    v, _ = ks.apply(spark, path, batches[0], 0, 2, 2)
    held = vs.read_version(spark, path, v)
    assert held.count() == held.select("account_id", "week_start").distinct().count()
    # rows that count as large are carried on unmerged and still counted exactly
    monkeypatch.setattr(ks, "LARGE", 35)
    for epoch in (1, 2):
        v, slots = ks.apply(spark, path, batches[epoch], epoch, 2, 2)
    held = vs.read_version(spark, path, v, slots)
    assert held.count() > held.select("account_id", "week_start").distinct().count()
    everything = batches[0].union(batches[1]).union(batches[2])
    assert rows(ks.usage(held)) == rows(weekly_usage(everything))
    assert rows(ks.touched_usage(spark, path, v, slots, ks.batch_rows(spark, path, v))) == rows(weekly_usage(everything))


def test_a_store_with_a_row_per_key_is_an_error(spark):
    """Its columns would be dropped and the lists of its weeks read as nulls."""
    path = scratch_path(spark, "t_keys")
    old = ks.keys_of(events(spark, 30), 2).select(
        ks.SLOT, "account_id", "week_start", F.lit("user").alias("kind"), F.explode("user").alias("value"), "n", "last_ts"
    )
    run, slots = vs.write_run(old, path, ks.SLOT)
    schema = old.schema.json()
    made = vs.Version(0, 0, schema, ks.SLOT, {s: [run] for s in slots}, {run: schema}, {"epoch": 0, "levels": {run: 0}})
    v = vs.commit(spark, path, None, made)
    for epoch in (0, 1):
        with pytest.raises(vs.SchemaError, match="another form"):
            ks.apply(spark, path, events(spark, 30, seed=2), epoch, 2, 2)
    assert vs.version(spark, path) == v


def test_a_batch_of_one_file_is_gathered_by_many_tasks(spark):
    """What one task reads is dealt to others before keys are gathered, and nothing is sorted for the join."""
    path = scratch_path(spark, "t_keys")
    batch = events(spark, 60, days=14).coalesce(1)
    plan = ks.keys_of(batch)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(account_id" in plan and "Aggregate" not in plan[plan.index("Exchange hashpartitioning(account_id") :]
    v, slots = ks.apply(spark, path, batch, 0)
    joined = ks.touched_usage(spark, path, v, slots, ks.batch_rows(spark, path, v))
    assert "ShuffledHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_empty_batch_in_store(spark):
    path = scratch_path(spark, "t_keys")
    v, slots = ks.apply(spark, path, events(spark, 0), 0)
    assert slots == [] and v.parts == {}
    assert ks.apply(spark, path, events(spark, 5), 1)[0].number == 2


def arrive(spark, src, df):
    df.write.mode("append").parquet(src)


def test_windows_drop_and_count_late_events(spark):
    src, target, ckpt = (scratch_path(spark, n) for n in ("t_src", "t_usage", "t_ckpt"))
    early = events(spark, 80, seed=1, days=7)
    arrive(spark, src, early)
    assert st.run_windowed(spark, src, target, ckpt, delay="7 days").late_groups == 0
    later = events(spark, 50, seed=2, days=7, start=DAY + dt.timedelta(days=28))
    arrive(spark, src, later)
    st.run_windowed(spark, src, target, ckpt, delay="7 days")
    # the first week's state is gone now; events of the last week still count
    arrive(spark, src, events(spark, 20, seed=3, days=7))
    inside = events(spark, 20, seed=5, days=7, start=DAY + dt.timedelta(days=28))
    arrive(spark, src, inside)
    out = st.run_windowed(spark, src, target, ckpt, delay="7 days")
    assert out.rows_read == 40 and out.late_groups > 0
    want = {(r.account_id, r.week_start): (r.event_count, r.last_event_ts) for r in weekly_usage(early.union(later).union(inside)).collect()}
    got = out.usage.collect()
    assert {(r.account_id, r.week_start): (r.event_count, r.last_event_ts) for r in got} == want
    exact = {(r.account_id, r.week_start): r for r in weekly_usage(early.union(later).union(inside)).collect()}
    for r in got:
        for c in ("wau", "session_count", "distinct_features_used"):
            assert abs(r[c] - exact[r.account_id, r.week_start][c]) <= max(2, 0.15 * exact[r.account_id, r.week_start][c])


def test_windows_need_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            st.windowed_usage(events(spark, 1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).select(
        F.lit("e").alias("event_id"), F.concat(F.lit("a"), F.col("id") % 3).alias("account_id"), F.concat(F.lit("u"), F.col("id") % 9000).alias("user_id"),
        F.concat(F.lit("s"), F.col("id") % 20_000).alias("session_id"), F.lit(None).cast("string").alias("feature_name"),
        (F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 28).cast("int"))).alias("event_ts"),
    )
    weekly = sk.weekly_sketches(df)
    whole = sk.estimated(sk.merged(weekly)).first()
    users, sessions = (df.select("account_id", c).distinct().count() for c in ("user_id", "session_id"))
    assert whole.event_count == 60_000 and whole.features == 0
    assert abs(whole.users - users) <= sk.relative_error() * users and abs(whole.sessions - sessions) <= sk.relative_error() * sessions
    # merging in steps is merging at once
    steps = sk.merged(sk.merged(weekly, "account_id"))
    assert sk.estimated(steps).first() == whole
    assert sk.estimated(sk.merged(sk.weekly_sketches(df.limit(0)), "account_id")).count() == 0


def test_jobs_of_a_batch_follow_the_session_that_began_the_stream(spark, monkeypatch):
    src, keys, target, ckpt = (scratch_path(spark, n) for n in ("t_src", "t_keys", "t_usage", "t_ckpt"))
    events(spark, 30).write.parquet(src)
    seen, apply = [], ks.apply
    monkeypatch.setattr(ks, "apply", lambda s, *a: seen.append(s.conf.get(st.ADAPTIVE)) or apply(s, *a))
    st.run_available(spark, src, keys, target, ckpt)
    assert seen and set(seen) == {spark.conf.get(st.ADAPTIVE)} == {"true"}
