"""Distinct keys of the weekly usage, kept in log-structured levels.

A key is (account, week, kind, value): a user, session or feature seen in that week. A row lists the
keys of one account and week, one list a kind; n counts the week's events and last_ts is the latest.
Rows of an account and week may be many, and a key may be in several: exact distinct counts are
counts of different keys, so a batch is folded in by its keys, and no raw event is read again.

The store is a versioned table (sinks/versions.py) whose partition, a slot, is a week and a bucket
of accounts. A batch adds one run of level 0 to the slots it touches. FANOUT runs of one level in a
slot are merged to one run of the next, so a key is written again once per level, that is about
log(batches) times. One manifest carries the new runs, their levels and the batch's number, so a
batch that is repeated after a crash is not counted twice.

No row grows without bound: it holds the events of one partition of a batch, and a row of LARGE
keys is carried to the next level as it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.functions.exprs import week_start
from riskweave.sinks import versions as vs

FANOUT = 4
# buckets of accounts in a week: as many as keep a slot of the largest week at file size
BUCKETS = 4
# a row of so many keys is not merged with others
LARGE = 1 << 18
SLOT = "slot"
KEY = [SLOT, "account_id", "week_start"]
EVENTS = "events"
LIST = "array<string>"
#: kind -> event column whose distinct values are counted, and the usage column of the count
KINDS = {"user": ("user_id", "wau"), "session": ("session_id", "session_count"), "feature": ("feature_name", "distinct_features_used")}


def slot_col(buckets: int = BUCKETS) -> Column:
    return F.format_string("%s_%04d", F.date_format("week_start", "yyyy-MM-dd"), F.pmod(F.xxhash64("account_id"), F.lit(buckets)).cast("int"))


def merged(keys: DataFrame, *by: str) -> DataFrame:
    """One row per account and week, beside the large ones."""
    size = sum((F.size(k) for k in KINDS), start=F.lit(0))
    own = keys.withColumn("own", F.when(size >= LARGE, F.monotonically_increasing_id()))
    lists = (F.array_distinct(F.flatten(F.collect_list(k))).cast(LIST).alias(k) for k in KINDS)
    return own.groupBy(*(by or KEY), "own").agg(*lists, F.sum("n").alias("n"), F.max("last_ts").alias("last_ts")).drop("own")


def keys_of(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The keys of events, one row per account, week and partition of the events. Events are dealt
    before they are gathered: a batch may come as one file, which one task reads."""
    ev = events.select(
        "account_id", week_start("event_ts").alias("week_start"), "event_ts", *(c for c, _ in KINDS.values()),
        F.spark_partition_id().alias("piece"),
    )
    dealt = ev.repartition("account_id", "week_start", "piece").withColumn(SLOT, slot_col(buckets))
    # a null user, session or feature is no distinct value
    lists = (F.collect_set(c).cast(LIST).alias(k) for k, (c, _) in KINDS.items())
    return dealt.groupBy(*KEY, "piece").agg(*lists, F.count(F.lit(1)).alias("n"), F.max("event_ts").alias("last_ts")).drop("piece")


def _levels(v: vs.Version | None) -> dict[str, int]:
    return dict(v.note.get("levels", {})) if v else {}


def apply(spark: SparkSession, path: str, events: DataFrame, epoch: int, buckets: int = BUCKETS, fanout: int = FANOUT) -> tuple[vs.Version, list[str]]:
    """Add a batch of events: the store's version that holds it, and the slots it touches. The version's
    note tells the run of the batch's own keys."""
    keys = keys_of(events, buckets)
    run, slots = vs.write_run(keys, path, SLOT)
    base = vs.version(spark, path)
    # reading would fill the columns that an earlier form of the store lacks with nulls
    if base and set(vs.struct(base.schema).names) != set(keys.columns):
        raise vs.SchemaError(f"{path} holds keys in another form: build the store again from the events")
    if base and base.note.get("epoch", -1) >= epoch:
        return replace(base, note={**base.note, "batch": run}), slots
    schema = keys.schema
    made = vs.Version(0, 0, schema.json(), SLOT, {s: [*(base.parts.get(s, []) if base else []), run] for s in slots}, {run: schema.json()})
    levels = {**_levels(base), run: 0}
    made, levels = _compacted(spark, path, base, made, levels, fanout)
    used = {r for p in {**(base.parts if base else {}), **made.parts}.values() for r in p}
    made = replace(made, note={"epoch": epoch, "batch": run, "levels": {r: n for r, n in levels.items() if r in used}})
    return vs.commit(spark, path, base, made), slots


def _compacted(spark: SparkSession, path: str, base: vs.Version | None, made: vs.Version, levels: dict[str, int], fanout: int) -> tuple[vs.Version, dict[str, int]]:
    """Merge the runs of a level where a slot has `fanout` of them, level by level."""
    level = 0
    while True:
        full = {s: own for s, runs in made.parts.items() if len(own := [r for r in runs if levels[r] == level]) >= fanout}
        if not full:
            if level >= max(levels.values(), default=0):
                return made, levels
            level += 1
            continue
        known = {**(base.runs if base else {}), **made.runs}
        view = replace(made, parts=full, runs={r: known[r] for own in full.values() for r in own})
        run, _ = vs.write_run(merged(vs.read_version(spark, path, view)), path, SLOT)
        levels[run] = level + 1
        parts = {s: [*(r for r in runs if s not in full or levels[r] != level), *([run] if s in full else [])] for s, runs in made.parts.items()}
        made = replace(made, parts=parts, runs={**made.runs, run: made.schema})
        level += 1


def usage(keys: DataFrame) -> DataFrame:
    """Weekly usage of the accounts and weeks in `keys`, which may hold a key several times. The lists
    of an account and week are merged and counted; keys in large rows beside them are told apart one by one."""
    group = ["account_id", "week_start"]
    one = merged(keys, *group).withColumn("whole", F.count(F.lit(1)).over(Window.partitionBy(*group)) == 1)

    def key(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    def keys_in(kind: str) -> Column:
        return F.transform(kind, lambda value: key(kind, value))

    events = F.array(key(EVENTS, F.lit("")))
    rows = one.select(
        *group, *(F.when(F.col("whole"), F.size(k)).cast("long").alias(name) for k, (_, name) in KINDS.items()), "n", "last_ts",
        F.inline(F.when(F.col("whole"), events).otherwise(F.concat(events, *map(keys_in, KINDS)))),
    )
    own = F.col("kind") == EVENTS
    each = rows.groupBy(*group, "kind", "value").agg(
        *(F.max(name).alias(name) for _, name in KINDS.values()), F.sum(F.when(own, F.col("n"))).alias("n"), F.max(F.when(own, F.col("last_ts"))).alias("last_ts")
    )
    return each.groupBy(*group).agg(
        *(F.coalesce(F.max(name), F.count_if(F.col("kind") == k)).alias(name) for k, (_, name) in KINDS.items()),
        F.sum("n").alias("event_count"),
        F.max("last_ts").alias("last_event_ts"),
    )


def batch_rows(spark: SparkSession, path: str, v: vs.Version) -> DataFrame:
    """The accounts and weeks of the batch that apply() has just added or found."""
    return vs.read_run(spark, path, v.note["batch"], vs.struct(v.schema)).select("account_id", "week_start")


def touched_usage(spark: SparkSession, path: str, v: vs.Version, slots: Sequence[str], touched: DataFrame) -> DataFrame:
    """Weekly usage of the touched (account, week), from the key rows of their slots alone. What is
    touched is the smaller side and is hashed, so the store is not sorted for the join."""
    keys = vs.read_version(spark, path, v, slots)
    few = touched.select("account_id", "week_start").distinct().hint("shuffle_hash")
    return usage(keys.join(few, ["account_id", "week_start"], "left_semi"))


__all__ = ["apply", "keys_of", "merged", "usage", "batch_rows", "touched_usage"]
