"""Versioned tables: crashes, concurrent writers, pinned readers, schema changes, clean-up."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskweave.session import scratch_path
from riskweave.sinks import tables as tb
from riskweave.sinks import versions as vs

W1, W2, W3 = dt.date(2001, 10, 22), dt.date(2001, 10, 29), dt.date(2001, 11, 5)
S = "account_id string, week_start date, wau long"
KEYS = ["account_id", "week_start"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def put(spark, path, *data, schema=S, **kw):
    return vs.upsert(spark.createDataFrame(list(data), schema), path, KEYS, "week_start", **kw)


def test_crash_before_the_switch_leaves_the_old_version(spark, monkeypatch):
    path = scratch_path(spark, "t_versions")
    put(spark, path, ("a", W1, 1), ("b", W2, 2))

    def crash(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(vs, "_publish", crash)
    with pytest.raises(OSError, match="driver lost"):
        put(spark, path, ("a", W1, 9), ("c", W3, 3))
    assert rows(vs.read(spark, path)) == [("a", W1, 1), ("b", W2, 2)]
    monkeypatch.undo()
    assert put(spark, path, ("a", W1, 9), ("c", W3, 3)).number == 2
    assert rows(vs.read(spark, path)) == [("a", W1, 9), ("b", W2, 2), ("c", W3, 3)]


def test_crash_while_rows_are_written(spark):
    path = scratch_path(spark, "t_versions")
    put(spark, path, ("a", W1, 1))
    bad = spark.createDataFrame([("b", W2, 2)], S).withColumn("wau", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        vs.upsert(bad, path, KEYS, "week_start")
    assert rows(vs.read(spark, path)) == [("a", W1, 1)] and vs.numbers(spark, path) == [1]


def second_writer(monkeypatch, spark, path, *data):
    """Another writer commits between this writer's merge and its commit, once."""
    commit, done = vs.commit, []

    def late(*a):
        if not done:
            done.append(True)
            put(spark, path, *data)
        return commit(*a)

    monkeypatch.setattr(vs, "commit", late)


@pytest.mark.parametrize("other", [("z", W3, 7), ("z", W1, 7)])
def test_two_writers_lose_nothing(spark, monkeypatch, other):
    """In other partitions the second commit is put on top, in the same ones it merges again."""
    path = scratch_path(spark, "t_versions")
    put(spark, path, ("a", W1, 1), ("b", W2, 2))
    second_writer(monkeypatch, spark, path, other)
    made = put(spark, path, ("a", W1, 5))
    assert made.number == 3 and made.base == 2
    assert rows(vs.read(spark, path)) == sorted([("a", W1, 5), ("b", W2, 2), other], key=str)


def test_two_first_writers(spark, monkeypatch):
    path = scratch_path(spark, "t_versions")
    second_writer(monkeypatch, spark, path, ("z", W1, 7))
    put(spark, path, ("a", W1, 1))
    assert rows(vs.read(spark, path)) == [("a", W1, 1), ("z", W1, 7)]


def test_a_published_number_is_never_replaced(spark):
    path = scratch_path(spark, "t_versions")
    first = put(spark, path, ("a", W1, 1))
    assert not vs._publish(spark, path, first)


def test_readers_stay_at_their_version(spark):
    path = scratch_path(spark, "t_versions")
    put(spark, path, ("a", W1, 1), ("b", W2, 2))
    before = vs.read(spark, path)
    put(spark, path, ("a", W1, 3))
    assert rows(before) == rows(vs.read(spark, path, 1)) == [("a", W1, 1), ("b", W2, 2)]
    # the week that the batch lacks keeps its run, and is not read again
    v1, v2 = vs.version(spark, path, 1), vs.version(spark, path)
    assert v1.parts["week_start=2001-10-29"] == v2.parts["week_start=2001-10-29"]
    assert v1.parts["week_start=2001-10-22"] != v2.parts["week_start=2001-10-22"]


def test_partition_filters_prune_folders(spark):
    path = scratch_path(spark, "t_versions")
    put(spark, path, ("a", W1, 1), ("b", W2, 2), ("c", W3, 3))
    plan = vs.read(spark, path).where(F.col("week_start") == F.lit(W2))
    assert "PartitionFilters: [isnotnull(week_start" in plan._jdf.queryExecution().executedPlan().toString()
    assert rows(plan) == [("b", W2, 2)]


def test_widening_and_narrowing(spark):
    path = scratch_path(spark, "t_versions")
    narrow = "account_id string, week_start date, wau int, ratio float, gone string"
    put(spark, path, ("a", W1, 1, 0.5, "x"), ("b", W2, 2, 0.25, "y"), schema=narrow)
    wide = "account_id string, week_start date, wau long, ratio double, added string"
    put(spark, path, ("b", W2, 1 << 40, 0.125, "n"), schema=wide)
    out = vs.read(spark, path)
    assert out.schema.simpleString() == spark.createDataFrame([], wide).schema.simpleString()
    assert rows(out) == [("a", W1, 1, 0.5, None), ("b", W2, 1 << 40, 0.125, "n")]
    with pytest.raises(vs.SchemaError, match="wau"):
        put(spark, path, ("b", W2, 1, 0.5, "x"), schema=narrow)
    assert vs.numbers(spark, path) == [1, 2] and rows(vs.read(spark, path, 1))[0] == ("a", W1, 1, 0.5, "x")


def test_odd_partition_values_and_empty_batches(spark):
    path = scratch_path(spark, "t_versions")
    kinds = "id string, kind string, n int"
    data = [("a", "x/y=z %", 1), ("b", None, 2), ("c", "é", 3)]
    vs.upsert(spark.createDataFrame(data, kinds), path, ["id"], "kind")
    vs.upsert(spark.createDataFrame([], kinds), path, ["id"], "kind")
    assert sorted(((r.id, r.kind, r.n) for r in vs.read(spark, path).collect())) == data
    empty = scratch_path(spark, "t_versions")
    vs.upsert(spark.createDataFrame([], kinds), empty, ["id"], "kind")
    assert vs.read(spark, empty).count() == 0


def test_partitions_without_a_version_are_refused(spark):
    path = scratch_path(spark, "t_versions")
    spark.createDataFrame([("a", W1, 1)], S).write.partitionBy("week_start").parquet(path)
    with pytest.raises(ValueError, match="without a version"):
        put(spark, path, ("b", W1, 1))


def test_rebuild_and_vacuum(spark):
    path = scratch_path(spark, "t_versions")
    put(spark, path, ("a", W1, 1))
    vs.replace_all(spark.createDataFrame([("r", W2, "text")], "account_id string, week_start date, note string"), path, "week_start")
    vs.replace_all(spark.createDataFrame([("s", W2, 1)], S), path, "week_start")
    assert vs.vacuum(spark, path) == []  # too young
    first = vs.version(spark, path, 1)
    assert set(vs.vacuum(spark, path, keep=2, min_age_hours=0)) == set(first.runs)
    assert vs.numbers(spark, path) == [2, 3] and rows(vs.read(spark, path, 2).select("account_id")) == [("r",)]


def test_table_replace_switches_the_location(spark):
    name = "t_replace_db.t_replaced"
    path = scratch_path(spark, "t_replaced")
    spark.sql("CREATE DATABASE IF NOT EXISTS t_replace_db")
    try:
        tb.write_table(spark.createDataFrame([("a", 1)], "id string, n int"), name, path=path)
        old = spark.table(name)
        tb.write_table(spark.createDataFrame([("b", 2)], "id string, n int"), name, path=path)
        assert rows(spark.table(name)) == [("b", 2)] and rows(old) == [("a", 1)]
        tb.write_table(spark.createDataFrame([("c", 2.5)], "id string, x double"), name, path=path)
        assert rows(spark.table(name)) == [("c", 2.5)]
    finally:
        spark.sql("DROP DATABASE t_replace_db CASCADE")


def test_queries_leave_the_callers_tables(spark):
    """The registered queries work in databases of their own."""
    from riskweave.registry import queries

    spark.sql("CREATE DATABASE IF NOT EXISTS ml_output")
    spark.createDataFrame([(1,)], "mine int").write.mode("overwrite").saveAsTable("ml_output.ml_predictions")
    try:
        before = {r.name for r in spark.catalog.listDatabases()}
        assert queries()["predictions_table"](spark, "/root/testdata/sf0.001").count() > 0
        assert rows(spark.table("ml_output.ml_predictions")) == [(1,)]
        assert {r.name for r in spark.catalog.listDatabases()} == before
    finally:
        spark.sql("DROP TABLE ml_output.ml_predictions")


def test_a_run_has_one_file_of_a_small_partition(spark):
    """However many tasks hold its rows."""
    df = spark.range(0, 400, 1, 16).select("id", (F.col("id") % 5).alias("p"))
    path = scratch_path(spark, "t_files")
    run, parts = vs.write_run(df, path, "p")
    files = spark.read.parquet(f"{path}/data/{vs.RUN}={run}").inputFiles()
    assert len(parts) == 5 and len(files) == 5


def test_many_folders_are_listed_by_few_tasks(spark):
    """A task for each folder of each run once took longer than reading them."""
    path = scratch_path(spark, "t_listed")
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 80).cast("string").alias("p"))
    v = vs.replace_all(df, path, "p")
    before, done = spark.conf.get(vs.LISTERS), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listed", "listing")
    try:
        out = vs.read_version(spark, path, v)
        stages = [i for j in done.getJobIdsForGroup("listed") for i in done.getJobInfo(j).stageIds]
        tasks = [done.getStageInfo(i).numTasks for i in stages]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tasks and max(tasks) <= 2 * spark.sparkContext.defaultParallelism < 80
    assert out.count() == 400 and spark.conf.get(vs.LISTERS) == before


def test_small_folders_are_written_by_several_tasks(spark):
    path = scratch_path(spark, "t_spread")
    df = spark.range(40_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("h"), (F.col("id") % 40).cast("string").alias("p"))
    spark.sparkContext.setJobGroup("spread", "write")
    before = spark.conf.get(vs.LEAST)
    try:
        run, parts = vs.write_run(df, path, "p")
        jobs = spark.sparkContext.statusTracker()
        last = max(i for j in jobs.getJobIdsForGroup("spread") for i in jobs.getJobInfo(j).stageIds)
        assert len(parts) == 40 and jobs.getStageInfo(last).numTasks > 3 and spark.conf.get(vs.LEAST) == before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(vs.read_run(spark, path, run, df.schema).inputFiles()) == 40
