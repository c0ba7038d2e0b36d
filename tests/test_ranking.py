"""Global ranks, quantiles and pages against a sorted list; running sums; no window over a group."""

import random

from pyspark.sql import functions as F

from riskweave.operators import ranking as rk
from riskweave.registry import queries

S = "id string, score double, tier string"


def frame(spark, n, seed=1, parts=7):
    r = random.Random(seed)
    rows = [(f"a{k}", r.choice([None, 1.0, 2.5, 2.5, float(r.randint(0, 40))]), r.choice(["HIGH", "LOW", "LOW", None])) for k in range(n)]
    return spark.createDataFrame(rows, S).repartition(parts), rows


def by_score(row):
    """Highest first, nulls last, then by id."""
    return (row[1] is None, -(row[1] or 0), row[0])


def order():
    return F.desc("score"), F.asc("id")


def test_ranks_are_dense_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df, rows = frame(spark, 500)
        placed = rk.ordered(df, *order())
        assert placed.offsets.count() > 3 and placed.n == 500
        got = sorted((r.rank, r.id) for r in placed.ranked().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == [(k, r[0]) for k, r in enumerate(sorted(rows, key=by_score), 1)]


def test_quantiles_and_pages(spark):
    for n in (1, 2, 9, 101):
        df, rows = frame(spark, n, seed=n)
        rows.sort(key=by_score)
        placed = rk.ordered(df, *order())
        want = {q: rows[max(1, -(-q * n // 1000)) - 1][0] for q in (0, 250, 500, 999, 1000)}
        assert {r.per_mille: r.id for r in placed.quantiles(list(want)).collect()} == want
        for page in (1, 2, 12):
            got = sorted((r.rank, r.id) for r in placed.page(page, 10).collect())
            assert got == [(k, r[0]) for k, r in enumerate(rows, 1)][(page - 1) * 10 : page * 10]


def test_ranked_within_a_group(spark):
    df, rows = frame(spark, 200)
    got = {(r.tier, r.rank): r.id for r in rk.ranked_within(df, "tier", *order()).collect()}
    want = {}
    for tier in ("HIGH", "LOW", None):
        own = sorted((r for r in rows if r[2] == tier), key=by_score)
        want |= {(tier, k): r[0] for k, r in enumerate(own, 1)}
    assert got == want


def test_running_sums(spark):
    df, rows = frame(spark, 150)
    df = df.withColumn("n", F.length("id").cast("long"))
    total, want = 0, {}
    for r in sorted(rows, key=by_score):
        want[r[0]] = total
        total += len(r[0])
    assert {r.id: r.n_before for r in rk.running(df, order(), ["n"]).collect()} == want


def test_empty(spark):
    df = spark.createDataFrame([], S)
    placed = rk.ordered(df, *order())
    assert placed.n == 0 and placed.ranked().count() == placed.page(1, 5).count() == placed.quantiles([500]).count() == 0
    assert rk.ranked_within(df, "tier", *order()).count() == 0


def test_ranked_queries_have_no_window_over_tiers(spark):
    plan = queries()["risk_scores_ranked"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
