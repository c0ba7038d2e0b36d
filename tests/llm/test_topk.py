"""Top-k against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import topk


def brute(rows, k=5):
    usable = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(usable):
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), c) for b, (c, w) in enumerate(usable) if a != b)
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, **kw):
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, row int, part int").repartition(3)
    return sorted(tuple(r) for r in topk.top_k(frame, F.col("id") % 50 == 0, **kw).collect())


def f32(v):
    return [None if x is None else float(np.float32(x)) for x in v]


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 3)
    r = np.random.default_rng(7)
    rows = [(i, f32(r.normal(size=8) * (r.random(8) < 0.6))) for i in range(260)]
    rows += [(50 * k, rows[3][1]) for k in range(6)] + [(300 + k, rows[3][1]) for k in range(40)]  # repeated ids and vectors: ties
    rows += [(400, None), (450, f32([1, None])), (500, [float("nan")] * 8), (550, [float("inf")] + [0.0] * 7), (None, f32([1] * 8)), (600, []), (650, f32([0.5, -0.5]))]
    assert run(spark, rows) == brute(rows)


def test_sparse_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 50)
    r = np.random.default_rng(9)
    rows = [(i, f32(r.normal(size=30) * (r.random(30) < 0.1))) for i in range(200)]
    assert run(spark, rows) == brute(rows)


def test_few_and_no_rows(spark):
    rows = [(0, f32([1, 2])), (7, f32([-1, 0.25])), (50, f32([0, 0]))]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == [] and run(spark, [(1, f32([1]))]) == [] and run(spark, []) == []


def test_selection_breaks_ties_by_number():
    scores = np.array([[3, 5, 5, 5, 1], [0, 0, 0, 0, 0]])
    q, c = topk.select_best(scores, np.eye(2, 5, dtype=bool), 2)
    assert sorted(zip(q.tolist(), c.tolist(), strict=True)) == [(0, 1), (0, 2), (1, 0), (1, 2)]


def test_large_scores_keep_their_order(spark):
    """Scores near 2**54: more than a double or a packed rank can tell apart."""
    r = np.random.default_rng(3)
    rows = [(0, [65536.0] * 64), (1000, [65536.0] * 64), (1001, [65536.0] * 63 + [65535.0])]
    rows += [(k, f32(r.normal(size=64))) for k in range(1, 900)]
    assert run(spark, rows) == brute(rows)
    assert (0, 1, 1000, 64 * (65536 * 256) ** 2) in run(spark, rows)


def test_scores_beyond_int64_are_an_error(spark):
    for big in (1e30, 2.0**26):
        with pytest.raises(Exception, match="leave"):
            run(spark, [(0, [big] * 64), (1, [big] * 64)])


def test_selection_at_the_edge_of_ties():
    r = np.random.default_rng(5)
    for k in (1, 3, 5, 40):
        scores, own = r.integers(-2, 3, (30, 40)) * (1 << 60), r.random((30, 40)) < 0.2
        q, c = topk.select_best(scores, own, k)
        for row in range(30):
            want = sorted((-int(scores[row, x]), x) for x in range(40) if not own[row, x])[:k]
            assert sorted(c[q == row].tolist()) == sorted(x for _, x in want)


def test_no_side_of_the_search_is_broadcast(spark, monkeypatch):
    """Packed rows look small to the planner: their copies, one per shard, once went through the driver."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 20)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 2)
    monkeypatch.setattr(topk, "HELD_SHARDS", 3)
    monkeypatch.setattr(topk, "STREAMED_BLOCKS", 2)
    r = np.random.default_rng(11)
    rows = [(i, f32(r.normal(size=6))) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = topk.top_k(frame, F.col("id") % 50 == 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan and "CartesianProduct" in plan
    assert sorted(tuple(r) for r in out.collect()) == brute(rows)
