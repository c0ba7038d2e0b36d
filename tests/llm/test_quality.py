"""The classifier: held-out accuracy, traversal, what it learns from."""

import zlib

import numpy as np
import pyarrow as pa

from riskweave.llm import quality as Q
from riskweave.llm.queries import op8_quality
from tests.llm.data import awkward_docs, empty_docs, prose

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = op8_quality(spark, SF).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    unseen = [r for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([r.predicted == label[r.doc_id] for r in unseen]) >= 0.95


def test_flat_trees_match_a_plain_walk():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 5))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    forest = Q.fit(x, y, trees=30)
    assert np.mean((forest.scores(x) > 0.5) == y) > 0.95
    for row in x[:20]:
        total = forest.start
        for t in range(len(forest.leaf)):
            i = 0
            while i < forest.feature.shape[1]:
                i = 2 * i + 1 + int(row[forest.feature[t, i]] > forest.threshold[t, i])
            total += forest.leaf[t, i - forest.feature.shape[1]]
        assert abs(1 / (1 + np.exp(-total)) - forest.scores(row[None])[0]) < 1e-12


def test_statistics_of_empty_texts():
    x = Q.statistics(pa.array(["", None, "Ab cd cd\nx"]))
    assert not x[:2].any() and x[2, Q.STATS.index("words")] == np.log1p(4)
    assert x[2, Q.STATS.index("repeated_next")] == 0.25


def test_labels_that_cannot_be_learnt_from(spark):
    docs = awkward_docs(spark, clashing=True)
    none = spark.createDataFrame([(1, None), (4, 1), (4, 0), (None, 1)], "doc_id long, quality int")
    assert Q.train(docs, none) is None
    assert Q.keep(docs, None).count() == docs.count()
    assert {r.score for r in Q.classify(docs, None).select("score").collect()} == {0.5}
    held = [i for i in range(12) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert Q.train(docs, spark.createDataFrame([(i, 1) for i in held], "doc_id long, quality int")) is None


def test_awkward_rows_and_one_class(spark):
    docs = awkward_docs(spark, clashing=True)
    model = Q.train(docs, spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int"))
    out = Q.classify(docs, model)
    assert out.count() == docs.count() and out.where("score is null or score < 0.9").count() == 0
    assert Q.keep(docs, model).columns == docs.columns
    assert Q.classify(empty_docs(spark), model).count() == 0


def test_training_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i % 50, prose(i, 5)) for i in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    seen = []
    fit, Q.fit = Q.fit, lambda x, y: seen.append(len(x))
    try:
        Q.train(docs, labels, max_train=20)
    finally:
        Q.fit = fit
    assert seen == [20]


def plain_fit(x, y, trees, depth, bins, rate):
    """Boosting by trying every bin edge of every feature in every node, row by row."""
    n, m = x.shape
    edges = [sorted({float(np.quantile(x[:, j], q)) for q in np.linspace(0, 1, bins + 1)[1:-1]}) for j in range(m)]
    prior = min(max(float(np.mean(y)), 1e-3), 1 - 1e-3)
    start = np.log(prior / (1 - prior))
    margin, grown = [start] * n, []
    for _ in range(trees):
        p = [1 / (1 + np.exp(-v)) for v in margin]
        grad, hess = [a - b for a, b in zip(y, p, strict=True)], [b * (1 - b) for b in p]
        members, splits = {0: list(range(n))}, {}
        for node in range(2**depth - 1):
            own = members.get(node, [])

            def part(rows, grad=grad, hess=hess):
                return sum(grad[i] for i in rows) ** 2 / (sum(hess[i] for i in rows) + Q.RIDGE)

            best = (0.0, 0, np.inf)
            for j in range(m):
                for e in edges[j]:
                    low, high = [i for i in own if x[i, j] <= e], [i for i in own if x[i, j] > e]
                    if min(len(low), len(high)) >= Q.MIN_LEAF and (gain := part(low) + part(high) - part(own)) > best[0] + 1e-9:
                        best = (gain, j, e)
            splits[node] = best[1:]
            members[2 * node + 1] = [i for i in own if x[i, best[1]] <= best[2]]
            members[2 * node + 2] = [i for i in own if x[i, best[1]] > best[2]]
        leaves = {}
        for node in range(2**depth - 1, 2 ** (depth + 1) - 1):
            own = members[node]
            leaves[node] = rate * sum(grad[i] for i in own) / (sum(hess[i] for i in own) + Q.RIDGE)
            for i in own:
                margin[i] += leaves[node]
        grown.append((splits, leaves))
    return start, grown, margin


def test_fit_finds_the_best_splits():
    r = np.random.default_rng(4)
    x = np.stack([r.normal(size=220), r.integers(0, 3, 220).astype(float), np.ones(220), r.exponential(size=220)], axis=1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] == 1) ^ (r.random(220) < 0.1)).astype(float)
    forest = Q.fit(x, y, trees=4, depth=3, bins=12, rate=0.3)
    start, grown, margin = plain_fit(x, y, 4, 3, 12, 0.3)
    assert forest.start == start
    for t, (splits, leaves) in enumerate(grown):
        for node, (feature, edge) in splits.items():
            assert forest.threshold[t, node] == edge and (edge == np.inf or forest.feature[t, node] == feature)
        assert np.allclose(forest.leaf[t], [leaves[k] for k in sorted(leaves)], rtol=0, atol=1e-12)
    assert np.allclose(forest.scores(x), 1 / (1 + np.exp(-np.array(margin))), rtol=0, atol=1e-12)


def test_fit_of_ties_and_constants():
    """Equal gains go to the first feature and edge; nothing to split gives the prior."""
    x = np.repeat(np.arange(8.0), 10)[:, None].repeat(2, axis=1)
    y = (x[:, 0] > 3).astype(float)
    forest = Q.fit(x, y, trees=1, depth=1)
    assert forest.feature[0, 0] == 0 and np.array_equal(forest.scores(x) > 0.5, y == 1)
    flat = Q.fit(np.ones((60, 3)), np.arange(60) % 3 == 0, trees=5)
    assert np.allclose(flat.scores(np.ones((2, 3))), 1 / 3)
