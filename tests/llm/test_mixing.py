"""Raking against numpy, the draw against its definition, awkward rows."""

import hashlib
from functools import partial

import numpy as np
from pyspark.sql import functions as F

from riskweave.llm import mixing
from tests.llm.data import awkward_docs, empty_docs


def test_marginals_are_met(spark):
    r = np.random.default_rng(3)
    cells = [(s, l, t, int(r.integers(1, 9000))) for s in "abcdef" for l in ("en", "de", "fr") for t in ("x", "y") if r.random() < 0.8]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    got = mixing.rake(frame, alpha=0.5).collect()
    assert len(got) == len(cells)
    whole = sum(c[3] for c in cells)
    for axis, name in enumerate(("source", "lang", "topic")):
        sums, made = {}, {}
        for c in cells:
            sums[c[axis]] = sums.get(c[axis], 0) + c[3]
        for g in got:
            made[g[name]] = made.get(g[name], 0) + g.tokens * g.weight
        norm = sum(v**0.5 for v in sums.values())
        for k, v in sums.items():
            assert abs(made[k] / (whole * v**0.5 / norm) - 1) < 1e-9


def test_draw_is_a_hash_of_the_id(spark):
    frame = spark.createDataFrame([(1,), (77,), (None,)], "doc_id long").select("doc_id", mixing.draw(F.col("doc_id"), "s").alias("u"))
    for r in frame.collect():
        key = "s:" + ("null" if r.doc_id is None else str(r.doc_id))
        assert abs(r.u - int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 16**13) < 1e-15


def test_sample_share_follows_the_weights(spark):
    rows = [(i, "w " * 20, "en" if i % 3 else "de", "big" if i % 10 else "small", 0) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = mixing.mix(docs, alpha=0.2, details=True)
    kept = {r.source: r.n for r in out.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    share = kept["small"] / sum(kept.values())
    want = 1 / (1 + 9**0.2)
    assert abs(share - want) < 0.04
    assert out.agg(F.max("probability")).first()[0] == 1.0


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "rake", partial(mixing.rake, rounds=3))
    docs = awkward_docs(spark, clashing=True)
    out = mixing.mix(docs, alpha=1.0)
    assert out.columns == docs.columns
    # alpha 1 keeps the corpus as it is: every probability is 1
    assert out.count() == docs.count()
    detailed = mixing.mix(docs, details=True)
    assert detailed.where("probability > 1 or probability <= 0").count() == 0
    assert {r.n_tokens for r in detailed.where("text is null or trim(text) = ''").collect()} <= {0}
    assert mixing.mix(empty_docs(spark)).count() == 0
    assert mixing.mix(docs.where("text is null"), details=True).select("weight").distinct().first()[0] == 1.0


def test_many_languages(spark):
    """No bound on the number of values: 20,000 languages of three sources."""
    frame = spark.range(60_000).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.concat(F.lit("l"), F.col("id") % 20_000).alias("lang"),
        F.when(F.col("id") % 7 < 3, "x").otherwise("y").alias("topic"), (F.col("id") % 11 + 1).alias("tokens"),
    )
    fitted = mixing.rake(frame, alpha=0.5, rounds=30, tolerance=1e-6)
    assert fitted.count() == 60_000
    assert mixing.margin_errors(fitted, alpha=0.5).agg(F.max(F.abs("error"))).first()[0] < 1e-4


def test_margins_that_contradict_each_other(spark):
    """Every source has one language, and alpha 0 asks for equal sources and equal languages: three
    sources, two languages. What is left is told, and the topics are met."""
    frame = spark.createDataFrame([("a", "en", "x", 10), ("b", "en", "x", 20), ("c", "de", "x", 5), ("c", "de", "y", 5)], "source string, lang string, topic string, tokens long")
    fitted = mixing.rake(frame, alpha=0.0, rounds=6)
    errors = {(r.dimension, r.value): r.error for r in mixing.margin_errors(fitted, alpha=0.0).collect()}
    assert max(map(abs, errors.values())) > 0.05
    assert all(abs(v) < 1e-9 for (d, _), v in errors.items() if d == "topic")
