"""The pipeline's stages against brute force on a small corpus, and awkward tables."""

from functools import partial

import duckdb
import pytest

import corpus_pipeline as P
from riskweave.llm import line_dedup, mixing
from riskweave.llm import queries as Q
from riskweave.llm.common import stored
from tests.llm import test_contamination, test_line_dedup, test_simhash
from tests.llm.data import DOCS, awkward_docs, on_disk
from tools.check_oracle import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output rows of every stage over the given documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name.replace(" ", "-")))
    return out


def test_columns(steps):
    names = steps[0].columns
    assert all(s.columns == names for s in steps[:-1]) and steps[-1].columns[: len(names)] == names


def test_quality_stage(spark, steps):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[1].collect()}
    assert sum((d in kept) == (q == 1) for d, q in label.items()) >= 0.95 * len(label)


def test_line_stage(steps):
    want, _ = test_line_dedup.brute(steps[1].collect(), line_dedup.RATIO, line_dedup.MIN_PAGES)
    assert sorted((r.doc_id, r.text) for r in steps[2].collect()) == sorted(want)


def test_near_duplicate_stage(steps):
    rows = sorted(steps[2].collect(), key=lambda r: r.doc_id)
    root = test_simhash.plain_components([test_simhash.plain_fingerprint(r.text) for r in rows])
    assert sorted(r.doc_id for r in steps[3].collect()) == [rows[i].doc_id for i in sorted(set(root))]


def test_decontamination_stage(spark, steps):
    found = test_contamination.brute(steps[3].collect(), spark.read.parquet(f"{SF}/benchmark.parquet").collect())
    assert sorted(r.doc_id for r in steps[4].collect()) == sorted(x[0] for x in found if not x[5])


def test_mixing_stage(steps):
    con = duckdb.connect()
    con.register("documents", steps[4].toArrow())
    want = con.execute(Q.oracle_sql()["op5_mixing"])
    cols = [d[0] for d in want.description]
    got = steps[5].selectExpr("doc_id", "source", "lang", "topic", "n_tokens", "round(weight, 6) weight", "round(probability, 6) probability")
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(cols, want.fetchall())


def test_awkward_and_empty_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "rake", partial(mixing.rake, rounds=3))  # these margins contradict each other
    for name, docs in (("awkward", awkward_docs(spark)), ("clashing", awkward_docs(spark, clashing=True)), ("empty", spark.createDataFrame([], DOCS))):
        folder = tmp_path / name
        on_disk(docs, folder)
        on_disk(spark.createDataFrame([], "doc_id long, quality int, toxic int"), folder, "labels")
        on_disk(spark.createDataFrame([(1, None), (None, "One word")], "item_id long, text string"), folder, "benchmark")
        out = P.run(spark, str(folder))
        assert (out.count() == 0) == (name == "empty")
        assert 6 not in {r.doc_id for r in out.collect()}  # holds the item


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, want = Q.queries()[name](spark, SF), con.execute(Q.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, want.fetchall())
