"""Joins on row numbers hold when Spark packs the files into other partitions from job to job."""

import random

import pytest

from riskweave.llm import common
from riskweave.llm import contamination as C
from riskweave.llm import simhash as H
from riskweave.llm import suffix_dedup as S
from tests.llm import test_contamination, test_simhash, test_suffix_dedup
from tests.llm.data import DOCS, prose

SPLIT, OPEN = "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes"


@pytest.fixture()
def docs(spark, tmp_path, monkeypatch):
    """Files of unlike sizes, cut into many, one or a few partitions, by turns after every store."""
    r = random.Random(11)
    passage, item = prose(1, 90), prose(100, 20)
    rows = [(i, prose(20 + i, r.randint(5, 90)) + r.choice(["", " " + passage]) + r.choice(["", "", " " + item]), "en", "a", 0) for i in range(40)]
    rows += [(100 + i, *rows[i][1:]) for i in range(0, 40, 4)]
    for at, n in ((0, 3), (3, 22), (25, 5), (30, 20)):
        spark.createDataFrame(rows[at : at + n], DOCS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/d")
    turn = [0]

    def stored(df, name):
        out = store(df, name)
        turn[0] += 1
        spark.conf.set(SPLIT, "1" if turn[0] % 2 else "3")
        return out

    store = common.stored
    for module in (common, C, H, S):
        monkeypatch.setattr(module, "stored", stored)
    spark.conf.set(OPEN, "1")
    spark.conf.set(SPLIT, "50")
    yield spark.read.parquet(f"{tmp_path}/d")
    for k in (SPLIT, OPEN):
        spark.conf.unset(k)


def test_repeated_strings(docs):
    want = test_suffix_dedup.brute(docs.collect(), 200)
    assert sum(w[2] > 0 for w in want) > 10
    assert test_suffix_dedup.got(docs) == want


def test_near_duplicates(docs):
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    root = test_simhash.plain_components([test_simhash.plain_fingerprint(r.text) for r in rows])
    assert len(set(root)) < len(rows)
    assert sorted(r.doc_id for r in H.keep_one(docs).collect()) == [rows[i].doc_id for i in sorted(set(root))]


def test_contaminated(spark, docs):
    items = spark.createDataFrame([(1, prose(100, 20))], "item_id long, text string")
    want = [x[0] for x in test_contamination.brute(docs.collect(), items.collect()) if not x[5]]
    assert 0 < len(want) < docs.count()
    assert sorted(r.doc_id for r in C.keep_clean(docs, items).collect()) == sorted(want)
