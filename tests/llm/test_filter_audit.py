"""The audit against a plain walk over every order."""

import re
from itertools import permutations

import pytest

from riskweave.llm import filter_audit as A
from riskweave.llm.queries import op11_filter_audit
from tests.llm.data import awkward_docs, empty_docs, on_disk, prose

LABELS = "doc_id long, quality int, toxic int"
LABEL_ROWS = [(1, 1, 0), (4, 1, 1), (5, 0, 1), (8, 1, None), (8, 0, 1), (12, 1, 0), (None, 1, 1), (99, 1, 1)]


def plain(docs, labels):
    def fails(r):
        t = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        twin = any((o.text or "") == t and o.doc_id is not None and r.doc_id is not None and o.doc_id < r.doc_id for o in docs)
        return {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": twin,
        }

    rows = [(r, fails(r)) for r in docs]
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))
    out = []
    for part in {r.lang or "" for r in docs}:
        own = [x for x in rows if (x[0].lang or "") == part]
        walked, share = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left, gone = own, []
            for step, x in enumerate(order, 1):
                here = [y for y in left if y[1][x]]
                left = [y for y in left if not y[1][x]]
                share[x] += len(here)
                walked.append([part, order, step, len(left), len(here), sum(y[1][x] for y in gone), sum(y[1][x] and sum(y[1].values()) == 1 for y in own), sum(y[0].doc_id in good for y in here), sum(y[0].doc_id in toxic for y in here)])
                gone = gone + here
        out += [(*w, share[w[1][w[2] - 1]]) for w in walked]
    return sorted(out)


def more_docs(spark, docs):
    copy = " ".join(["Again and Again"] * 100) + " $"
    varied = " ".join(f"w{k}" for k in range(300))
    rows = [(20 + k, copy, "en", "a", 1) for k in range(60)] + [(200 - k, copy, "fr", "a", 1) for k in range(60)] + [(7, varied, "en", "a", 1), (12, varied, "en", "b", 1), (13, varied + " |", "en", "b", 1), (13, varied + " |", "de", "b", 1), (14, prose(9, 500), "es", "a", 1), (15, "ABC" + varied, "en", "a", 2), (None, varied, None, "a", 2)]
    extra = spark.createDataFrame([(*r, *[None] * (len(docs.columns) - 5)) for r in rows], docs.schema)
    return docs.union(extra)


@pytest.mark.parametrize("chunk", [7, 100])
def test_against_plain_walk(spark, chunk):
    docs = more_docs(spark, awkward_docs(spark, clashing=True))
    got = A.audit(docs, spark.createDataFrame(LABEL_ROWS, LABELS), least_chunk=chunk)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == plain(docs.collect(), LABEL_ROWS)


def test_equal_hash_of_other_text_is_no_duplicate(spark, monkeypatch):
    """With one hash for all rows only the exact text decides."""
    same = A.F.xxhash64
    monkeypatch.setattr(A.F, "xxhash64", lambda *c: A.F.lit(7).cast("long") if c == ("text",) else same(*c))
    docs = more_docs(spark, awkward_docs(spark))
    got = A.audit(docs, spark.createDataFrame(LABEL_ROWS, LABELS), least_chunk=9)
    assert sorted(map(tuple, got.collect())) == plain(docs.collect(), LABEL_ROWS)


def test_query_on_disk(spark, tmp_path):
    docs = on_disk(more_docs(spark, awkward_docs(spark)), tmp_path)
    on_disk(spark.createDataFrame(LABEL_ROWS, LABELS), tmp_path, "labels")
    assert sorted(map(tuple, op11_filter_audit(spark, str(tmp_path)).collect())) == plain(docs.collect(), LABEL_ROWS)


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert A.audit(empty_docs(spark), none).count() == 0
    out = A.audit(awkward_docs(spark), none)
    assert out.count() == 600 * 5 and out.where("good_lost + toxic_lost > 0").count() == 0
