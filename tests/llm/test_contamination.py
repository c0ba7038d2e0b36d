"""Decontamination against brute force over the same rows."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskweave.llm import contamination as C
from riskweave.llm.common import as_bytes
from riskweave.llm.queries import op1_decontamination
from tests.llm.data import awkward_docs, empty_docs, on_disk, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    wins = defaultdict(set)
    for r in items:
        w = words(r.text)
        for i in range(max(1, len(w) - 12) if w else 0):
            wins[tuple(w[i : i + 13])].add("" if r.item_id is None else str(r.item_id))
    out = []
    for r in docs:
        w, hit, found = words(r.text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in wins:
                    hit.update(range(i, i + n))
                    found |= wins[k]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((r.doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(docs, items):
    return sorted((tuple(r)[:6] for r in C.report(docs, items).collect()), key=str)


@pytest.fixture(scope="module")
def planted(spark):
    r = random.Random(3)
    items = [(i, prose(100 + i, r.choice([3, 12, 13, 14, 40]))) for i in range(25)] + [(3, "the only"), (None, "no id here at all"), (99, None), (98, " .. ")]
    docs = []
    for i in range(60):
        w = prose(500 + i, r.randint(0, 400)).split(" ")
        for _ in range(r.randint(0, 2)):
            x = (r.choice(items)[1] or "").split(" ")
            a = r.randint(0, max(0, len(x) - 5))
            at = r.randint(0, len(w))
            w[at:at] = x[a : a + r.choice([13, 14, 99])]
        docs.append((i, r.choice([" ", ", ", "\n"]).join(w), "en", "a", 0))
    # a passage that runs over the end of one document into the next is no match
    docs += [(70, prose(101, 40)[:100], "en", "a", 0), (71, prose(101, 40)[100:], "en", "a", 0)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").union(awkward_docs(spark))
    return docs, spark.createDataFrame([(*x, "e") for x in items], "item_id long, text string, doc_id string")


def test_matches_brute_force(planted):
    docs, items = planted
    want = brute(docs.collect(), items.collect())
    assert sum(w[5] for w in want) > 5
    assert got(docs, items) == want


def test_in_rounds(planted, monkeypatch):
    docs, items = planted
    monkeypatch.setattr(C, "MAX_WINDOWS", 60)
    assert got(docs, items) == brute(docs.collect(), items.collect())


def test_keep_clean(spark, planted):
    docs, items = planted
    want = [x[0] for x in brute(docs.collect(), items.collect()) if not x[5]]
    kept = C.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)
    clashing = awkward_docs(spark, clashing=True)
    assert C.keep_clean(clashing, items).columns == clashing.columns


def test_empty_tables(spark, planted):
    docs, items = planted
    assert C.report(empty_docs(spark), items).count() == 0
    nothing = C.report(docs, items.limit(0))
    assert nothing.count() == docs.count() and nothing.where("n_hit > 0 or contaminated").count() == 0


def test_tokens_of_long_texts(monkeypatch):
    """The same terms whatever the step, and equal terms for equal words only."""
    texts = [prose(9, 3000), "a" * 500 + " b", "", "É1 x"]
    raw, at = as_bytes(pa.array(texts))
    terms, first = C.tokens(raw, at)
    monkeypatch.setattr(C, "BLOCK_BYTES", 50)
    again, _ = C.tokens(raw, at)
    assert (terms == again).all() and np.diff(first).tolist() == [len(words(t)) for t in texts]
    all_words = [w for t in texts for w in words(t)]
    assert len({(w, int(t)) for w, t in zip(all_words, terms, strict=True)}) == len(set(all_words)) == len(set(terms.tolist()))


def near(lists, width):
    at = sorted({(p, k) for k, x in enumerate(lists) for p in x.tolist()})
    return {s for s, _ in at if all(any(s <= p < s + width for p in x.tolist()) for x in lists)}


def test_proximity_against_brute_force():
    r = random.Random(8)
    for _ in range(300):
        lists = [np.array(sorted(r.sample(range(60), r.randint(1, 6)))) for _ in range(r.randint(1, 4))]
        width = r.randint(1, 12)
        spans = C.near_spans(lists, width)
        assert bool(spans) == bool(near(lists, width))
        assert all(b - a <= width and all(((x >= a) & (x < b)).any() for x in lists) for a, b in spans)


def test_proximity_matches(spark):
    item = "alpha beta gamma delta"
    docs = ["delta x gamma y beta alpha", "alpha beta gamma x x x x x x x x delta", "alpha beta gamma delta"]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    out = C.report(frame, spark.createDataFrame([(1, item)], "item_id long, text string"), slop=2).orderBy("doc_id")
    assert [(r.n_items, r.n_near_items) for r in out.collect()] == [(0, 1), (0, 0), (1, 1)]
    assert out.where(F.col("n_hit") > 0).count() == 1


def test_proximity_in_adjacent_copies(spark):
    """Short copies side by side: stretches must be sought inside each document, also near its end."""
    r = random.Random(12)
    item = "alpha beta gamma delta"
    docs = [item] * 2 + ["alpha"] * 9
    for _ in range(120):
        text = " ".join(r.choice(item.split(" ") + ["x"]) for _ in range(r.randint(0, 12)))
        docs += [text] * r.randint(1, 3)
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1)
    for slop in (0, 3):
        out = C.report(frame, spark.createDataFrame([(1, item)], "item_id long, text string"), slop=slop).collect()
        want = [int(any(set(item.split(" ")) <= set(d.split(" ")[i : i + 4 + slop]) for i in range(len(d.split(" "))))) for d in docs]
        assert 10 < sum(want) < len(want)
        assert [r.n_near_items for r in sorted(out, key=lambda r: r.doc_id)] == want


def complements(n):
    """Two complementary Thue-Morse words: equal under every polynomial hash modulo a power of two."""
    a = "a"
    while len(a) < n:
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_words_of_one_pattern_are_parted(spark):
    a, b = complements(1024)
    frame = spark.createDataFrame([(1, a), (2, b), (3, a.upper())], "doc_id long, text string")
    out = C.report(frame, spark.createDataFrame([(1, b)], "item_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_hit, r.contaminated) for r in out] == [(0, False), (1, True), (0, False)]


def test_words_of_one_hash_are_compared(planted, monkeypatch):
    """With hashes of three bits everything collides and nothing changes."""
    monkeypatch.setattr(C, "hashes", lambda raw, starts, ends: ((ends - starts) % 8).astype(np.uint64))
    vocabulary = C.Vocabulary([b"one", b"two", b"three", b"x" * 11])
    raw, at = as_bytes(pa.array(["One two x three six " + "x" * 11 + " TWO"]))
    starts, ends, _ = C.word_bounds(raw, at)
    names = {n: w for w, n in vocabulary.number.items()} | {-1: b""}
    assert [names[n] for n in vocabulary.lookup(raw, starts, ends).tolist()] == [b"one", b"two", b"", b"three", b"", b"x" * 11, b"two"]


def test_query_on_disk(spark, planted, tmp_path):
    docs, items = planted
    on_disk(docs, tmp_path)
    on_disk(items, tmp_path, "benchmark")
    out = sorted((tuple(r)[:6] for r in op1_decontamination(spark, str(tmp_path)).collect()), key=str)
    assert out == brute(docs.collect(), items.collect())
