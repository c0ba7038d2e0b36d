"""Repeated strings against brute force over all positions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import suffix_dedup as S
from riskweave.llm.common import packed, stored
from riskweave.llm.queries import op6_suffix_dedup
from tests.llm.data import awkward_docs, empty_docs, on_disk


def brute(rows, length):
    texts = [(r.doc_id, (r.text or "").encode()) for r in rows]
    count = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), len(b) - len(left), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def got(docs, **kw):
    return sorted((tuple(r) for r in S.cut_documents(docs, **kw).collect()), key=str)


@pytest.fixture(scope="module")
def corpus(spark):
    """Passages of many lengths in many surroundings, overlaps, runs of one byte, a common line."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcé ") for _ in range(r.randint(1, 9)))
    fresh = lambda n: "".join(word() for _ in range(n))
    passages = [fresh(r.randint(5, 200)) for _ in range(12)]
    line = fresh(60)[:230]
    rows = []
    for i in range(150):
        parts = [fresh(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 2)
            parts += [p[a : a + r.randint(20, len(p))], fresh(r.randint(0, 12))]
        if i % 3 == 0:
            parts.insert(r.randint(0, len(parts)), line)
        rows.append((i, "".join(parts), "en", "a", 0))
    rows += [(200, "a" * 450, "en", "a", 0), (201, "ab" * 300, "en", "a", 0), (202, "a" * 199, "en", "a", 0), (203, "a" * 200, "en", "a", 0), (204, "xyz" * 66 + "x", "en", "a", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)


def test_matches_brute_force(spark, corpus, tmp_path):
    corpus.write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    want = brute(docs.collect(), 200)
    assert sum(w[2] > 0 for w in want) > 50
    assert got(docs) == want
    # every gram with over three blocks is cut by ranges, down to single strings
    assert got(docs, limit=3) == want


def test_awkward_rows(spark):
    docs = awkward_docs(spark, clashing=True)
    assert got(docs) == brute(docs.collect(), 200)
    assert got(empty_docs(spark)) == []
    kept = {r.doc_id: bytes(r.kept) for r in S.cut_documents(docs, kept=True).collect()}
    assert kept[6] == b"One word" and kept[2] == b""


def test_long_texts_are_cut_in_steps(monkeypatch):
    r = np.random.default_rng(2)
    raw = r.integers(97, 99, 5000).astype(np.uint8)
    raw[3000:3400] = raw[100:500]
    at = np.array([0, 2000, 2000, 5000])

    def starts(found):
        seen = Counter()
        for g, b, _, f, _, s in zip(*(x.tolist() for x in found), strict=True):
            assert s >= 0 and g is not None and b is not None
            seen.update(range(f, f + s + 1))
        return seen

    whole = starts(S.anchored_blocks(raw, at))
    assert set(whole.values()) == {1} and len(whole) == 5000 - 2 * 199
    monkeypatch.setattr(S, "CHUNK", 700)
    assert starts(S.anchored_blocks(raw, at)) == whole


def test_common_prefixes():
    r = np.random.default_rng(3)
    rows = r.integers(0, 2, (60, 24)).astype(np.uint8)
    group = np.sort(r.integers(0, 4, 60))
    order, common = S.right_order(np.ascontiguousarray(rows).view(">u8").astype(np.uint64), group)
    text = [bytes(x) for x in rows]
    assert [(group[i], text[i]) for i in order] == sorted((g, t) for g, t in zip(group, text, strict=True))
    for k in range(1, 60):
        a, b = text[order[k - 1]], text[order[k]]
        same = next((i for i in range(24) if a[i] != b[i]), 24)
        assert common[k] == (same if group[order[k]] == group[order[k - 1]] else -1)


def test_runs_are_merged():
    r = np.random.default_rng(5)
    for _ in range(40):
        n, symbols = int(r.integers(1, 80)), int(r.integers(2, 4))
        rows = (r.integers(0, symbols, (n, 24)) * r.choice([1, 85])).astype(np.uint8)
        rows[:, :16] *= r.random((n, 16)) < 0.2
        group, run = r.integers(0, 3, n), r.integers(0, 4, n)
        # each run is in order, gram by gram; runs of a group follow each other
        at = sorted(range(n), key=lambda i: (group[i], run[i], bytes(rows[i])))
        rows, group, run = rows[at], group[at], run[at]
        words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
        known = S.run_prefixes(words, group * 10 + run)
        order, common = S.right_order(words, group, known)
        text = [bytes(x) for x in rows]
        assert sorted(order.tolist()) == list(range(n))
        assert [(group[i], text[i]) for i in order] == sorted((g, t) for g, t in zip(group, text, strict=True))
        for k in range(1, n):
            a, b = text[order[k - 1]], text[order[k]]
            same = next((i for i in range(24) if a[i] != b[i]), 24)
            assert common[k] == (same if group[order[k]] == group[order[k - 1]] else -1)


def test_symbols_that_differ_in_every_bit():
    for same in range(8):
        differ = np.array([(1 << (64 - 8 * same)) - 1], np.uint64)
        assert S.leading_equal(differ).tolist() == [same]


def test_shards_are_in_order(spark, corpus):
    docs = corpus.where("doc_id < 60").select(F.monotonically_increasing_id().alias("doc"), packed(F.col("text")).alias("text"))
    docs = stored(docs, "texts")
    found = stored(S.occurrences(docs, 200), "blocks").withColumn("n", F.lit(1).cast("long"))
    runs = S.shard_orders(S.block_bytes(found, docs, 200).repartition(5), 200).collect()
    assert len({x.run for x in runs}) > 1
    before = None
    for x in sorted(runs, key=lambda x: (x.run, x.place)):
        right = bytes(x.bytes[x.left_ :])
        if before and before[:2] == (x.run, x.gram):
            assert before[2] <= right
            shared = next((i for i, (a, b) in enumerate(zip(before[2], right, strict=False)) if a != b), None)
            assert x.known == shared if shared is not None else x.known >= min(len(right), len(before[2]))
        else:
            assert x.known == -1
        before = (x.run, x.gram, right)


def test_blocks_of_one_hash_are_parted(spark, tmp_path):
    # complementary Thue-Morse words agree under every polynomial modulo 2**64
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, "x" * 100 + word), (2, "x" * 100 + other), (3, word[:1500]), (4, "y" + other[300:1900])]
    spark.createDataFrame([(*r, "en", "a", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    assert got(docs) == got(docs, limit=2) == brute(docs.collect(), 200)


def test_runs_that_touch_are_one():
    begin, end = S.removed_spans(np.array([300, 0, 5]), np.array([300, 2, 100]), 200)
    assert begin.tolist() == [0] and end.tolist() == [500]
    begin, end = S.removed_spans(np.array([0, 201]), np.array([0, 201]), 200)
    assert begin.tolist() == [0, 201] and end.tolist() == [200, 401]


def test_query_on_disk(spark, tmp_path):
    docs = on_disk(awkward_docs(spark), tmp_path)
    out = op6_suffix_dedup(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(docs.collect(), 200)
