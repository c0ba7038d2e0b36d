"""Fingerprints, trees and components against brute force."""

import random
import re

import xxhash

from riskweave.llm import simhash as S
from riskweave.llm.components import stars
from riskweave.llm.queries import op7_simhash
from tests.llm.data import awkward_docs, empty_docs, on_disk, prose


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, radius=4):
    """Smallest index reachable from each."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(prints))]


def test_fingerprints():
    for text in ["", " \n", "One", "a b c", "A  b\tC d", prose(1, 300), "É é İ", "x " * 70_000]:
        assert S.fingerprint(text.encode()) == plain_fingerprint(text)


def test_tree_finds_all_within_radius():
    r = random.Random(2)
    base = [r.getrandbits(64) for _ in range(20)]
    values = list({b ^ sum(1 << r.randrange(64) for _ in range(r.randrange(7))) & (1 << 64) - 1 for b in base for _ in range(20)})
    tree = S.BKTree()
    for v in values:
        tree.add(v)
    for v in values[:60]:
        assert sorted(tree.within(v, 4)) == [i for i, w in enumerate(values) if (v ^ w).bit_count() <= 4]
    assert list(S.BKTree().within(5, 4)) == []


def test_blocks_of_bits_lose_no_link(spark):
    """Small shards, so several levels of splitting are used."""
    r = random.Random(4)
    prints = set()
    for _ in range(12):
        b = r.getrandbits(64)
        for _ in range(25):
            b ^= sum({1 << r.randrange(64) for _ in range(r.randrange(1, 6))})
            prints.add(b)
    prints = sorted(prints | {0, (1 << 64) - 1, 1, 3})
    frame = spark.createDataFrame([(S._signed(p),) for p in prints], "fp long")
    want = plain_components(prints)
    for limit in (15, 1024):
        found = {r.u: r.v for r in stars(S.links(frame, shard_limit=limit)).collect()}
        got = [found.get(S._signed(p), S._signed(p)) for p in prints]
        groups = {}
        for g, w in zip(got, want, strict=True):
            assert groups.setdefault(g, w) == w
        assert len(set(got)) == len(set(want))


def test_stars_of_paths_and_rings(spark):
    r = random.Random(1)
    path = list(range(-40, 40))
    r.shuffle(path)
    edges = list(zip(path, path[1:], strict=False)) + [(100, 101), (101, 100), (101, 101), (200, 200)]
    got = {(x.u, x.v) for x in stars(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(i, -40) for i in range(-39, 40)} | {(101, 100)}
    assert stars(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_rows(docs):
    rows = docs.collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    root = plain_components(prints)
    least = {}
    for r, c in zip(rows, root, strict=True):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    return sorted(((r.doc_id, f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, root, strict=True)), key=str), root, least


def check(spark, docs):
    want, root, least = plain_rows(docs)
    assert sorted((tuple(r) for r in S.near_duplicates(docs).collect()), key=str) == want
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([least.get(c) for c in set(root)], key=str)


def test_awkward_rows(spark):
    check(spark, awkward_docs(spark))
    check(spark, awkward_docs(spark, clashing=True))
    assert S.near_duplicates(empty_docs(spark)).count() == 0 and S.keep_one(empty_docs(spark)).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, docs)


def test_query(spark, tmp_path):
    docs = on_disk(awkward_docs(spark), tmp_path)
    out = op7_simhash(spark, str(tmp_path))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain_rows(docs)[0]
