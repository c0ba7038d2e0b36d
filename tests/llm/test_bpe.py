"""Ids against the library, bytes against the texts."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from riskweave.llm import bpe as B
from riskweave.llm.queries import op12_byte_bpe
from tests.llm.data import awkward_docs, empty_docs, on_disk


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(B.VOCABULARY)


@pytest.fixture(scope="module")
def codec(ranks):
    return B.Encoder(ranks)


def library(ranks):
    import public_tokenizers

    return tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(codec, texts, ranks):
    ids, count = codec.encode(texts)
    got = [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
    encoding = library(ranks)
    assert got == [encoding.encode_ordinary(t) for t in texts]
    decoder = B.Decoder(ranks)
    assert [b"".join(decoder.decode(np.array(x, np.int32))) for x in got] == [t.encode() for t in texts]


def test_odd_texts(codec, ranks):
    r = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "the", "ing", "é", "ß", "12", "!!", "'s", "'ll", "'", "<|endoftext|>", "中文", "ру", "\x85", "\xa0", "\x1c", "​", "\U0003fc3b", "՘", "\U00011de0", "😀", "\x00", "Q7z", "==="]
    check(codec, ["", *("".join(r.choice(parts) for _ in range(r.randint(0, 20))) for _ in range(5000))], ranks)


def test_every_character_is_split_alike(codec, ranks):
    points = [chr(c) for c in (*range(0, 0xD800, 3), *range(0xE000, 0x20000, 31))]
    check(codec, ["".join(f"a{c} 1{c}{c}" for c in points[k : k + 400]) for k in range(0, len(points), 400)], ranks)


def test_long_words(codec, ranks):
    r = random.Random(4)
    letters = "etaoinshrdlucmfwypvbgkjqxz"
    check(codec, ["a" * 30_000, "ab" * 2000 + "!", "".join(r.choice(letters) for _ in range(400)), "".join(r.choice("the in") for _ in range(900)).replace(" ", ""), "中" * 1000], ranks)


def test_unsafe_pairs_are_contracted_one_by_one():
    """A vocabulary in which a merged token's next merge comes before its own rank."""
    ranks = {bytes([i]): i for i in range(256)} | {b"aba": 256, b"ab": 257, b"abab": 258, b"ba": 300}
    check(B.Encoder(ranks), ["ab" * n + "a" * k for n in (1, 2, 3, 70, 200) for k in (0, 1, 2)], ranks)


def test_small_memo_and_steps(ranks, monkeypatch):
    monkeypatch.setattr(B, "STEP_WORDS", 7)
    monkeypatch.setattr(B, "QUERY_WORDS", 3)
    monkeypatch.setattr(B, "QUERY_TOKENS", 5)
    r = random.Random(6)
    check(B.Encoder(ranks, memo_words=20), [" ".join(r.choice(["one", "twotwo", "xyzzyq", "ünter"]) + str(r.randint(0, 99)) for _ in range(r.randint(0, 30))) for _ in range(60)], ranks)


def test_unknown_id_is_an_error(ranks):
    with pytest.raises(ValueError, match="outside"):
        list(B.Decoder(ranks).decode(np.array([5, 60_000], np.int32)))


def test_frames(spark, ranks):
    docs = awkward_docs(spark, clashing=True)
    out = B.decode(B.encode(docs))
    assert out.columns == [*docs.columns, "ids", "bytes"] and out.count() == docs.count()
    assert out.where(F.col("bytes") != F.encode(F.coalesce("text", F.lit("")), "utf-8")).count() == 0
    # a column of the result's name is replaced
    assert B.encode(docs, ids="tokens").schema["tokens"].dataType.simpleString() == "array<int>"
    nothing = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.bytes for r in B.decode(nothing).collect()] == [b"", b""]
    assert B.decode(B.encode(empty_docs(spark))).count() == 0


def test_query_on_disk(spark, ranks, tmp_path):
    docs = on_disk(awkward_docs(spark), tmp_path)
    encoding = library(ranks)
    want = []
    for r in docs.collect():
        ids = encoding.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in op12_byte_bpe(spark, str(tmp_path)).collect())
