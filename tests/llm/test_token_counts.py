"""Counts against the library on whole texts; the cache's bookkeeping."""

import random

import pytest
from pyspark.sql import functions as F

from riskweave.llm import token_counts as T
from riskweave.llm.queries import op4_token_counts
from riskweave.session import scratch_path
from tests.llm.data import awkward_docs, empty_docs, on_disk

NAME = "byte_bpe_50k.json"


def whole(texts):
    return T.Encoder(NAME).whole(texts)


def test_pieces_add_up_to_the_whole():
    r = random.Random(5)
    parts = [" ", "  ", "\n", "\n\n", "\t", "a", "bc.", "é", "12", "3,", "!!", "'s", "'", "<|endoftext|>", "中", "\x85", "\xa0", "​", "\x1c", "don't,", "<|", "x.\ny", "¹.", "ª,"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 16))) for _ in range(20_000)]
    assert T.Encoder(NAME, memo_entries=500).counts(texts) == whole(texts)


def test_table_texts_add_up(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert T.Encoder(NAME).counts(texts) == whole(texts)


def test_other_tokenizers_get_whole_texts():
    e = T.Encoder("word_bpe_49k.json")
    assert not e.piecewise and e.counts(["a b", ""]) == e.whole(["a b", ""])


@pytest.fixture
def encoded(spark, monkeypatch):
    """Rows that were encoded by each call."""
    seen, encode = [], T.encode_misses

    def counted(misses, name):
        seen.append(misses.count())
        return encode(misses, name)

    monkeypatch.setattr(T, "encode_misses", counted)
    return seen


def test_cache_is_asked_first(spark, encoded, monkeypatch):
    cache = scratch_path(spark, "test-cache")
    docs = awkward_docs(spark)
    distinct = len({r.text or "" for r in docs.collect()})
    first = T.count_tokens(docs, cache, NAME).collect()
    assert sorted(map(str, first)) == sorted(map(str, T.count_tokens(docs, cache, NAME).collect()))
    more = docs.union(spark.createDataFrame([(99, "a new text", "en", "a", 1)], docs.schema))
    got = T.count_tokens(more, cache, NAME).collect()
    assert encoded == [distinct, 0, 1]
    assert [r.n_tokens for r in got] == whole([r.text or "" for r in got])
    # another version never meets the old counts
    monkeypatch.setattr(T, "tokenizer_digest", lambda name: "other")
    T.count_tokens(docs, cache, NAME).collect()
    assert encoded[-1] == distinct
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("content_digest", "tokenizer_digest").distinct().count() == 2 * distinct + 1


def test_awkward_tables(spark):
    docs = awkward_docs(spark, clashing=True)
    out = T.count_tokens(docs, scratch_path(spark, "test-cache"), NAME)
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == docs.count()
    assert out.where(F.col("text").isNull() & (F.col("n_tokens") != 0)).count() == 0
    assert T.count_tokens(empty_docs(spark), scratch_path(spark, "test-cache"), NAME).count() == 0


def test_query_on_disk(spark, tmp_path):
    docs = on_disk(awkward_docs(spark), tmp_path)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = [(i, len(t.encode()), n, n > 512) for (i, t), n in zip(texts, whole([t for _, t in texts]), strict=True)]
    out = op4_token_counts(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
