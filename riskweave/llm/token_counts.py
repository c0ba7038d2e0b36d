"""Token counts through a digest cache.

The cache is a Parquet table (content_digest, tokenizer_digest, n_tokens) in a shared folder.
Counting joins documents to it by the SHA-256 of their normalised content (null is the empty
text; nothing else is changed, as that would change counts) and by the digest of tokenizer file
and library version. Only distinct texts that miss are encoded; their counts are appended. A new
tokenizer file or library version has another digest, so it never meets old counts.

Encoding: byte-level BPE never merges across pre-tokens, and with the pattern of these tokenizers
a space between two characters that are no white space always begins a pre-token, a lone line
feed between such characters is one, and so is a mark after a letter. Texts are cut there, and
the library encodes each distinct piece once while a worker's bounded memo holds its count. The
sum is the count of the whole text (tests hold it against whole encodings).
A tokenizer of another kind is given whole texts.

Defined cases: null text counts as empty (0 tokens); repeated rows and copies share one count;
extra columns pass through; an empty table gives an empty table and leaves the cache as it is.
Two runs that append at once may store a count twice; reading takes one per digest.

Scale: texts move once, compressed, deduplicated before and after the shuffle, so a group of copies is one
row per task; counts are joined back by digest without texts. A worker holds a batch of texts
and at most MEMO_ENTRIES piece counts (about 200 MB) beside one text's pieces.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import bounded_batches, fresh_name, packed, stored, unpacked

MEMO_ENTRIES = 2_000_000
CACHE_SCHEMA = "content_digest string, tokenizer_digest string, n_tokens long"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_digest(name: str) -> str:
    import tokenizers

    with open(tokenizer_path(name), "rb") as f:
        return hashlib.sha256(f.read() + b"\0" + tokenizers.__version__.encode()).hexdigest()


def content_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


class Encoder:
    """Token counts of texts by the tokenizers library, with memos of piece counts."""

    def __init__(self, name: str, memo_entries: int = MEMO_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        kind = self.tokenizer.pre_tokenizer
        # only for this pre-tokenizer the cuts below are proven
        self.piecewise = kind is not None and re.match(r"ByteLevel\(add_prefix_space=False.*use_regex=True", repr(kind)) is not None and self.tokenizer.normalizer is None
        self.memo: dict[str, int] = {}  # by piece
        self.after_space: dict[str, int] = {}  # by piece without its leading space
        self.memo_entries = memo_entries

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def pieces(text: str) -> list[str]:
        """text cut before every space that has no white space beside it."""
        parts = text.split(" ")
        out = [parts[0]]
        for p in parts[1:]:
            last = out[-1]
            # str.isspace knows more kinds of white space than any regex class: such an edge is not cut
            if p and last and not p[0].isspace() and not last[-1].isspace():
                out.append(" " + p)
            else:
                out[-1] = last + " " + p
        return out

    def fill(self, pieces: set[str]) -> None:
        """Count pieces into the memo. A mark that ends a piece after a letter is a pre-token of
        its own, so the piece without it is encoded."""
        cut = {p: p[:-1] for p in pieces if len(p) > 1 and p[-1] in ".,;:!?" and p[-2] <= "\xff" and p[-2].isalpha()}
        need = [p for p in {*(pieces - cut.keys()), *cut.values(), *(p[-1] for p in cut)} if p not in self.memo]
        self.memo.update(zip(need, self.whole(need), strict=True))
        for p, core in cut.items():
            self.memo[p] = self.memo[core] + self.memo[p[-1]]

    def by_piece(self, pieces: list[str]) -> int:
        if missing := {p for p in pieces if p not in self.memo}:
            self.fill(missing)
        return sum(map(self.memo.__getitem__, pieces))

    def count(self, text: str) -> int:
        lines = text.split("\n")
        words = [line.split(" ") for line in lines]
        # a line feed between two characters that are no white space is a pre-token of its own
        if not all(w == line.split() for w, line in zip(words, lines, strict=True)):
            return self.by_piece(self.pieces(text))
        total = self.by_piece([*(w[0] for w in words), *["\n"] * (len(lines) - 1)])
        rest = [p for w in words for p in w[1:]] if len(words) > 1 else words[0][1:]
        got = list(map(self.after_space.get, rest))
        if None in got:
            missing = {p for p, n in zip(rest, got, strict=True) if n is None}
            self.fill({piece for p in missing if (piece := " " + p) not in self.memo})
            self.after_space.update((p, self.memo[" " + p]) for p in missing)
            got = map(self.after_space.__getitem__, rest)
        return total + sum(got)

    def counts(self, texts: list[str]) -> list[int]:
        if not self.piecewise:
            return self.whole(texts)
        out = []
        for text in texts:
            out.append(self.count(text))
            if len(self.memo) + len(self.after_space) > self.memo_entries:
                self.memo.clear()
                self.after_space.clear()
        return out


@cache
def worker_encoder(name: str) -> Encoder:
    """One encoder for the tasks of a Python worker."""
    return Encoder(name)


def encode_misses(misses: DataFrame, name: str) -> DataFrame:
    """(content_digest, packed text) -> (content_digest, n_tokens)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(name)
        for batch in batches:
            digests, texts = batch.column(0), unpacked(batch.column(1))
            for at in range(0, batch.num_rows, 64):
                counts = encoder.counts([t.decode() for t in islice(texts, 64)])
                yield pa.RecordBatch.from_arrays([digests.slice(at, 64), pa.array(counts, pa.int64())], ["content_digest", "n_tokens"])

    return misses.mapInArrow(encode, "content_digest string, n_tokens long")


def read_cache(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    return stored.where(F.col("tokenizer_digest") == version).groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache_path: str, tokenizer: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """docs with n_tokens (replacing a column of that name), counted through the cache; without
    keep_text the text column is left out, so it does not travel with the counts."""
    spark = docs.sparkSession
    bounded_batches(spark)
    version = tokenizer_digest(tokenizer)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    digest = content_digest(F.col(text))
    # copies fall together first: the anti-join then needs no further shuffle of the texts
    texts = docs.select(digest.alias("content_digest"), packed(F.col(text)).alias("text")).dropDuplicates(["content_digest"])
    misses = texts.join(read_cache(spark, cache_path, version), "content_digest", "left_anti")
    encode_misses(misses, tokenizer).select("content_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens").write.mode("append").parquet(cache_path)
    key = fresh_name(docs, "content_digest")
    # stored: a shuffle of its own for the join lets a hot digest's documents be split
    known = stored(read_cache(spark, cache_path, version), "token-counts").withColumnRenamed("content_digest", key)
    base = docs.drop("n_tokens").withColumn(key, digest)
    if not keep_text:
        base = base.drop(text)
    return base.join(known, key, "left").drop(key)


__all__ = ["Encoder", "content_digest", "tokenizer_digest", "encode_misses", "read_cache", "count_tokens"]
