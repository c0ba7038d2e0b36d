"""Byte-level BPE encoding and decoding by DuckDB queries inside the tasks.

A text is split by the vocabulary's pattern. A match that is a vocabulary entry is that token;
any other is contracted: its leftmost pair of neighbours with the smallest merged rank becomes one
token, until no pair is in the merge table. Decoding joins the ids to the vocabulary and
aggregates the bytes in the order of the positions.

The contraction is a recursive query over the distinct words of a step: the tokens of a word are
unnested to rows of positions, joined to the merge table, the smallest (rank, position) of a word
is contracted and the row goes to the next round. Words are cut first where no vocabulary entry
holds the two bytes side by side, since no merge can cross such a place. Segments over LONG bytes
stay rows of positions; a round there contracts all non-overlapping places of the smallest pair at
once where the vocabulary proves that this is the same (no pair with the merged token has a
smaller rank), else the leftmost alone, and a query ends after DEPTH rounds to bound its rows.

The merge table holds every split of an entry into two entries, as the library merges by the
bytes of the result. Character classes of the pattern are asked of the library itself, whose
Unicode tables are not those of the regex module; texts without a character on which the two
differ take the faster engine.

Defined cases: null and empty texts have no tokens, and no ids decode to no bytes; a null list of
ids counts as empty; an id outside the vocabulary is an error; special strings are ordinary text;
copies, ties and repeated rows are encoded alike; all other columns stay as they are, ids or bytes
replace a column of the result's name; an empty table gives an empty table. Very long texts are
split in steps of STEP_WORDS matches; a very long word costs its length times its rounds.

Scale: texts and ids are not shuffled. A worker holds one batch, the words of one step, the ids of
at most MEMO_WORDS distinct words, and a DuckDB database with a memory limit that never spills.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import as_bytes, blocks, bounded_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MEMO_WORDS = 500_000
STEP_WORDS = 250_000
QUERY_WORDS = 50_000
QUERY_TOKENS = 100_000
LONG = 128
DEPTH = 16
MEMORY = "200MB"
BATCH_BYTES = 8 << 20
TEXT_BYTES = 1_000_000

CONTRACT = """
WITH RECURSIVE t(word, ids, round) AS (
  SELECT word, ids, 0 FROM start
  UNION ALL
  SELECT t.word, ids[:i - 1] || [m] || ids[i + 2:], round + 1 FROM t JOIN (
    SELECT word, min(x.m::BIGINT * 4294967296 + i) AS least, (least // 4294967296)::INTEGER AS m, least % 4294967296 AS i
    FROM (SELECT word, unnest(ids[:-2]) AS l, unnest(ids[2:]) AS r, unnest(range(1, len(ids))) AS i FROM t) p
    JOIN merges x ON x.l = p.l AND x.r = p.r GROUP BY word) b ON t.word = b.word)
SELECT word, arg_max(ids, round) AS ids FROM t GROUP BY word ORDER BY word"""

# the same by rows of positions, for long words; `run` numbers stretches of overlapping places
CONTRACT_LONG = f"""
WITH RECURSIVE t(word, pos, id, round, live) AS (
  SELECT word, pos, id, 0, true FROM start
  UNION ALL
  SELECT word, pos, CASE WHEN take THEN best ELSE id END, round + 1, best IS NOT NULL FROM (
    SELECT *, lag(take, 1, false) OVER (PARTITION BY word ORDER BY pos) AS eaten FROM (
      SELECT *, coalesce(m = best AND CASE WHEN alike THEN row_number() OVER (PARTITION BY word, m, run ORDER BY pos) % 2 = 1
          ELSE pos = leftmost END, false) AS take FROM (
        SELECT *, min(CASE WHEN m = best THEN pos END) OVER (PARTITION BY word) AS leftmost,
          nr - row_number() OVER (PARTITION BY word, m ORDER BY pos) AS run FROM (
          SELECT p.*, x.m, x.alike, min(x.m) OVER (PARTITION BY word) AS best FROM (
            SELECT word, pos, id, round, lead(id) OVER w AS after, row_number() OVER w AS nr FROM t
            WHERE live AND round < {DEPTH} WINDOW w AS (PARTITION BY word ORDER BY pos)) p
          LEFT JOIN merges x ON x.l = p.id AND x.r = p.after))))
  WHERE NOT eaten)
SELECT word, pos, id, live FROM t QUALIFY round = max(round) OVER (PARTITION BY word) ORDER BY word, pos"""

DECODE = "SELECT row, list(bytes ORDER BY pos) AS bytes FROM tokens JOIN vocabulary USING (id) GROUP BY row ORDER BY row"


def read_ranks(name: str) -> dict[bytes, int]:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _class(chars: str) -> str:
    """Members as ranges of a character class."""
    points = np.array(sorted(map(ord, chars)))
    first = np.flatnonzero(np.append(True, np.diff(points) != 1))
    last = np.append(first[1:], len(points)) - 1
    return "".join(f"\\U{points[a]:08x}-\\U{points[b]:08x}" for a, b in zip(first, last, strict=True))


class Splitter:
    """Matches of public_tokenizers.PATTERN as the tiktoken library finds them."""

    def __init__(self):
        import public_tokenizers
        import regex
        from tiktoken._tiktoken import CoreBPE

        pattern = public_tokenizers.PATTERN
        every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
        single = {bytes([i]): i for i in range(256)}
        known, disputed = {}, set()
        for name in (r"\p{L}", r"\p{N}", r"\s"):
            members = bytes(CoreBPE(single, {}, name).encode_ordinary(every)).decode()
            known[name] = _class(members)
            disputed |= set(members) ^ set(regex.findall(name, every))
        self.disputed = re.compile(f"[{_class(''.join(disputed))}]") if disputed else None
        self.narrow = not disputed or min(disputed) > "\xff"
        self.fast = regex.compile(pattern)
        letters, digits, space = known.values()
        exact = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{digits}]").replace(r"\S", f"[^{space}]")
        for name, members in known.items():
            exact = exact.replace(name, f"[{members}]")
        self.exact = re.compile(exact)

    def engine(self, text: str):
        # most texts are settled by one quick test
        if self.narrow and (text.isascii() or len(text.encode("latin-1", "ignore")) == len(text)):
            return self.fast
        return self.exact if self.disputed and self.disputed.search(text) else self.fast

    def steps(self, text: str, most: int = STEP_WORDS) -> Iterator[list[str]]:
        engine = self.engine(text)
        if len(text) <= most:
            yield engine.findall(text)
            return
        found = (m.group() for m in engine.finditer(text))
        while part := list(islice(found, most)):
            yield part


class Database:
    """A worker's DuckDB database with the vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb

        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self.table("vocabulary", id=pa.array(list(ranks.values()), pa.int32()), bytes=pa.array(list(ranks), pa.binary()))

    def table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS FROM given")
        self.db.unregister("given")

    def ask(self, sql: str, name: str, **columns) -> pa.Table:
        self.db.register(name, pa.table(columns))
        out = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return out


class Encoder(Database):
    """Vocabulary, merge table and the memo of a worker."""

    def __init__(self, ranks: dict[bytes, int], memo_words: int = MEMO_WORDS):
        super().__init__(ranks)
        self.ranks, self.memo_words, self.splitter = ranks, memo_words, Splitter()
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = [(ranks[k[:i]], ranks[k[i:]], m) for k, m in ranks.items() for i in range(1, len(k)) if k[:i] in ranks and k[i:] in ranks]
        least: dict[int, int] = {}
        for l, r, m in pairs:  # noqa: E741
            least[l] = min(least.get(l, m), m)
            least[r] = min(least.get(r, m), m)
        self.beside = np.zeros((256, 256), bool)
        for k in ranks:
            b = np.frombuffer(k, np.uint8)
            self.beside[b[:-1], b[1:]] = True
        l, r, m = (pa.array(x, pa.int32()) for x in (list(zip(*pairs, strict=True)) or [()] * 3))  # noqa: E741
        self.table("merges", l=l, r=r, m=m, alike=pa.array([least.get(x[2], x[2] + 1) > x[2] for x in pairs], pa.bool_()))
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.flat, self.ptr = np.empty(0, np.int32), np.zeros(1, np.int64)

    def contract(self, raw: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words as bytes, `first` where each begins -> ids of all words and how many each has."""
        cut = np.ones(len(raw), bool)
        cut[1:] = ~self.beside[raw[:-1], raw[1:]]
        cut[first] = True
        begin = np.flatnonzero(cut)
        size = np.diff(np.append(begin, len(raw)))
        ids, count = self.byte_id[raw], np.zeros(len(begin), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for chosen, solve in ((np.flatnonzero(size <= LONG), self._short), (np.flatnonzero(size > LONG), self._long)):
            for at in range(0, len(chosen), QUERY_WORDS):
                part = chosen[at : at + QUERY_WORDS]
                own = size[part]
                where = np.repeat(begin[part] - np.cumsum(own) + own, own) + np.arange(own.sum())
                out, count[part] = solve(ids[where], own)
                parts.append((np.repeat(part, count[part]), out))
        segment, out = (np.concatenate(x) for x in zip(*parts, strict=True))
        of_word = np.searchsorted(first, begin, side="right") - 1
        return out[np.argsort(segment, kind="stable")], np.bincount(of_word, count, len(first)).astype(np.int64)

    def _short(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(ids))
        done = self.ask(CONTRACT, "start", word=np.arange(len(size), dtype=np.int32), ids=rows)["ids"].combine_chunks()
        return done.flatten().to_numpy(), np.diff(done.offsets.to_numpy())

    def _long(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        now = {"word": pa.array(np.repeat(np.arange(len(size)), size)), "pos": pa.array(np.arange(len(ids))), "id": pa.array(ids)}
        while True:
            out = self.ask(CONTRACT_LONG, "start", **now)
            now = {c: out[c] for c in now}
            if not any(out["live"].to_pylist()):
                return now["id"].to_numpy(), np.bincount(now["word"].to_numpy(), minlength=len(size))

    def learn(self, words: list[str]) -> None:
        """Add the ids of new words to the memo."""
        known, rest = [], []
        for w in words:
            (known if w.encode() in self.ranks else rest).append(w)
        ids, count = [np.array([self.ranks[w.encode()] for w in known], np.int32)], [np.ones(len(known), np.int64)]
        for at in range(0, len(rest), QUERY_WORDS):
            raws = [w.encode() for w in rest[at : at + QUERY_WORDS]]
            first = np.cumsum([0, *map(len, raws)])[:-1]
            got = self.contract(np.frombuffer(b"".join(raws), np.uint8), first)
            ids.append(got[0])
            count.append(got[1])
        n = len(self.numbers)
        self.numbers.update(zip(known + rest, range(n, n + len(words)), strict=True))
        self.ptr = np.append(self.ptr, self.ptr[-1] + np.cumsum(np.concatenate(count)))
        self.flat = np.concatenate([self.flat, *ids])

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of a row of words, and how many each word has."""
        distinct = set(words)
        if len(self.numbers) + len(distinct) > self.memo_words:
            self.forget()
        if new := [w for w in distinct if w not in self.numbers]:
            self.learn(new)
        number = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        begin, count = self.ptr[number], self.ptr[number + 1] - self.ptr[number]
        return self.flat[np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())], count

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts, and how many each text has."""
        total, out = np.zeros(len(texts), np.int64), []
        waiting: list[str] = []
        owner: list[tuple[int, int]] = []

        def flush() -> None:
            ids, count = self.ids(waiting)
            out.append(ids)
            np.add.at(total, np.repeat([o[0] for o in owner], [o[1] for o in owner]), count)
            waiting.clear()
            owner.clear()

        for k, text in enumerate(texts):
            for words in self.splitter.steps(text):
                if waiting and len(waiting) + len(words) > STEP_WORDS:
                    flush()
                waiting += words
                owner.append((k, len(words)))
        if waiting:
            flush()
        return np.concatenate([np.empty(0, np.int32), *out]), total


class Decoder(Database):
    """The bytes of ids, by the vocabulary."""

    def decode(self, ids: np.ndarray) -> Iterator[bytes]:
        """The bytes of a row of ids, in pieces."""
        for at in range(0, len(ids), QUERY_TOKENS):
            yield from self.decode_rows(ids[at : at + QUERY_TOKENS], np.zeros(len(ids[at : at + QUERY_TOKENS]), np.int32), 1)

    def decode_rows(self, ids: np.ndarray, row: np.ndarray, rows: int) -> list[bytes]:
        out = self.ask(DECODE, "tokens", row=row, pos=np.arange(len(ids)), id=ids)
        found = out["bytes"].combine_chunks()
        if len(found.values) != len(ids):
            raise ValueError("an id outside the vocabulary")
        # the bytes of a list's entries lie side by side
        raw, offsets = as_bytes(found.flatten())
        at = offsets[found.offsets.to_numpy() - found.offsets[0].as_py()]
        texts = [b""] * rows
        for k, a, b in zip(out["row"].to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
            texts[k] = raw[a:b].tobytes()
        return texts


@cache
def worker_encoder(vocabulary: str) -> Encoder:
    """One encoder for the tasks of a Python worker."""
    return Encoder(read_ranks(vocabulary))


@cache
def worker_decoder(vocabulary: str) -> Decoder:
    return Decoder(read_ranks(vocabulary))


def _bounded_rows(size: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Rows in steps of at most `limit` in size, a larger row alone."""
    total, row = np.append(0, np.cumsum(size)), 0
    while row < len(size):
        end = max(int(np.searchsorted(total, total[row] + limit, side="right")) - 1, row + 1)
        yield row, end
        row = end


def encoded(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """The ids of a text column, array<int>."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_encoder(vocabulary)
        for batch in batches:
            parts = [encoder.encode([x or "" for x in batch.slice(lo, hi - lo).to_pylist()]) for lo, hi, _, _ in blocks(batch, TEXT_BYTES)]
            ids, count = (np.concatenate(x) for x in (zip(*parts, strict=True) if parts else ([np.empty(0, np.int32)], [np.empty(0, np.int64)])))
            yield pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)), pa.int32()), pa.array(ids))

    return encode(text)


def decoded(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The bytes of a column of ids, binary."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = worker_decoder(vocabulary)
        for batch in batches:
            batch = batch.fill_null(pa.scalar([], batch.type)) if batch.null_count else batch
            offsets = batch.offsets.to_numpy()
            flat = batch.values.to_numpy(zero_copy_only=False)
            texts: list[bytes] = []
            for lo, hi in _bounded_rows(np.diff(offsets), QUERY_TOKENS):
                own = flat[offsets[lo] : offsets[hi]]
                if len(own) > QUERY_TOKENS:
                    texts.append(b"".join(decoder.decode(own)))
                else:
                    row = np.repeat(np.arange(hi - lo, dtype=np.int32), np.diff(offsets[lo : hi + 1]))
                    texts += decoder.decode_rows(own, row, hi - lo)
            yield pa.array(texts, pa.binary())

    return decode(ids)


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """docs with the ids of their texts."""
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    return docs.withColumn(ids, encoded(F.col(text), vocabulary))


def decode(rows: DataFrame, ids: str = "ids", out: str = "bytes", vocabulary: str = VOCABULARY) -> DataFrame:
    """rows with the bytes that their ids stand for."""
    bounded_batches(rows.sparkSession, BATCH_BYTES)
    return rows.withColumn(out, decoded(F.col(ids), vocabulary))


__all__ = ["Splitter", "Encoder", "Decoder", "encoded", "decoded", "encode", "decode"]
