"""Benchmark decontamination by a positional inverted index.

Words are runs of [0-9a-z] and all characters beyond ASCII, after lower-casing A-Z; on UTF-8 bytes
that is a run of the bytes 0-9, a-z and 0x80-0xFF, so tokens are found by numpy on whole blocks of
documents. Words are looked up by a 64-bit hash, a sum of random numbers by position and byte, and
a word that meets the hash of a test word is compared with it byte by byte; a term is the number of
the equal test word, so matches are exact whatever the hashes do.

The index is a stored table, one row per block of documents (about BLOCK_BYTES of text, a longer
text is a block of its own): the documents and their word counts, the block's terms in order, and
for each term the sorted list of its word positions in the block. It holds the postings of test
words, for no other word can take part in a match.

Matching takes the test windows (13 words; a shorter item is one window) against every block: a
window one of whose terms the block lacks is out at once; else the list of its rarest term, moved
back by the term's offset, gives the possible starts, and the offset-adjusted lists of the other
terms, rarest first, are intersected with them. Proximity matches are stretches of at most
window + slop words of one document that hold all terms of a window in any order.

Defined cases: null texts have no words; a document without words is never contaminated; empty
items give no window; items that share an item_id are one item; a null item_id is shown as the
empty string; every row is a document of its own, repeated ones too; extra columns are ignored by
report() and pass through keep_clean(); an empty table on either side works.

Scale: documents are never shuffled; a task holds one block, and a common word's postings are
spread over the blocks. Test windows pass the driver in rounds of at most MAX_WINDOWS, each with
its words; a round is indexed, matched and stored before the next is read, so neither the driver
nor a plan holds more than one. Very long texts are blocks of their own, their words hashed in steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import BLOCK_BYTES, blocks, bounded_batches, fresh_name, numbered, stored
from riskweave.llm.hashing import mixed

WINDOW = 13
SLOP = 3
#: a document is contaminated if hit words are at least this share of its words
SHARE_OF = 20
# windows of a round, of 13 words each
MAX_WINDOWS = 150_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[65:91] = True
_WORD[128:] = True


_PLACES = 64
_TABLE = mixed(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(_PLACES, 256)


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of all words of a block in order, and the first word of every document (one
    entry more than documents)."""
    n = len(raw)
    if n == 0:
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = _WORD[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(word & (edge[:-1] | np.concatenate([[True], ~word[:-1]])))
    ends = np.flatnonzero(word & (edge[1:] | np.concatenate([~word[1:], [True]]))) + 1
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words. Every position and byte has a random number of its own (from the
    64th position on times an odd number of the stretch), so words of one pattern do not meet."""
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        # whole words in steps of bounded size, also inside a very long text
        upto = max(int(np.searchsorted(ends, starts[done] + 2 * BLOCK_BYTES, side="right")), done + 1)
        size = ends[done:upto] - starts[done:upto]
        begin = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(begin, size)
        values = _TABLE[place % _PLACES, _LOWER[raw[np.repeat(starts[done:upto], size) + place]]]
        if size.max() > _PLACES:
            values = values * (mixed((place // _PLACES).astype(np.uint64)) | np.uint64(1))
        out[done:upto] = mixed(np.add.reduceat(values, begin) + size.astype(np.uint64))
        done = upto
    return out


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block in order, and the first word of every document."""
    starts, ends, first = word_bounds(raw, offsets)
    return hashes(raw, starts, ends), first


class Vocabulary:
    """Distinct words, numbered in the order of their hashes."""

    def __init__(self, words: list[bytes]):
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        starts = np.append(0, ends[:-1]).astype(np.int64)
        found = hashes(raw, starts, ends) if words else np.empty(0, np.uint64)
        order = np.argsort(found, kind="stable")
        self.raw, self.hashes = raw, found[order]
        self.starts, self.size = starts[order], (ends - starts)[order] if words else ends
        self.number = {words[k]: n for n, k in enumerate(order.tolist())}
        # the most words that share a hash
        self.depth = int(np.unique(self.hashes, return_counts=True)[1].max()) if words else 0

    def lookup(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for one that is not in the vocabulary."""
        out = np.full(len(starts), -1, np.int64)
        if not self.depth:
            return out
        found = hashes(raw, starts, ends)
        least = np.searchsorted(self.hashes, found)
        for k in range(self.depth):
            at = np.minimum(least + k, len(self.hashes) - 1)
            rows = np.flatnonzero((out < 0) & (self.hashes[at] == found) & (self.size[at] == ends - starts))
            for size in np.unique(self.size[at[rows]]).tolist():
                own = rows[self.size[at[rows]] == size]
                for lo in range(0, len(own), max(1, BLOCK_BYTES // size)):
                    part = own[lo : lo + max(1, BLOCK_BYTES // size)]
                    columns = np.arange(size)
                    same = (_LOWER[raw[starts[part][:, None] + columns]] == self.raw[self.starts[at[part]][:, None] + columns]).all(axis=1)
                    out[part[same]] = at[part[same]]
        return out


INDEX_SCHEMA = "block long, doc_ids array<long>, first array<long>, terms binary, ptr binary, positions binary"


def build_index(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The stored index of docs: postings of the vocabulary's words."""
    bounded_batches(docs.sparkSession)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi, raw, offsets in blocks(batch.column(1)):
                starts, ends, first = word_bounds(raw, offsets)
                terms = vocabulary.lookup(raw, starts, ends)
                at = np.flatnonzero(terms >= 0)
                order = at[np.argsort(terms[at], kind="stable")]
                own, ptr = np.unique(terms[order], return_index=True)
                ptr = np.append(ptr, len(order))
                values = [x.tobytes() for x in (own, ptr.astype(np.int32), order.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([batch.column(0).slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())), pa.array([first]), *(pa.array([v], pa.binary()) for v in values)],
                    ["block", "doc_ids", "first", "terms", "ptr", "positions"],
                )
                number += 1

    return stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(index, INDEX_SCHEMA), "postings")


def windows(items: DataFrame, text: str = "text", item_id: str = "item_id", size: int = WINDOW) -> DataFrame:
    """item (its id as a string), words: the windows of every item, in lower case."""
    bounded_batches(items.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, raw, offsets in blocks(batch.column(1)):
                starts, ends, first = word_bounds(raw, offsets)
                low = _LOWER[raw].tobytes()
                for i in range(len(offsets) - 1):
                    own = [low[a:b] for a, b in zip(starts[first[i] : first[i + 1]].tolist(), ends[first[i] : first[i + 1]].tolist(), strict=True)]
                    if own:
                        rows = [own[k : k + size] for k in range(max(1, len(own) - size + 1))]
                        name = batch.column(0)[lo + i].as_py()
                        yield pa.RecordBatch.from_arrays([pa.array(["" if name is None else name] * len(rows)), pa.array(rows, pa.list_(pa.binary()))], ["item", "words"])

    return items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).mapInArrow(cut, "item string, words array<binary>")


def phrase_starts(lists: list[np.ndarray]) -> np.ndarray:
    """Positions at which the terms with these postings follow each other: offset-adjusted lists
    are intersected, the rarest first."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    starts = lists[order[0]] - order[0]
    for k in order[1:]:
        want = starts + k
        at = np.searchsorted(lists[k], want)
        starts = starts[(at < len(lists[k])) & (lists[k][np.minimum(at, len(lists[k]) - 1)] == want)]
        if not len(starts):
            break
    return starts


def near_spans(lists: list[np.ndarray], width: int, first: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Stretches (start, end) of at most width positions that hold one of each list, around every
    position of the rarest list that has such a stretch. With `first` (the first position of every
    document and the end of the last) a stretch lies in one document."""
    lists = sorted({id(x): x for x in lists}.values(), key=len)
    around = lists[0]
    low, high = around - (width - 1), around + width
    if first is not None:
        doc = np.searchsorted(first, around, side="right") - 1
        low, high = np.maximum(low, first[doc]), np.minimum(high, first[doc + 1])
    for x in lists[1:]:
        at = np.searchsorted(x, low)
        there = (at < len(x)) & (x[np.minimum(at, len(x) - 1)] < high)
        around, low, high = around[there], low[there], high[there]
        if not len(around):
            return []
    out = []
    for p, a, b in zip(around.tolist(), low.tolist(), high.tolist(), strict=True):
        near = [x[np.searchsorted(x, a) : np.searchsorted(x, b)] for x in lists]
        for start in sorted({int(v) for x in near for v in x if v <= p}, reverse=True):
            ends = [x[np.searchsorted(x, start)] if x[-1] >= start else None for x in near]
            if None not in ends and max(max(ends), p) - start < width:
                out.append((start, int(max(max(ends), p)) + 1))
                break
    return out


def _covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


class Queries:
    """A round of windows: their distinct words, and the windows as numbers of words."""

    def __init__(self, rows: pa.Table):
        words = rows["words"].combine_chunks()
        flat = words.flatten().to_pylist()
        self.vocabulary = Vocabulary(sorted(set(flat)))
        self.number = np.array([self.vocabulary.number[w] for w in flat], np.int64)
        self.ptr = np.concatenate([[0], np.cumsum(np.diff(words.offsets.to_numpy()))]).astype(np.int64)
        self.terms = np.arange(len(self.vocabulary.number))
        self.items = rows["item"].to_pylist()


MATCH_SCHEMA = "block long, ordinal int, doc_id long, n_words long, spans array<struct<a: long, b: long>>, items array<string>, near array<string>"
_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def match_block(own: np.ndarray, ptr: np.ndarray, positions: np.ndarray, first: np.ndarray, q: Queries, slop: int | None) -> tuple[dict, dict, dict]:
    """Of a block, by document: hit word spans, items with an exact window, items with a near one."""
    spans: dict[int, list] = {}
    exact: dict[int, set] = {}
    near: dict[int, set] = {}
    if not len(own) or not len(q.terms):
        return spans, exact, near
    at = np.minimum(np.searchsorted(own, q.terms), len(own) - 1)
    there = own[at] == q.terms
    possible = np.flatnonzero(np.logical_and.reduceat(there[q.number], q.ptr[:-1]))
    for w in possible.tolist():
        numbers = at[q.number[q.ptr[w] : q.ptr[w + 1]]].tolist()
        made = {k: positions[ptr[k] : ptr[k + 1]] for k in set(numbers)}
        lists = [made[k] for k in numbers]
        n, item = len(lists), q.items[w]
        starts = phrase_starts(lists)
        docs = np.searchsorted(first, starts, side="right") - 1
        for p, d in zip(starts.tolist(), docs.tolist(), strict=True):
            if p + n <= first[d + 1]:
                spans.setdefault(d, []).append((p - int(first[d]), p - int(first[d]) + n))
                exact.setdefault(d, set()).add(item)
        if slop is not None:
            for a, _ in near_spans(lists, n + slop, first):
                near.setdefault(int(np.searchsorted(first, a, side="right")) - 1, set()).add(item)
    return spans, exact, near


def matches(index: DataFrame, q: Queries, slop: int | None = SLOP) -> DataFrame:
    """Per indexed document: block, ordinal, doc_id, n_words, spans of hit words, items with an
    exact window, items with a proximity match (slop None: not looked for)."""
    bounded_batches(index.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c, t: np.frombuffer(batch.column(c)[i].as_py(), t)  # noqa: B023, E731
                first = batch.column("first")[i].values.to_numpy()
                spans, exact, near = match_block(get("terms", np.int64), get("ptr", np.int32), get("positions", np.int32).astype(np.int64), first, q, slop)
                ids = batch.column("doc_ids")[i].values
                n = len(ids)
                hit = [[{"a": a, "b": b} for a, b in _covered(spans[d])] if d in spans else [] for d in range(n)]
                named = [[sorted(x[d]) if d in x else [] for d in range(n)] for x in (exact, near)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("block")[i].as_py()] * n, pa.int64()), pa.array(range(n), pa.int32()), ids, pa.array(np.diff(first)), pa.array(hit, _SPANS), *(pa.array(x, pa.list_(pa.string())) for x in named)],
                    ["block", "ordinal", "doc_id", "n_words", "spans", "items", "near"],
                )

    return index.mapInArrow(search, MATCH_SCHEMA)


def found_in_rounds(docs: DataFrame, items: DataFrame, text: str, doc_id: str, slop: int | None) -> DataFrame:
    """matches() for all windows, in rounds that are stored one after the other."""
    # rounds are cut by hash, so windows are read alike whatever order they come in
    cut = stored(items.distinct(), "windows")
    rounds = max(1, -(-cut.count() // MAX_WINDOWS))
    part = lambda k: Queries(cut.where(F.pmod(F.xxhash64("item", "words"), F.lit(rounds)) == k).toArrow())
    if rounds == 1:
        q = part(0)
        return matches(build_index(docs, q.vocabulary, text, doc_id), q, slop)
    # rows of the rounds meet by a number that is stored with the documents
    rows = numbered(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")), "number", "numbered-documents")
    out = None
    for k in range(rounds):
        q = part(k)
        one = stored(matches(build_index(rows, q.vocabulary, "text", "number"), q, slop), "matches")
        out = one if out is None else out.union(one)
    flat = lambda c: F.flatten(F.collect_list(c))
    merged = out.groupBy(F.col("doc_id").alias("number")).agg(
        F.first("n_words").alias("n_words"), F.array_sort(flat("spans")).alias("spans"),
        F.array_distinct(flat("items")).alias("items"), F.array_distinct(flat("near")).alias("near"),
    )
    return merged.join(rows.select("number", F.col("id").alias("doc_id")), "number").drop("number")


def report(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", slop: int | None = SLOP) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items (by
    proximity)."""
    found = found_in_rounds(docs, windows(benchmark), text, doc_id, slop)
    # spans of several rounds may overlap
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))
    walked = F.aggregate(
        "spans", start, lambda s, x: F.struct((s.hit + F.greatest(x.b - F.greatest(x.a, s.end), F.lit(0))).alias("hit"), F.greatest(s.end, x.b).alias("end"))
    )
    n_hit = walked["hit"]
    return found.withColumn("n_hit", n_hit).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * SHARE_OF >= F.col("n_words"))).alias("contaminated"),
        F.size("near").cast("long").alias("n_near_items"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """docs without the contaminated rows. docs is stored once with the row numbers that the join
    uses."""
    number = fresh_name(docs, "row")
    rows = numbered(docs, number, "numbered-documents")
    dirty = report(rows, benchmark, text, number, slop=None).where("contaminated").select(F.col("doc_id").alias("dirty"))
    return rows.join(stored(dirty, "contaminated"), F.col(number) == F.col("dirty"), "left_anti").drop(number)


__all__ = ["tokens", "Vocabulary", "build_index", "windows", "phrase_starts", "near_spans", "matches", "report", "keep_clean"]
