"""Removal of repeated byte strings by merging sharded suffix orders.

Every byte covered by a string of `length` bytes that also starts anywhere else in the corpus, in
the same document included, is removed; strings are judged on the input and never cross documents.

Which suffixes can matter. A string of `length` bytes holds length - GRAM + 1 grams of GRAM bytes;
the gram of smallest hash among them (the last of equals) is its anchor. The anchor depends on the
string alone, so equal strings have equal anchors at equal offsets. Consecutive start positions
with one anchor are one block: the bytes from the first start to the end of the last string, with
the anchor's place in it. Blocks whose anchor gram occurs once hold no repeated string and are
dropped; equal blocks are one block with a count, and all their strings are repeated. Blocks are
equal if 128 bits of BLAKE2b say so; the faster hash of grams only brings blocks together.

Shard orders. Each shard (a task's distinct blocks) is brought into the order of its suffixes at
the anchors, gram by gram, and stored as runs: with a suffix goes its place, the common prefix with
the one before, and the bytes that precede it, which a walk back through the transform yields.

Merging. The runs of one gram meet in one task and are interleaved by refinement, as shard
Burrows-Wheeler transforms are merged: all start in one interval, and each round splits the
intervals by the next symbol (8 bytes to the right) in a stable way. Runs are never sorted again:
suffixes of a run that agree on the symbol move as one, and an interval left with one run is done,
its common prefixes being those of the run. The round in which two neighbours part gives their
common prefix; no suffix is ever compared with another as a whole. Then the order of the suffixes that begin x bytes before the anchor is derived from that of
x - 1 by a stable partition on the preceding byte, the step by which a Burrows-Wheeler transform
is walked backwards. In the order for x, neighbours of one interval whose common prefix at the
anchor reaches length - x are repeated strings.

Hot grams. A gram with more than GROUP_LIMIT distinct blocks (a common line in many surroundings)
is not merged at once. Its blocks are cut by ranges of x, and the parts are grouped anew by gram,
range and the bytes that all strings of the range have in common (the core), which parts them by
their surroundings; equal parts fall together again. The ranges narrow level by level; for a
single x the core is the string itself, equal parts are one, and no group is left to merge.

Defined cases: null text is empty; texts shorter than `length` keep all bytes unless nothing else
applies; a document whose bytes all go keeps the empty string; every row is a document of its own,
so repeated rows lose all strings; extra columns are ignored; an empty table gives an empty table.
Byte positions are those of the UTF-8 text; kept bytes need not be valid UTF-8.

Scale: blocks (about one for 85 bytes of text) are counted by aggregates with map-side combine;
a group that meets in a task has at most GROUP_LIMIT blocks of under 2 * length bytes. Grams
travel as 64 bits, blocks as 128 bits more; bytes of a block travel only if its gram occurs with
different surroundings. Shards are sorted by Spark, which spills; a run ends with its Arrow batch. Texts are compressed once, stored with
their row numbers, and shuffled twice as they are, to fetch these bytes and to cut the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import as_bytes, bounded_batches, numbered, packed, stored, unpacked, unpacked_blocks
from riskweave.llm.hashing import mixed, prefix_hashes, substring_hashes

LENGTH = 200
GRAM = 32
GROUP_LIMIT = 1000
# how many values of x a part of a hot block spans, level by level
RANGES = (48, 12, 3, 1)
# text bytes whose grams are held at once: about fifteen arrays of eight bytes a position
CHUNK = 1_000_000
STEP_BYTES = 500_000
BATCH_BYTES = 8 << 20


KEY = ["gram", "block", "check"]


def identity(data: memoryview, begin: np.ndarray, end: np.ndarray, left: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits, as two columns, that stand for a block's bytes and its anchor's place."""
    shapes = (left * 512 + span).tolist()
    found = b"".join(
        hashlib.blake2b(data[a:b], digest_size=16, salt=shape.to_bytes(8, "little")).digest()
        for a, b, shape in zip(begin.tolist(), end.tolist(), shapes, strict=True)
    )
    pairs = np.frombuffer(found, np.int64).reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchored_blocks(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Blocks of all documents of a step: gram hash, identity (two columns), first start, bytes from
    the first start to the anchor, and number of starts less one."""
    found = []
    for c in range(0, max(len(raw) - length + 1, 0), CHUNK):
        part = raw[c : c + CHUNK + length - 1]
        prefix = prefix_hashes(part)
        n = len(part) - gram + 1
        grams = substring_hashes(prefix, slice(0, n), slice(gram, n + gram))
        # 40 bits of the hash, then the position from the end: of equal grams the last is smallest
        low = np.uint64((1 << 24) - 1)
        least = sliding_min((grams & ~low) | (low - np.arange(n, dtype=np.uint64)), length - gram + 1)
        anchor = (low - (least & low)).astype(np.int64)
        starts = len(anchor)
        # no string runs over the end of its document
        inside = np.zeros(starts + 1, np.int32)
        lo = np.clip(np.maximum(offsets[:-1], offsets[1:] - length + 1) - c, 0, starts)
        np.add.at(inside, lo, 1)
        np.add.at(inside, np.clip(offsets[1:] - c, 0, starts), -1)
        valid = np.cumsum(inside[:-1]) == 0
        step = np.empty(starts, bool)
        step[0], step[1:] = True, (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        first = np.flatnonzero(valid & step)
        last = np.flatnonzero(valid & np.append(step[1:] | ~valid[1:], True))
        left, span = anchor[first] - first, last - first
        found.append((grams[anchor[first]], *identity(memoryview(part), first, last + length, left, span), first + c, left, span))
    if not found:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


_BYTE_STEPS = np.left_shift(np.uint64(1), np.arange(8, 64, 8, dtype=np.uint64))


def leading_equal(differ: np.ndarray) -> np.ndarray:
    """Leading equal bytes of two big-endian symbols whose exclusive or is `differ` (not zero)."""
    return 7 - np.searchsorted(_BYTE_STEPS, differ, side="right")


def right_words(flat: np.ndarray, anchor: np.ndarray, reach: np.ndarray, length: int) -> np.ndarray:
    """The bytes from each anchor on, zero beyond its reach, as rows of 8-byte symbols."""
    columns = np.arange(-(-length // 8) * 8)
    bytes_ = flat[anchor[:, None] + columns]
    bytes_[columns[None, :] >= reach[:, None]] = 0
    return np.ascontiguousarray(bytes_).view(">u8").astype(np.uint64)


def run_prefixes(words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For suffixes in order: bytes in common with the one before, -1 at the first of a group."""
    n, rounds = words.shape
    known = np.full(n, -1, np.int64)
    inner = np.flatnonzero(group[1:] == group[:-1])
    differ = words[inner + 1] ^ words[inner]
    first = (differ != 0).argmax(axis=1)
    at = differ[np.arange(len(inner)), first]
    known[inner + 1] = np.where(at != 0, 8 * first + leading_equal(np.maximum(at, np.uint64(1))), 8 * rounds)
    return known


def right_order(words: np.ndarray, group: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Interleave refinement of runs of suffixes, given as rows of 8-byte symbols, group by group
    and run by run: the order, and for every slot the bytes in common with the slot before (-1 at
    the first of a group). known: the bytes in common with the row before of the same run, -1 where
    a run begins; without it every row is a run."""
    n, rounds = words.shape
    known = np.full(n, -1, np.int64) if known is None else known
    order, interval, at = np.arange(n), group.copy(), np.arange(n)
    common = np.full(n, 8 * rounds, np.int64)
    common[np.append(True, group[1:] != group[:-1])] = -1
    for h in range(rounds):
        if not len(at):
            break
        # rows of one interval lie together; those that follow their own run need no place sought
        member, own = order[at], interval[at]
        new = np.append(True, own[1:] != own[:-1])
        begins = new | np.append(True, (member[1:] != member[:-1] + 1) | (known[member[1:]] < 0))
        first = np.flatnonzero(new)
        several = np.repeat(np.add.reduceat(begins.astype(np.int64), first) > 1, np.diff(np.append(first, len(at))))
        at, member, own = at[several], member[several], own[several]
        # rows that share the symbol with the one before in their run move with it
        head = np.flatnonzero(known[member] < 8 * (h + 1))
        size = np.diff(np.append(head, len(at)))
        symbol = words[member[head], h]
        merge = np.lexsort((symbol, own[head]))
        size = size[merge]
        order[at] = member[np.repeat(head[merge] - (np.cumsum(size) - size), size) + np.arange(len(at))]
        symbol = np.repeat(symbol[merge], size)
        differ = symbol[1:] ^ symbol[:-1]
        parts = np.flatnonzero((own[1:] == own[:-1]) & (differ != 0))
        common[at[parts + 1]] = 8 * h + leading_equal(differ[parts])
        cut = np.zeros(n, np.int64)
        cut[at[parts + 1]] = 1
        interval = interval + np.cumsum(cut)
    # neighbours of one run have the prefix that the run knows
    follows = np.flatnonzero((order[1:] == order[:-1] + 1) & (known[order[1:]] >= 0)) + 1
    common[follows] = known[order[follows]]
    return order, common


def repeated_starts(flat: np.ndarray, at: np.ndarray, left: np.ndarray, span: np.ndarray, group: np.ndarray, length: int = LENGTH, known: np.ndarray | None = None) -> np.ndarray:
    """For distinct blocks in runs, group by group (known as in right_order): (blocks, length) marks, [b, x]: the string that begins x
    bytes before the anchor also starts in another block of the group. `at` is where each block's
    bytes begin in `flat`, which must go on for length + 8 bytes after the last block."""
    n = len(at)
    marks = np.zeros((n, length), bool)
    anchor = at + left
    reach = length + span - left  # bytes of the block from the anchor on
    order, common = right_order(right_words(flat, anchor, reach, length), group, known)
    rank_of_group = group[order]
    # slots in the order for x: block numbers by interval, ties by rank at the anchor
    slots, interval = np.arange(n), rank_of_group.copy()
    low, high = (left - span)[order], left[order]
    for x in range(length):
        if x:
            live = high[slots] >= x
            slots, interval = slots[live], interval[live]
            if not len(slots):
                break
            before = flat[anchor[order[slots]] - x].astype(np.int64)
            key = interval * 256 + before
            sort = np.argsort(key, kind="stable")
            slots, key = slots[sort], key[sort]
            new = np.append(True, key[1:] != key[:-1])
            interval = np.cumsum(new)
            # an interval with one suffix has no partner here or further left
            several = ~(new & np.append(new[1:], True))
            slots, interval = slots[several], interval[several]
            if not len(slots):
                break
        there = low[slots] <= x
        s, i = slots[there], interval[there]
        if len(s) < 2:
            continue
        same_right = np.cumsum(common < length - x)
        pair = (i[1:] == i[:-1]) & (same_right[s[1:]] == same_right[s[:-1]])
        both = np.zeros(len(s), bool)
        both[1:] |= pair
        both[:-1] |= pair
        marks[order[s[both]], x] = True
    return marks


# ---- the Spark job

OCC = "gram long, block long, check long, doc long, first long, left_ short, span short"
BLOCK = "gram long, block long, check long, n long, left_ short, span short, bytes binary"
RUNS = ", run long, place int, known short"
DONE = "gram long, block long, check long, starts array<struct<a: short, b: short>>"
_STARTS = pa.list_(pa.struct([("a", pa.int16()), ("b", pa.int16())]))


def occurrences(docs: DataFrame, length: int) -> DataFrame:
    """(doc, packed text) -> the blocks of all documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(0).to_numpy()
            for lo, _, raw, offsets in unpacked_blocks(batch.column(1), STEP_BYTES):
                gram, block, check, first, left, span = anchored_blocks(raw, offsets, length)
                doc = np.searchsorted(offsets, first, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(block), pa.array(check), pa.array(number[lo + doc]), pa.array(first - offsets[doc]), pa.array(left.astype(np.int16)), pa.array(span.astype(np.int16))],
                    [*KEY, "doc", "first", "left_", "span"],
                )

    return docs.mapInArrow(cut, OCC)


def block_bytes(wanted: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """wanted (gram, block, check, n, doc, first, left_, span) with the bytes of the blocks."""
    asked = wanted.groupBy("doc").agg(F.collect_list(F.struct(*KEY, "n", "first", "left_", "span")).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, asked_of in zip(unpacked(batch.column(0)), batch.column(1), strict=True):
                a = asked_of.values
                first, span = a.field("first").to_numpy(), a.field("span").to_numpy().astype(np.int64)
                cuts = [text[f : f + s + length] for f, s in zip(first.tolist(), span.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([a.field(c) for c in (*KEY, "n", "left_", "span")] + [pa.array(cuts, pa.binary())], [*KEY, "n", "left_", "span", "bytes"])

    return docs.select("doc", "text").join(asked, "doc").select("text", "asked").mapInArrow(cut, BLOCK)


def flat_bytes(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all blocks, with room behind the last, and where each begins."""
    raw, offsets = as_bytes(column)
    return np.concatenate([raw[offsets[0] : offsets[-1]], np.zeros(length + 16, np.uint8)]), offsets[:-1] - offsets[0]


def shard_orders(blocks: DataFrame, length: int) -> DataFrame:
    """Blocks (gram, .., left_, span, bytes) with run, place and known: each partition is a shard,
    sorted by gram and the suffix at the anchor, in runs of one Arrow batch."""

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        for k, batch in enumerate(batches):
            flat, at = flat_bytes(batch.column("bytes"), length)
            left, span = (batch.column(c).to_numpy().astype(np.int64) for c in ("left_", "span"))
            known = run_prefixes(right_words(flat, at + left, length + span - left, length), batch.column("gram").to_numpy())
            n = batch.num_rows
            more = [pa.array(np.full(n, (shard << 32) + k)), pa.array(np.arange(n, dtype=np.int32)), pa.array(known.astype(np.int16))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "run", "place", "known"])

    order = blocks.select(*KEY, "n", "left_", "span", "bytes").sortWithinPartitions("gram", F.expr("substring(bytes, left_ + 1)"))
    return order.mapInArrow(transform, BLOCK + RUNS)


def _runs(marks: np.ndarray, left: np.ndarray, span: np.ndarray) -> pa.Array:
    """Marked strings of every block as runs of start numbers within the block."""
    rows, x = np.nonzero(marks[:, ::-1])
    start = left[rows] - (marks.shape[1] - 1 - x)
    new = np.append(True, (rows[1:] != rows[:-1]) | (start[1:] != start[:-1] + 1)) if len(rows) else np.empty(0, bool)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(rows)) - 1 if len(rows) else begin
    offsets = np.searchsorted(rows[begin], np.arange(len(left) + 1))
    values = pa.StructArray.from_arrays([pa.array(start[begin].astype(np.int16)), pa.array(start[end].astype(np.int16))], ["a", "b"])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def merged(groups: DataFrame, length: int) -> DataFrame:
    """Runs of distinct blocks of grams with at most GROUP_LIMIT of them -> repeated starts of each
    block that has any."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by gram, then run by run; the last gram of a batch may go on in the next
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch] if rest is None else [*rest, batch]).combine_chunks()
            gram = part["gram"].to_numpy()
            whole = int(np.searchsorted(gram, gram[-1])) if len(gram) else 0
            for lo in _steps(gram[:whole]):
                yield solve(part.slice(lo[0], lo[1] - lo[0]))
            rest = part.slice(whole).to_batches()
        if rest:
            yield solve(pa.Table.from_batches(rest).combine_chunks())

    def _steps(gram: np.ndarray, most: int = 20_000) -> list[tuple[int, int]]:
        """Whole grams in steps of about `most` blocks."""
        cuts, ends = [0], np.append(np.flatnonzero(gram[1:] != gram[:-1]) + 1, len(gram)) if len(gram) else []
        for e in ends:
            if e - cuts[-1] >= most or e == len(gram):
                cuts.append(int(e))
        return list(zip(cuts, cuts[1:], strict=False))

    def solve(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        get = lambda c: part[c].to_numpy().astype(np.int64)
        flat, at = flat_bytes(part["bytes"].chunk(0) if part.num_rows else pa.array([], pa.binary()), length)
        gram, left, span = get("gram"), get("left_"), get("span")
        group = np.cumsum(np.append(False, gram[1:] != gram[:-1])) if len(gram) else gram
        marks = repeated_starts(flat, at, left, span, group, length, get("known"))
        keep = np.flatnonzero(marks.any(axis=1))
        return pa.RecordBatch.from_arrays([*(pa.array(get(c)[keep]) for c in KEY), _runs(marks[keep], left[keep], span[keep])], [*KEY, "starts"])

    columns = groups.select(*KEY, "left_", "span", "bytes", "run", "place", "known")
    return columns.repartition("gram").sortWithinPartitions("gram", "run", "place").mapInArrow(merge, DONE)


def parts_of(hot: DataFrame, width: int, length: int) -> DataFrame:
    """Blocks of hot grams cut by ranges of x: the parent's key, where the part begins in
    it, and the part as a block of its own, whose gram stands for gram, range and core."""

    names = ["parent_gram", "parent_block", "parent_check", "begin", *KEY, "left_", "span", "bytes"]
    schema = "parent_gram long, parent_block long, parent_check long, begin short, gram long, block long, check long, left_ short, span short, bytes binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield parts(batch.slice(at, 1000))

    def parts(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = as_bytes(batch.column("bytes"))
        gram, block, check = (batch.column(c).to_numpy().view(np.uint64) for c in KEY)
        left, span = (batch.column(c).to_numpy().astype(np.int64) for c in ("left_", "span"))
        low = (left - span) // width
        count = left // width + 1 - low
        row = np.repeat(np.arange(len(left)), count)
        r = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + low[row]
        # starts of a part: left - x for the x of the range that the block has
        a, b = np.maximum(left[row] - (r + 1) * width + 1, 0), np.minimum(left[row] - r * width, span[row])
        raw, base = raw[offsets[0] : offsets[-1]], offsets[:-1][row] - offsets[0]
        prefix = prefix_hashes(raw)
        core = base + left[row] - r * width
        core_hash = substring_hashes(prefix, core, core - width + 1 + length)
        own = identity(memoryview(raw), base + a, base + b + length, left[row] - a, b - a)
        key = mixed(core_hash ^ mixed(gram[row] + (r * 1024 + width).astype(np.uint64)))
        cuts = [raw[i:j].tobytes() for i, j in zip((base + a).tolist(), (base + b + length).tolist(), strict=True)]
        long = lambda v: pa.array(v.view(np.int64))
        short = lambda v: pa.array(v.astype(np.int16))
        return pa.RecordBatch.from_arrays([long(gram[row]), long(block[row]), long(check[row]), short(a), long(key), *map(pa.array, own), short(left[row] - a), short(b - a), pa.array(cuts, pa.binary())], names)

    # a hot gram's blocks are cut by many tasks
    return hot.select(*KEY, "left_", "span", "bytes").repartition("gram", "block").mapInArrow(cut, schema)


def all_starts(frame: DataFrame) -> DataFrame:
    """Every start of a block, as in merged()."""
    return frame.select(*KEY, F.array(F.struct(F.lit(0).cast("short").alias("a"), F.col("span").cast("short").alias("b"))).alias("starts"))


def resolved(groups: DataFrame, length: int, limit: int, level: int = 0) -> DataFrame:
    """Runs of distinct blocks (shard_orders) of grams that have several -> repeated starts of those blocks that
    are no copies themselves (n is 1)."""
    # stored, here and below: a shuffle of its own for the join lets hot keys be split
    size = stored(groups.groupBy("gram").agg(F.count("*").alias("size")).where("size > 1"), "gram-sizes")
    sized = groups.join(size, "gram")
    out = merged(sized.where(F.col("size") <= limit), length)
    hot = sized.where(F.col("size") > limit)
    if level == len(RANGES) or hot.limit(1).count() == 0:
        return out
    parts = stored(parts_of(hot, RANGES[level], length), "parts")
    distinct = parts.groupBy(*KEY).agg(F.count("*").alias("n"), F.first("left_").alias("left_"), F.first("span").alias("span"), F.first("bytes").alias("bytes"))
    distinct = stored(shard_orders(distinct, length), "part-blocks")
    below = stored(all_starts(distinct.where("n > 1")).union(resolved(distinct, length, limit, level + 1)), "part-starts")
    up = (
        parts.select("parent_gram", "parent_block", "parent_check", "begin", *KEY)
        .join(below, KEY)
        .select(
            F.col("parent_gram").alias("gram"), F.col("parent_block").alias("block"), F.col("parent_check").alias("check"),
            F.transform("starts", lambda s: F.struct((s.a + F.col("begin")).cast("short").alias("a"), (s.b + F.col("begin")).cast("short").alias("b"))).alias("starts"),
        )
        .groupBy(*KEY).agg(F.flatten(F.collect_list("starts")).alias("starts"))
    )
    return out.union(up)


def repeated_spans(docs: DataFrame, length: int = LENGTH, limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc, packed text) -> doc, starts: runs of start positions (a, b) of repeated strings."""
    found = stored(occurrences(docs, length), "blocks")
    grams = (
        found.groupBy("gram").agg(F.count("*").alias("n"), *(f(c).alias(f"{f.__name__}_{c}") for c in ("block", "check") for f in (F.min, F.max)))
        .where("n > 1").select("gram", F.expr("min_block <> max_block OR min_check <> max_check").alias("several"))
    )
    again = stored(found.join(stored(grams, "grams"), "gram"), "repeated-grams")
    distinct = again.where("several").groupBy(*KEY).agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "first")).alias("place"), F.first("left_").alias("left_"), F.first("span").alias("span")
    )
    distinct = stored(distinct.select(*KEY, "n", "place.doc", "place.first", "left_", "span"), "distinct-blocks")
    partial = resolved(stored(shard_orders(block_bytes(distinct, docs, length), length), "shard-orders"), length, limit)
    copies = again.where("not several").select("doc", "first", F.array(F.struct(F.lit(0).cast("short").alias("a"), F.col("span").alias("b"))).alias("starts"))
    copied = all_starts(distinct.where("n > 1"))
    alone = partial.join(distinct.where("n > 1").select(*KEY), KEY, "left_anti")
    known = stored(copied.union(alone), "repeated-starts")
    hits = again.where("several").join(known, KEY).select("doc", "first", "starts")
    runs = hits.union(copies).select("doc", "first", F.explode("starts").alias("s"))
    return runs.groupBy("doc").agg(
        F.collect_list(F.struct((F.col("first") + F.col("s.a")).alias("a"), (F.col("first") + F.col("s.b")).alias("b"))).alias("starts")
    )


def removed_spans(a: np.ndarray, b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed byte runs [begin, end) of strings that start in the runs a..b."""
    order = np.argsort(a, kind="stable")
    begin, end = a[order], np.maximum.accumulate(b[order] + length)
    new = np.append(True, begin[1:] > end[:-1])
    return begin[new], end[np.append(np.flatnonzero(new)[1:], len(end)) - 1]


CUT = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def cut_documents(docs: DataFrame, length: int = LENGTH, limit: int = GROUP_LIMIT, kept: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with `kept` the kept bytes.
    The texts are stored once, compressed, with the numbers that all joins use."""
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    docs = numbered(docs.select(F.col(doc_id).cast("long").alias("doc_id"), packed(F.col(text)).alias("text")), "doc", "numbered-texts")
    spans = stored(repeated_spans(docs.select("doc", "text"), length, limit), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, runs in zip(unpacked(batch.column(1)), batch.column(2), strict=True):
                begin = end = np.empty(0, np.int64)
                if runs.is_valid and len(runs):
                    begin, end = removed_spans(runs.values.field("a").to_numpy(), runs.values.field("b").to_numpy(), length)
                edges = [0, *np.stack([begin, end], axis=1).ravel().tolist(), len(part)]
                left = b"".join(part[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                rows.append((len(part), len(part) - len(left), len(begin), hashlib.sha256(left).hexdigest(), left if kept else None))
            c = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in c[:3]), pa.array(c[3], pa.string()), pa.array(c[4], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = docs.join(spans, "doc", "left").select("doc_id", "text", "starts").mapInArrow(cut, CUT.replace("doc long", "doc_id long", 1))
    return out if kept else out.drop("kept")


__all__ = ["identity", "anchored_blocks", "run_prefixes", "right_order", "shard_orders", "repeated_starts", "removed_spans", "repeated_spans", "cut_documents"]
