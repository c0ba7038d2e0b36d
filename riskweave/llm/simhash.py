"""SimHash near-duplicates with BK-trees.

A text is lower-cased (A-Z), cut into words at ASCII white space, and into shingles of `shingle`
words joined by single spaces, repeats included; fewer words are one shingle, none gives
fingerprint 0. Bit b of the fingerprint is 1 if it is set in over half of the shingles' XXH64
(seed 42). Fingerprints that differ in at most `radius` bits are linked, and documents of linked
fingerprints form a component.

Search: distinct fingerprints are dealt to shards by blocks of their bits. With radius + 1 blocks
two fingerprints within the radius agree in one block at least, so they meet in a shard. A shard
holds a BK-tree whose children are keyed by their Hamming distance to the parent; a query at
distance d from a node follows only the edges d - radius .. d + radius. A shard of more than
SHARD_LIMIT fingerprints is split by blocks of the bits it has not used yet, level by level: two
fingerprints that agree in the used bits still differ in at most `radius` of the others, so no
link is lost, and a shard whose free bits are few cannot be large since its fingerprints are
distinct. Queries travel to the shard with the tree's members; a broadcast would send
fingerprints of all documents through the driver.

A shard returns its local components as stars (fingerprint, smallest linked fingerprint), linear
in its size; the stars are joined to global components.

Defined cases: null text is empty; all texts without words share fingerprint 0 and are linked
like any other; repeated rows and copies share a fingerprint; null doc_ids are never the smallest
unless a component has no other (component_id is null then); extra columns pass through
keep_one(); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import as_bytes, bounded_batches, fresh_name, numbered, stored
from riskweave.llm.components import stars

SHINGLE, RADIUS, SEED = 4, 4, 42
SHARD_LIMIT = 1024
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    last = min(shingle, len(words)) - 1
    starts, ends = (end - length)[: len(words) - last], end[last:]
    digest, n = xxhash.xxh64_digest, len(starts)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        part = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at : at + HASHES_AT_ONCE].tolist(), ends[at : at + HASHES_AT_ONCE].tolist(), strict=True)])
        ones += np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""

    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        raw, at = as_bytes(texts)
        made = [fingerprint(raw[at[i] : at[i + 1]].tobytes(), shingle) for i in range(len(texts))]
        return pa.array(np.array(made, np.uint64).view(np.int64))

    return fingerprints(text)


class BKTree:
    """Distinct integers; children of a node by their Hamming distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, x: int) -> None:
        node, fresh = 0, len(self.values)
        self.values.append(x)
        self.children.append({})
        while fresh:
            d = (x ^ self.values[node]).bit_count()
            child = self.children[node].setdefault(d, fresh)
            if child == fresh:
                return
            node = child

    def within(self, x: int, radius: int) -> Iterator[int]:
        """Numbers (in order of addition) of the values at most radius away."""
        todo = [0] if self.values else []
        while todo:
            node = todo.pop()
            d = (x ^ self.values[node]).bit_count()
            if d <= radius:
                yield node
            todo += [c for e, c in self.children[node].items() if d - radius <= e <= d + radius]


def local_stars(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(value, smallest value of its component in this shard) for linked values, by asking the
    tree of the values so far for each value before it is added."""
    tree, parent = BKTree(), list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, x in enumerate(values):
        for j in tree.within(x, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
        tree.add(x)
    return [(values[i], values[r]) for i in range(len(values)) if (r := root(i)) != i]


def finer(mask: int, radius: int) -> list[int]:
    """mask with each of radius + 1 blocks of its free bits added."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << int(b) for b in block) for block in np.array_split(free, radius + 1) if len(block)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, radius: int = RADIUS, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """Distinct fingerprints (column fp) -> star edges (u, v) that connect all fingerprints within
    the radius of each other."""
    masks = lambda m: F.array(*(F.lit(_signed(x)) for x in finer(m, radius)))
    rows = prints.select("fp", F.explode(masks(0)).alias("mask"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by shard; the last shard of a batch may go on in the next
        rest = np.empty((3, 0), np.int64)
        for batch in batches:
            part = np.concatenate([rest, np.stack([batch.column(i).to_numpy() for i in range(3)])], axis=1)
            cuts = np.flatnonzero((np.diff(part[:2], axis=1) != 0).any(axis=0)) + 1
            whole = cuts[-1] if len(cuts) else 0
            yield from found(part[:, :whole], cuts[:-1])
            rest = part[:, whole:]
        yield from found(rest, [])

    def found(part: np.ndarray, cuts) -> Iterator[pa.RecordBatch]:
        edges = [e for shard in np.split(part[2].view(np.uint64), cuts) for e in local_stars(shard.tolist(), radius)]
        if edges:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, np.array(edges, np.uint64).view(np.int64).T)), ["u", "v"])

    out = None
    while True:
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        size = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        sized = stored(rows.join(size, ["mask", "key"]), "shards")
        small = sized.where(F.col("n") <= shard_limit).select("mask", "key", "fp")
        edges = small.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(search, "u long, v long")
        out = edges if out is None else out.union(edges)
        large = sized.where(F.col("n") > shard_limit)
        # at most (radius + 1) ** level masks
        used = [r.mask for r in large.select("mask").distinct().collect()]
        if not used:
            return out.distinct()
        step = F.map_from_arrays(F.array(*map(F.lit, used)), F.array(*(masks(m & (1 << 64) - 1) for m in used)))
        rows = large.select("fp", F.explode(step[F.col("mask")]).alias("mask")).distinct()


def components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS, row: str | None = None) -> DataFrame:
    """row (number), doc_id, fp, component (its smallest linked fingerprint) of every document; the
    row number is that of the column `row`, or null."""
    bounded_batches(docs.sparkSession)
    number = F.col(row) if row else F.lit(None).cast("long")
    rows = stored(docs.select(number.alias("row"), F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text), shingle).alias("fp")), "fingerprints")
    star = stars(links(rows.select("fp").distinct(), radius)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    return rows.join(star, "fp", "left").select("row", "doc_id", "fp", F.coalesce("root", "fp").alias("component"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the component)."""
    rows = components(docs, text, doc_id, shingle, radius)
    # stored: a shuffle of its own for the join lets a hot component's documents be split
    smallest = stored(rows.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component-ids")
    return rows.join(smallest, "component").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id (null last), of repeated
    rows any one. docs is stored once with the row numbers that the joins use."""
    number = fresh_name(docs, "row")
    docs = numbered(docs, number, "numbered-documents")
    rows = components(docs, text, doc_id, shingle, radius, number)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    kept = rows.groupBy("component").agg(first.alias("first")).select(F.col("first.row").alias("kept"))
    return docs.join(kept, F.col(number) == F.col("kept"), "left_semi").drop(number)


__all__ = ["fingerprint", "fingerprint_column", "BKTree", "local_stars", "finer", "links", "components", "near_duplicates", "keep_one"]
