"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights; a dimension is a term. Candidates are packed into
shards that hold, per term, a postings list (vector number, weight); queries are packed into
blocks of rows. Every block meets every shard once: for each term of a query, weight times
postings is scattered into a dense score array over the shard, the k best of the array are taken
by partition selection, and the shards' selections of a query are merged to its k best.

Scores are exact int64: a shard and a block whose largest possible sum of products could leave int64
are an error (ScoreRange), never a wrapped score, and so is a component whose integer weight leaves
it. Vectors that are null or hold null or non-finite components, and rows without an id, take no part; an empty vector scores 0 with
all; vectors of different lengths meet in their common dimensions. Repeated rows are rows of
their own: each is a query if its id is chosen, and a candidate of the others. Ties go to the
smaller id. A query with fewer than k candidates has as many rows; an empty table gives none.

Scale: rows are dealt to shards and blocks by a hash of the row number, so repeated vectors do not
meet in one of them. Shards and blocks are shuffled once, to partitions that meet each other in a
task per pair of partitions: a task holds the HELD_SHARDS shards of one side, streams the blocks of
the other, and has one score array of fixed size. Nothing is copied per shard and nothing is
broadcast, whatever size the planner takes the packed rows for. Work is queries x candidates by
definition of an exhaustive search; only blocks x shards x k rows are shuffled to the merge, which
is cut to k per query before the shuffle as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.llm.common import bounded_batches, stored

class ScoreRange(ArithmeticError):
    """A score that int64 cannot hold."""


SHARD_ROWS = 1024
BLOCK_ROWS = 128
# shards that a task holds, and the most blocks that it streams past them
HELD_SHARDS = 8
STREAMED_BLOCKS = 256


def clean(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """row (a number), id, weights: floor(scale * x) of every usable vector."""
    v = F.col(vector)
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(vec_id).isNotNull() & v.isNotNull() & usable).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("long").alias("id"),
        # an integer beyond 2**62 would saturate in the cast
        F.transform(v, lambda x: F.when(F.abs(x.cast("double") * scale) < float(1 << 62), F.floor(x.cast("double") * scale).cast("long")).otherwise(
            F.raise_error(F.lit("a component's integer weight leaves int64")).cast("long"))).alias("weights"),
    )


PACKED = "part long, rows binary, ids binary, ptr binary, at binary, weight binary"


def _pack(table: pa.Table, by_term: bool) -> pa.Table:
    """One row: numbers and ids in order of id, and the non-zero weights by term (postings) or by
    row (query rows)."""
    table = table.sort_by([("id", "ascending"), ("row", "ascending")]).combine_chunks()
    weights = table["weights"].combine_chunks() if isinstance(table["weights"], pa.ChunkedArray) else table["weights"]
    lengths = np.diff(weights.offsets.to_numpy())
    flat = weights.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    terms = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    used = flat != 0
    rows, terms, flat = rows[used], terms[used], flat[used]
    major, minor = (terms, rows) if by_term else (rows, terms)
    order = np.lexsort((minor, major))
    n = (int(terms.max()) + 1 if len(terms) else 0) if by_term else len(lengths)
    ptr = np.searchsorted(major[order], np.arange(n + 1)).astype(np.int64)
    values = [table["row"].to_numpy(), table["id"].to_numpy(), ptr, minor[order].astype(np.int32), flat[order]]
    return pa.table([pa.array([table["part"][0].as_py()], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in values)], names=["part", "rows", "ids", "ptr", "at", "weight"])


def pack_postings(table: pa.Table) -> pa.Table:
    return _pack(table, True)


def pack_rows(table: pa.Table) -> pa.Table:
    return _pack(table, False)


def packed(rows: DataFrame, size: int, by_term: bool) -> tuple[DataFrame, int]:
    """rows packed into about `size` to a part, and the number of parts."""
    parts = max(1, -(-rows.count() // size))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    return dealt.groupBy("part").applyInArrow(pack_postings if by_term else pack_rows, PACKED), parts


def met(blocks: DataFrame, n_blocks: int, shards: DataFrame, n_shards: int) -> DataFrame:
    """Every block beside every shard, the block's columns with q_ before their names. The hint keeps
    either side from being broadcast: the planner knows neither the size of packed rows nor their number."""
    few = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    right = -(-n_shards // HELD_SHARDS)
    left = min(n_blocks, max(-(-few // right), -(-n_blocks // STREAMED_BLOCKS)))
    columns = ("rows", "ids", "ptr", "at", "weight")
    queries = blocks.select(*(F.col(c).alias(f"q_{c}") for c in columns)).repartition(left)
    return queries.hint("shuffle_replicate_nl").crossJoin(shards.select(*columns).repartition(right))


def accumulate(ptr: np.ndarray, at: np.ndarray, weight: np.ndarray, queries: tuple[np.ndarray, np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Score arrays of a block over a shard, term by term: the term's postings, times its weight
    in each query that has it, are scattered into these queries' arrays. A term that most vectors
    and queries have is scattered into one array first and added as a whole."""
    q_ptr, q_term, q_weight = queries
    rows = np.repeat(np.arange(len(q_ptr) - 1), np.diff(q_ptr))
    by_term = np.argsort(q_term, kind="stable")
    terms, begin = np.unique(q_term[by_term], return_index=True)
    scores = np.zeros((len(q_ptr) - 1, n), np.int64)
    step = np.empty_like(scores)
    for t, a, b in zip(terms.tolist(), begin.tolist(), [*begin[1:].tolist(), len(by_term)], strict=True):
        if t + 1 >= len(ptr) or ptr[t] == ptr[t + 1]:
            continue
        # a term occurs once in a vector, so no number repeats in a list
        where, what = at[ptr[t] : ptr[t + 1]], weight[ptr[t] : ptr[t + 1]]
        q, w = rows[by_term[a:b]], q_weight[by_term[a:b]]
        if 4 * len(where) >= n and 4 * len(q) >= len(scores):
            column, row = np.zeros(n, np.int64), np.zeros(len(scores), np.int64)
            column[where], row[q] = what, w
            np.multiply(row[:, None], column[None, :], out=step)
            scores += step
        else:
            scores[np.ix_(q, where)] += w[:, None] * what[None, :]
    return scores


def check_range(weight: np.ndarray, queries: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
    """Refuse weights whose sums of products may leave int64: the largest weights of both sides,
    times the most terms of a query."""
    q_ptr, _, q_weight = queries
    if len(weight) and len(q_weight):
        largest = lambda x: max(abs(int(x.min())), abs(int(x.max())))
        if largest(weight) * largest(q_weight) * int(np.diff(q_ptr).max()) >= 1 << 62:
            # the bound is loose: sum the sizes of the products exactly before giving up
            by_query = np.add.reduceat(np.abs(q_weight.astype(object)), q_ptr[:-1][np.diff(q_ptr) > 0])
            if int(by_query.max()) * largest(weight) >= 1 << 63:
                raise ScoreRange("inner products of these vectors may leave int64")


def select_best(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) numbers of the k best of each row, ties to the smaller number; `own`
    marks the pairs that do not count. The k-th best score of a row is found by partition; all
    above it are taken, and of its equals the smallest numbers."""
    least = np.iinfo(np.int64).min
    scores = np.where(own, least, scores)
    n = scores.shape[1]
    if k >= n:
        q, c = np.nonzero(~own)
        return q, c
    bound = np.partition(scores, n - k, axis=1)[:, n - k]
    above, equal = scores > bound[:, None], (scores == bound[:, None]) & ~own
    room = k - above.sum(axis=1)
    q, c = np.nonzero(above | (equal & (np.cumsum(equal, axis=1) <= room[:, None])))
    return q, c


def top_k(
    vectors: DataFrame, query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best candidates of each query row.
    `query` is a condition on the column `id`."""
    bounded_batches(vectors.sparkSession)
    rows = stored(clean(vectors, vec_id, vector, scale), "vectors")
    shards, n_shards = packed(rows, SHARD_ROWS, True)
    blocks, n_blocks = packed(rows.where(query), BLOCK_ROWS, False)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c, t=np.int64: np.frombuffer(batch.column(c)[i].as_py(), t)  # noqa: B023, E731
                number, ids = get("rows"), get("ids")
                q_number, q_ids = get("q_rows"), get("q_ids")
                queries = (get("q_ptr"), get("q_at", np.int32), get("q_weight"))
                check_range(get("weight"), queries)
                scores = accumulate(get("ptr"), get("at", np.int32), get("weight"), queries, len(ids))
                q, c = select_best(scores, q_number[:, None] == number[None, :], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_number[q]), pa.array(q_ids[q]), pa.array(ids[c]), pa.array(scores[q, c])], ["row", "query_id", "vec_id", "score"]
                )

    found = met(blocks, n_blocks, shards, n_shards).mapInArrow(search, "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


__all__ = ["SHARD_ROWS", "BLOCK_ROWS", "accumulate", "ScoreRange", "check_range", "select_best", "top_k"]
