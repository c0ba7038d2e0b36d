"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import stored


def _linked(pairs: DataFrame) -> DataFrame:
    return pairs.where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple[int, int | None]:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r.n, r.x


def stars(edges: DataFrame) -> DataFrame:
    """edges (u, v), longs in any direction -> (u, v): every linked u once, v the smallest number
    reachable; the smallest itself has no row. No edges give no rows.

    Per round every edge moves to the smallest neighbour, through aggregates with map-side combine
    and equi-joins, never by collecting the neighbours of a number; rounds grow with the logarithm
    of the longest path. Each round is written to the shared folder."""
    now = stored(_linked(edges.select("u", "v")), "edges")
    mark = _mark(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = _linked(large).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = stored(_linked(small), "edges")
        if (new := _mark(now)) == mark:
            return now
        mark = new


__all__ = ["stars"]
