"""Distributed order statistics (ORD1-3): rank, quantiles and pages over all rows.

The rows are range-partitioned and sorted by the order columns and stored with their place: the
partition and the number within it. The partitions' sizes give every partition the count of rows
before it, so a row's rank is that count plus its own number. No window spans all rows or a group
of few values; the only window runs over one row per partition of the sort.

The order must be total for ranks to be repeatable (end it with a key). Sampling for the ranges is
Spark's; the stored places do not depend on it, only the partitions' sizes do.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.session import stored

PART, AT, BEFORE = "__part", "__at", "__before"


@dataclass(frozen=True)
class Ordered:
    """Rows in order. rows: with their partition and number in it; offsets: rows before each
    partition (one row per partition of the sort, the proven size of its broadcast)."""

    rows: DataFrame
    offsets: DataFrame
    n: int

    def ranked(self, rank: str = "rank") -> DataFrame:
        """All rows with their rank from 1."""
        return self._placed(self.offsets, rank)

    def _placed(self, offsets: DataFrame, rank: str) -> DataFrame:
        joined = self.rows.join(F.broadcast(offsets.select(PART, BEFORE)), PART)
        return joined.withColumn(rank, F.col(BEFORE) + F.col(AT) + 1).drop(PART, AT, BEFORE)

    def between(self, first: int, last: int, rank: str = "rank") -> DataFrame:
        """Rows of ranks first..last; partitions outside are left out by their offsets."""
        offsets = self.offsets.where((F.col(BEFORE) < last) & (F.col(BEFORE) + F.col("n") >= first))
        return self._placed(offsets, rank).where(F.col(rank).between(first, last))

    def page(self, number: int, size: int, rank: str = "rank") -> DataFrame:
        """Page `number` (from 1) of `size` rows."""
        return self.between((number - 1) * size + 1, number * size, rank)

    def quantiles(self, per_mille: Sequence[int], rank: str = "rank") -> DataFrame:
        """The row at each quantile (nearest rank: the smallest row with at least q of all rows at
        or before it), with the quantile in thousandths."""
        wanted = {q: max(1, -(-q * self.n // 1000)) for q in per_mille}
        if not self.n:
            return self.ranked(rank).withColumn("per_mille", F.lit(0))
        lookup = F.array(*(F.struct(F.lit(q).alias("per_mille"), F.lit(r).cast("long").alias("rank")) for q, r in wanted.items()))
        hit = self.ranked(rank).where(F.col(rank).isin(sorted(set(wanted.values()))))
        at = F.transform(F.filter(lookup, lambda x: x["rank"] == F.col(rank)), lambda x: x["per_mille"])
        return hit.withColumn("per_mille", F.explode(at))


def ordered(df: DataFrame, *order: Column | str) -> Ordered:
    """Sort df by a total order and number its rows."""
    place = F.monotonically_increasing_id()
    rows = stored(
        df.orderBy(*order).withColumn("__place", place)
        .withColumn(PART, F.shiftright("__place", 33).cast("int"))
        .withColumn(AT, F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__place"),
        "ordered-rows",
    )
    sizes = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    # one row per partition of the sort
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(sizes.withColumn(BEFORE, F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long")), "partition-offsets")
    return Ordered(rows, offsets, int(offsets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]))


def running(df: DataFrame, order: Sequence[Column | str], sums: Sequence[str]) -> DataFrame:
    """df with `<c>_before`, the sum of c over all rows before this one in the order: a running sum
    within each partition of the sort, plus the sums of the partitions before it."""
    rows = ordered(df, *order).rows
    totals = rows.groupBy(PART).agg(*(F.sum(c).alias(f"__{c}") for c in sums))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = stored(totals.select(PART, *(F.coalesce(F.sum(f"__{c}").over(before), F.lit(0)).alias(f"__{c}") for c in sums)), "partition-sums")
    own = Window.partitionBy(PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(F.broadcast(totals), PART)
    added = {f"{c}_before": F.coalesce(F.sum(c).over(own), F.lit(0)) + F.col(f"__{c}") for c in sums}
    return joined.withColumns(added).drop(PART, AT, *(f"__{c}" for c in sums))


def ranked_within(df: DataFrame, group: str, *order: Column | str, rank: str = "rank") -> DataFrame:
    """Rank from 1 within each value of `group`: rows are sorted by group and order together, and
    each group's first rank (a minimum) is taken off."""
    all_ranks = ordered(df, F.col(group), *order).ranked("__global")
    first = all_ranks.groupBy(F.col(group).alias("__group")).agg(F.min("__global").alias("__first"))
    joined = all_ranks.join(first, F.col(group).eqNullSafe(F.col("__group")))
    return joined.withColumn(rank, (F.col("__global") - F.col("__first") + 1).cast("int")).drop("__global", "__group", "__first")


__all__ = ["Ordered", "ordered", "running", "ranked_within"]
