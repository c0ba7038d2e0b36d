"""Ranking measures of a score against a 0/1 label (ML11, AGG13, ML10), without sorting the rows.

Rows are counted by score first; only distinct scores are sorted, range-partitioned, with running
counts from the partitions' sums (ranking.running). Ties are exact: a positive and a negative of
one score count one half, as in the Mann-Whitney statistic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.operators.ranking import ordered, ranked_within, running
from riskweave.session import stored

SEED = 42


def score_histogram(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives of each distinct score (of each group)."""
    y = F.col(label) == 1
    return df.groupBy(*by, F.col(score).alias("score")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))


def auc(df: DataFrame, score: str, label: str, by: str | None = None) -> DataFrame:
    """Area under the ROC curve by ranks: n_positive, n_negative, auc (null with one class only);
    one row, or one per value of `by`, which are then measured together in one sort."""
    group = by or "__all"
    base = df if by else df.withColumn(group, F.lit(0))
    cumulated = running(score_histogram(base, score, label, [group]), [F.col(group), F.col("score")], ["neg"])
    # negatives of earlier groups are those before the group's first score
    pos, neg, below = (F.col(c).cast("decimal(38,0)") for c in ("pos", "neg", "neg_before"))
    sums = cumulated.groupBy(group).agg(
        F.sum("pos").alias("n_positive"), F.sum("neg").alias("n_negative"),
        F.sum(pos * (below * 2 + neg)).alias("wins"), F.min("neg_before").alias("start"),
    )
    total = F.col("n_positive").cast("double") * F.col("n_negative")
    wins = F.col("wins").cast("double") - F.col("start").cast("double") * 2 * F.col("n_positive")
    out = sums.select(group, "n_positive", "n_negative", F.try_divide(wins, total * 2).alias("auc"))
    return out if by else out.drop(group)


def threshold_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision-recall points: for every distinct score as the threshold (rows at or above it are
    flagged) n_flagged, true_positives, precision, recall, f1, and whether its f1 is the best (the
    highest threshold of equals)."""
    points = running(score_histogram(df, score, label), [F.desc("score")], ["pos", "neg"])
    hits, flagged = F.col("pos_before") + F.col("pos"), F.col("pos_before") + F.col("pos") + F.col("neg_before") + F.col("neg")
    positives = df.select(F.count_if(F.col(label) == 1)).scalar()
    points = points.select(F.col("score").alias("threshold"), flagged.alias("n_flagged"), hits.alias("true_positives")).select(
        "threshold", "n_flagged", "true_positives",
        (F.col("true_positives") / F.col("n_flagged")).alias("precision"),
        F.try_divide(F.col("true_positives"), positives).alias("recall"),
        (F.col("true_positives") * 2.0 / (F.col("n_flagged") + positives)).alias("f1"),
    )
    points = stored(points, "threshold-points")
    best = points.select(F.max(F.struct("f1", "threshold"))["threshold"]).scalar()
    return points.withColumn("best", F.col("threshold") == best)


def permuted(df: DataFrame, key: str, columns: Sequence[str], name: str = "permuted", seed: int = SEED) -> DataFrame:
    """One copy of df per column, in which that column's values are dealt to other rows: the row at
    place r of the key order gets the value of the row at place r of the order by a hash of key,
    column and seed. All orders are one sort; no row is collected."""
    df = stored(df, "permuted-input")
    keyed = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col("__column"), F.lit(str(seed))))
    place = ordered(df.select(key), F.asc(key)).ranked("__place")
    rows = df.join(place, key)
    copies = df.select(F.explode(F.array(*map(F.lit, columns))).alias("__column"), "*")
    copies = copies.select("__column", key, *(F.when(F.col("__column") == c, F.col(c)).alias(f"__{c}") for c in columns))
    dealt = ranked_within(copies.withColumn("__hash", keyed), "__column", "__hash", key, rank="__place").drop(key, "__hash")
    mixed = rows.join(dealt, "__place")
    new = {c: F.when(F.col("__column") == c, F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}
    out = mixed.withColumns(new).withColumn(name, F.col("__column"))
    return out.select(name, *df.columns)


def importance(df: DataFrame, key: str, columns: Sequence[str], score: Column | None, label: str, rescore=None, seed: int = SEED) -> DataFrame:
    """Permutation importance: the drop of the AUC when a column is permuted. rescore(frame) gives
    frames with a column `score` (or `score` is an expression of the columns). Rows: feature, auc
    after permutation, auc_drop, rank (largest drop first)."""
    scored = rescore or (lambda x: x.withColumn("score", score))
    base = scored(df.withColumn("permuted", F.lit("")))
    mixed = scored(permuted(df, key, columns, "permuted", seed))
    both = base.select("permuted", "score", label).union(mixed.select("permuted", "score", label))
    measured = auc(both, "score", label, by="permuted")
    measured = stored(measured, "permuted-auc")
    whole = measured.where("permuted = ''").select("auc").scalar()
    out = measured.where("permuted <> ''").select(F.col("permuted").alias("feature"), "auc", (whole - F.col("auc")).alias("auc_drop"))
    # one row per feature
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(F.round("auc_drop", 12)), "feature")))


__all__ = ["score_histogram", "auc", "threshold_curve", "permuted", "importance"]
