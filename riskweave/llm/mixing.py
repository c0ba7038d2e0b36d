"""Mixing sources to target weights by iterative proportional fitting (native).

The corpus is a contingency table of token sums by source, language and topic. Raking finds
weights a[source] * b[language] * c[topic] whose weighted token sums meet the three target
marginals; a document is then kept with probability weight / (largest weight), so the expected
tokens of the sample stand in the target proportions. The draw is a hash of seed and doc_id:
repeatable, independent of the partitioning, and the same for repeated rows of a doc_id.

Targets are tempered shares: proportional to (tokens of the value) ** alpha. alpha 1 keeps the
corpus as it is, 0 makes all values equal.

Defined cases: null source, language or topic count as 'unknown'; null or empty texts have 0
tokens and pass with the weight of their cell, or 1 where a cell holds no tokens at all; an
empty table gives an empty table; extra columns pass through.

Where the targets contradict each other (a source of one language whose shares differ), no weights
meet all of them; raking then ends after ROUNDS rounds with the topics met and the others as near
as they came. margin_errors() tells what is left, per value of each dimension. Null doc_ids share
one draw. A very long text is one row; ties do not occur, as a draw is compared with a probability.

Scale: documents are read for one aggregate with map-side combine and once for the draw; they
are never shuffled unless the cell table outgrows the broadcast threshold. The iteration runs on
the table of cells: a round sums it by source, by language and by topic, with map-side combine and
the other two factors joined to it, and stores the three tables of factors, so no number of values
passes the driver, which sees the largest change of a factor alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import fresh_name, stored

ALPHA = 0.8
SEED = "mix-1"
ROUNDS = 50
TOLERANCE = 1e-11
WORD = r"[^\x20\x09-\x0D]+"
UNKNOWN = "unknown"


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def topic_by_length(tokens: Column) -> Column:
    """A topic for tables without a topic column: short, medium or long form."""
    return F.when(tokens < 100, "short").when(tokens < 1000, "medium").otherwise("long")


def cells(docs: DataFrame, source: Column, lang: Column, topic: Column, tokens: Column) -> DataFrame:
    """Token sums by (source, lang, topic), with a positive sum."""
    label = [F.coalesce(c.cast("string"), F.lit(UNKNOWN)).alias(n) for c, n in ((source, "source"), (lang, "lang"), (topic, "topic"))]
    return (
        docs.select(*label, tokens.alias("tokens"))
        .groupBy("source", "lang", "topic")
        .agg(F.sum("tokens").alias("tokens"))
        .where("tokens > 0")
    )


AXES = ("source", "lang", "topic")


def targets(cell: DataFrame, alpha: float = ALPHA) -> dict[str, DataFrame]:
    """Per dimension: value, want (tokens that its weighted cells shall have)."""
    out = {}
    for axis in AXES:
        own = cell.groupBy(axis).agg(F.sum("tokens").cast("double").alias("total"))
        sums = own.agg(F.sum("total").alias("whole"), F.sum(F.pow("total", F.lit(alpha))).alias("norm")).first()
        want = F.lit(sums.whole) * F.pow("total", F.lit(alpha)) / F.lit(sums.norm)
        out[axis] = stored(own.select(axis, want.alias(f"want_{axis}")), f"targets-{axis}")
    return out


def rake(cell: DataFrame, alpha: float = ALPHA, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """cells -> source, lang, topic, tokens, weight (weighted tokens / tokens)."""
    cell = stored(cell, "cells")
    if cell.isEmpty():
        return cell.withColumn("weight", F.lit(1.0))
    want = targets(cell, alpha)
    factor = {axis: want[axis].select(axis, F.lit(1.0).alias(f"f_{axis}")) for axis in AXES}
    for _ in range(rounds):
        for axis in AXES:
            met, share = cell, F.col("tokens").cast("double")
            for x in AXES:
                if x != axis:
                    met, share = met.join(factor[x].select(x, f"f_{x}"), x), share * F.col(f"f_{x}")
            new = met.groupBy(axis).agg(F.sum(share).alias("got")).join(want[axis], axis).join(factor[axis].select(axis, F.col(f"f_{axis}").alias("old")), axis)
            new = new.select(axis, (F.col(f"want_{axis}") / F.col("got")).alias(f"f_{axis}"), "old")
            factor[axis] = stored(new.withColumn("off", F.abs(F.col(f"f_{axis}") / F.col("old") - 1)).drop("old"), f"factors-{axis}")
        changes = [factor[x].select("off") for x in AXES]
        if changes[0].union(changes[1]).union(changes[2]).agg(F.max("off")).first()[0] < tolerance:
            break
    weight = F.lit(1.0)
    for x in AXES:
        cell, weight = cell.join(factor[x].select(x, f"f_{x}"), x), weight * F.col(f"f_{x}")
    return cell.select(*AXES, "tokens", weight.alias("weight"))


def margin_errors(fitted: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """dimension, value, want, got, error (got / want - 1) of raked cells."""
    out = None
    for axis, want in targets(fitted, alpha).items():
        got = fitted.groupBy(axis).agg(F.sum(F.col("tokens") * F.col("weight")).alias("got")).join(want, axis)
        one = got.select(F.lit(axis).alias("dimension"), F.col(axis).alias("value"), F.col(f"want_{axis}").alias("want"), "got")
        out = one if out is None else out.union(one)
    return out.withColumn("error", F.col("got") / F.col("want") - 1)


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """Uniform number in [0, 1) of seed and id."""
    h = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang", topic: str | None = None,
    doc_id: str = "doc_id", alpha: float = ALPHA, seed: str = SEED, details: bool = False,
) -> DataFrame:
    """The sampled documents. With details, the columns topic, n_tokens, weight and probability
    are added (replacing columns of the same name)."""
    tokens = n_tokens(F.col(text))
    count, s, l, t = (fresh_name(docs, x) for x in ("tokens", "cell_source", "cell_lang", "cell_topic"))
    base = docs.withColumn(count, tokens)
    kind = F.col(topic) if topic else topic_by_length(F.col(count))
    fitted = rake(cells(base, F.col(source), F.col(lang), kind, F.col(count)), alpha)
    w, p = fresh_name(docs, "weight"), fresh_name(docs, "probability")
    fitted = stored(fitted.select(F.col("source").alias(s), F.col("lang").alias(l), F.col("topic").alias(t), F.col("weight").alias(w)), "weights")
    top = fitted.agg(F.max(w)).first()[0] or 1.0
    label = lambda c: F.coalesce(c.cast("string"), F.lit(UNKNOWN))
    joined = base.join(
        fitted, (label(F.col(source)) == F.col(s)) & (label(F.col(lang)) == F.col(l)) & (label(kind) == F.col(t)), "left"
    ).withColumn(w, F.coalesce(F.col(w), F.lit(1.0)))
    joined = joined.withColumn(p, F.least(F.lit(1.0), F.col(w) / F.lit(top)))
    kept = joined.where(draw(F.col(doc_id), seed) < F.col(p))
    if not details:
        return kept.select(*docs.columns)
    added = {"topic": kind, "n_tokens": F.col(count), "weight": F.col(w), "probability": F.col(p)}
    return kept.select(*[c for c in docs.columns if c not in added], *[v.alias(k) for k, v in added.items()])


__all__ = ["ALPHA", "SEED", "n_tokens", "topic_by_length", "cells", "targets", "rake", "margin_errors", "draw", "mix"]
