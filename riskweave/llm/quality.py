"""Quality classifier: histogram gradient-boosted trees over document statistics.

Training takes at most MAX_TRAIN labelled rows (those of the smallest hash of doc_id, a bound
that does not grow with the corpus): their statistics, a few floats a row, are put into quantile
bins, and trees of fixed depth are grown level by level from gradient histograms with logistic
loss. The trees are flattened into arrays (feature, threshold, leaf value by tree and node), which
every task walks for whole batches at once with numpy.

Inputs are statistics of the text alone. Rows with crc32(doc_id as text) mod 4 = 2 are held out.

Defined cases: null text is empty, and all its statistics are 0; a null doc_id is never held out;
null labels and doc_ids with contradicting labels are not learnt from; without any usable label
the model is None and every score is 0.5 (keep() then keeps all); with labels of one class the
score is near that class; repeated rows score alike; extra columns pass through; an empty table
gives an empty table.

Scale: one pass of the texts through Python; statistics run over blocks of bounded size; nothing
is shuffled. The labelled sample is broadcast, being bounded.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import as_bytes, bounded_batches, fresh_name

MAX_TRAIN = 20_000
KEEP_SCORE = 0.7
TREES, DEPTH, BINS, RATE, MIN_LEAF, RIDGE = 60, 4, 64, 0.15, 20, 1.0

# classes of bytes whose share of a text is a statistic
CLASSES = {
    "upper": rb"[A-Z]", "lower": rb"[a-z]", "digit": rb"[0-9]", "blank": rb"[ \t]", "newline": rb"[\r\n]", "stop": rb"[.?]", "comma": rb"[,;:]",
    "shout": rb"[!]", "bar": rb"[|]", "symbol": rb"[#$%&*+=<>@^_~\\/]", "quote": rb"[\"'`(){}\[\]-]", "lead": rb"[\xC0-\xFF]", "tail": rb"[\x80-\xBF]", "control": rb"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]",
}
_TABLE = np.zeros(256, np.uint8)
for _i, _pattern in enumerate(CLASSES.values()):
    for _b in range(256):
        if re.fullmatch(_pattern, bytes([_b])):
            _TABLE[_b] = _i
STATS = [
    "log_bytes", *CLASSES, "words", "word_bytes", "longest_word", "distinct_words", "repeated_next", "lines", "distinct_lines", "line_words",
]


def statistics(texts: pa.Array) -> np.ndarray:
    """(rows, len(STATS)) statistics of a string array; empty and null texts have zeros."""
    raw, offsets = as_bytes(texts)
    out = np.zeros((len(texts), len(STATS)))
    k = len(CLASSES)
    for i in range(len(texts)):
        lo, hi = offsets[i], offsets[i + 1]
        n = hi - lo
        if n == 0:
            continue
        part = raw[lo:hi]
        row = out[i]
        row[0] = np.log1p(n)
        row[1 : k + 1] = np.bincount(_TABLE[part], minlength=k) / n
        text = part.tobytes()
        words, lines = text.split(), text.split(b"\n")
        if w := len(words):
            row[k + 1 : k + 6] = np.log1p(w), sum(map(len, words)) / w, np.log1p(max(map(len, words))), len(set(words)) / w, sum(map(eq, words, words[1:])) / w
        row[k + 6 : k + 9] = np.log1p(len(lines)), len(set(lines)) / len(lines), w / len(lines)
    return out


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth, flattened: node i has children 2i+1 and 2i+2."""

    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray  # goes right if above
    leaf: np.ndarray  # (trees, 2**depth)
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.start)
        inner = self.feature.shape[1]
        depth = inner.bit_length()
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Forest:
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)])
    prior = min(max(y.mean(), 1e-3), 1 - 1e-3)
    start = float(np.log(prior / (1 - prior)))
    total, inner = np.full(n, start), 2**depth - 1
    feature, threshold, leaf = np.zeros((trees, inner), np.int16), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess, node = y - p, p * (1 - p), np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            here = node - first
            best, pick, cut = np.zeros(width), np.zeros(width, np.int64), np.full(width, np.inf)
            for j in range(m):
                size = len(edges[j]) + 1
                at = here * size + binned[j]
                g, h, c = (np.bincount(at, v, width * size).reshape(width, size).cumsum(1) for v in (grad, hess, np.ones(n)))
                gain = g**2 / (h + RIDGE) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + RIDGE) - g[:, -1:] ** 2 / (h[:, -1:] + RIDGE)
                gain[(c < MIN_LEAF) | (c[:, -1:] - c < MIN_LEAF)] = 0
                b = gain[:, :-1].argmax(1) if size > 1 else np.zeros(width, np.int64)
                value = gain[np.arange(width), b]
                better = value > best + 1e-9
                best[better], pick[better] = value[better], j
                if size > 1:
                    cut[better] = edges[j][b[better]]
            feature[t, first : first + width], threshold[t, first : first + width] = pick, cut
            node = 2 * node + 1 + (x[np.arange(n), pick[here]] > cut[here])
        at = node - inner
        g, h = (np.bincount(at, v, inner + 1) for v in (grad, hess))
        leaf[t] = rate * g / (h + RIDGE)
        total += leaf[t][at]
    return Forest(feature, threshold, leaf, start)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", max_train: int = MAX_TRAIN) -> Forest | None:
    """The forest of at most max_train labelled rows that are not held out."""
    bounded_batches(docs.sparkSession)
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("other"))
        .where("y = other")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)
        .select(F.col("doc_id").alias("labelled"), "y")
    )
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # of repeated doc_ids one text is learnt from, so the sample stays bounded
    rows = texts.join(F.broadcast(chosen), F.col("id") == F.col("labelled")).groupBy("id", "y").agg(F.min("text").alias("text"))

    def stats(batches):
        for batch in batches:
            x = statistics(batch.column(0))
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATS)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), values], ["id", "y", "x"])

    got = rows.select("text", "id", F.col("y").cast("int").alias("y")).mapInArrow(stats, "id long, y int, x array<double>")
    # at most max_train rows of a few floats; in a fixed order, so that sums are repeatable
    got = got.toArrow().sort_by("id")
    if got.num_rows == 0:
        return None
    x = got["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATS))
    return fit(x, got["y"].to_numpy().astype(float))


def score_column(model: Forest | None, text: Column) -> Column:
    """Probability of label 1."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(statistics(texts)))

    return score(text)


def classify(docs: DataFrame, model: Forest | None, text: str = "text") -> DataFrame:
    """docs with score and predicted."""
    bounded_batches(docs.sparkSession)
    scored = docs.drop("score", "predicted").withColumn("score", score_column(model, F.col(text)))
    return scored.withColumn("predicted", (F.col("score") >= KEEP_SCORE).cast("int"))


def keep(docs: DataFrame, model: Forest | None, text: str = "text") -> DataFrame:
    """The documents that the model predicts to be of label 1, with the columns of docs."""
    if model is None:
        return docs
    bounded_batches(docs.sparkSession)
    score = fresh_name(docs, "score")
    return docs.withColumn(score, score_column(model, F.col(text))).where(F.col(score) >= KEEP_SCORE).drop(score)


__all__ = ["STATS", "statistics", "Forest", "fit", "held_out", "train", "score_column", "classify", "keep"]
