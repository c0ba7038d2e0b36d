"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination, mixing.

Each stage is (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents; the last adds topic,
n_tokens, weight and probability. The stages that drop rows by number store
the numbers with the rows. Null and empty texts, repeated rows, empty tables and extra columns are
treated as the operators state; without usable labels the quality stage keeps every document, and
without a benchmark nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import contamination, line_dedup, mixing, quality, simhash
from riskweave.llm.common import stored, table


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained model scores below its threshold go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; documents stay."""
    return line_dedup.drop_boilerplate(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest doc_id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages beyond the allowed share go."""
    return contamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens stand in the target proportions, with its weights."""
    return mixing.mix(docs, details=True)


STAGES = [
    ("quality classifier", reject_low_quality),
    ("line dedup", drop_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# a trained model and a transitive closure cannot be told in SQL; tests/llm holds the stages
# against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
