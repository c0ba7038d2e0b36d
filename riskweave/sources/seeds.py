"""SRC1/SRC2: typed CSV seeds and named raw sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskweave.sources import schemas


def read_seed_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a seed CSV with its declared schema; blank cells are NULL (no inference)."""
    return (
        spark.read.schema(schemas.RAW[table])
        .option("header", True)
        .option("nullValue", "")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("mode", "FAILFAST")
        .csv(path)
    )


@dataclass(frozen=True)
class RawSources:
    """Where the four raw tables live: a database (catalog tables) or a parquet root."""

    database: str | None = "raw"
    parquet_root: str | None = None

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if self.parquet_root is not None:
            return spark.read.parquet(f"{self.parquet_root.rstrip('/')}/{table}")
        name = f"{self.database}.{table}" if self.database else table
        return spark.table(name)

    def load(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {t: self.read(spark, t) for t in schemas.RAW}


def read_predictions(spark: SparkSession, name: str = "ml_output.ml_predictions") -> DataFrame:
    """SRC3: the prediction table written by the ML scoring step."""
    return spark.table(name)


def load_current_features(
    spark: SparkSession,
    columns: list[str],
    candidates: tuple[str, ...] = (
        "intermediate.int_churn_features",
        "spark_catalog.intermediate.int_churn_features",
        "int_churn_features",
    ),
) -> DataFrame:
    """SRC4: the feature table under the first name that exists, only the needed columns."""
    for name in candidates:
        if spark.catalog.tableExists(name):
            return spark.table(name).select(*columns)
    raise LookupError(f"none of {candidates} exists; run the weekly build first")
