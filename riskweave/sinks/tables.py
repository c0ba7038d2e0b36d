"""Table sinks (SNK1-8): views, full rebuilds, keyed incremental upsert with schema sync,
namespace routing, prediction tables and model persistence.

Nothing reads and overwrites the same files: a rebuild writes a new location and switches the
table to it, an upsert publishes a new version (sinks/versions.py).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import ensure_checkpoint_dir
from riskweave.sinks import versions


# --- namespaces (SNK7) -------------------------------------------------------------------


def schema_name(custom: str | None, target: str) -> str:
    """A model's configured schema is used verbatim (trimmed); without one, the target's."""
    return target if custom is None else custom.strip()


def qualify(table: str, custom: str | None = None, target: str = "main") -> str:
    return f"{schema_name(custom, target)}.{table}"


# FIXED VALUES: layer -> configured schema
LAYER_SCHEMAS = {
    "seeds": "raw",
    "staging": "staging",
    "intermediate": "intermediate",
    "marts": "marts",
    "snapshots": "snapshots",
    "ml": "ml_output",
}


# --- views and full rebuilds (SNK1, SNK2, SNK6) ----------------------------------------------


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def write_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> int | None:
    """Full rebuild of a catalog table (CREATE SCHEMA IF NOT EXISTS + overwrite).

    With a path the rows go to a new folder under it, and a table of the same columns is switched
    to that folder in one catalog step, so readers never find it absent or half written. The
    folders of earlier rebuilds stay until they are removed with the table's folder."""
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    if not path:
        w = df.write.mode("overwrite").format("parquet")
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)
        return None
    folder = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    w = df.write.format("parquet")
    (w.partitionBy(*partition_by) if partition_by else w).save(folder)
    if spark.catalog.tableExists(name) and not partition_by and _columns(spark.table(name)) == _columns(df):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
        return None
    # a new table, other columns or partitions: the definition itself changes
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=folder, source="parquet")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    return None


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def replace_predictions(df: DataFrame, name: str = "ml_output.ml_predictions", path: str | None = None) -> int:
    """SNK6: replace the prediction table and report its row count (read back)."""
    write_table(df, name, path=path)
    return df.sparkSession.table(name).count()


# --- keyed incremental upsert (SNK3, SNK4) ---------------------------------------------------


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_col: str,
    touched: Sequence | None = None,
) -> DataFrame:
    """Merge `batch` into the versioned table at `path` on `keys` (dbt-style incremental).

    Rows of the batch replace target rows with the same key; target rows of the batch's
    partitions without a match stay (stale rows are never deleted); other partitions are neither
    read nor written. The batch's columns become the table's; a shared column's type may widen.
    touched: the partition values the batch may hold; any other is an error.
    Returns the table at the new version.
    """
    made = versions.upsert(batch, path, keys, partition_col, touched)
    return versions.read(batch.sparkSession, path, made.number)


# --- model persistence (SNK8) ----------------------------------------------------------------


def save_model(model, path: str, meta: dict) -> None:
    """PipelineModel plus a one-row metadata table next to it."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.builder.getOrCreate()
    row = {k: (v if not isinstance(v, (list, tuple)) else list(v)) for k, v in meta.items()}
    spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load_model(spark: SparkSession, path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(f"{path}/model"), spark.read.json(f"{path}/metadata").first().asDict()


# --- snapshot table (SNK5) -------------------------------------------------------------------


def _file_context(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm, jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        jvm.org.apache.hadoop.fs.Path(path).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    ) if "://" in path else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())


def _snapshot_runs(spark: SparkSession, path: str) -> list[dict]:
    """Runs of the stored history in order ({"ts", "id"}), from its pointer file."""
    if not path_exists(spark, f"{path}/runs.json"):
        return []
    return [r.asDict() for r in spark.read.schema("ts string, id string").json(f"{path}/runs.json").orderBy("ts").collect()]


def _publish_runs(spark: SparkSession, path: str, runs: list[dict]) -> None:
    """Replace the pointer file in one rename: readers see the old state or the new one."""
    jvm, fc = _file_context(spark, path)
    hpath = jvm.org.apache.hadoop.fs.Path
    tmp, final = hpath(f"{path}/.runs-{uuid.uuid4().hex}.json"), hpath(f"{path}/runs.json")
    fs = tmp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(tmp)
    out.write(bytearray("\n".join(json.dumps(r) for r in runs).encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    fc.rename(tmp, final, options)


def read_snapshot(spark: SparkSession, path: str, runs: list[dict] | None = None) -> DataFrame:
    """The stored history: the open versions of the last run and all closed ones."""
    runs = _snapshot_runs(spark, path) if runs is None else runs
    open_ = spark.read.parquet(f"{path}/open/{runs[-1]['id']}")
    return open_.unionByName(spark.read.schema(open_.schema).parquet(*[f"{path}/closed/{r['id']}" for r in runs]))


def apply_snapshot(
    spark: SparkSession, path: str, current: DataFrame, ts, key: str = "account_id"
) -> DataFrame:
    """Run one snapshot against the stored history at `path` and store the result.

    A run writes the versions it leaves open and those it closes to folders of its own and then
    switches the pointer file, so a crash leaves the previous state, and closed versions of
    earlier runs are never read or written again. Repeating the last run (same ts) replaces it:
    it starts from the state before that run. An older ts is an error."""
    from riskweave.operators.history import scd2_apply

    runs, stamp = _snapshot_runs(spark, path), ts.isoformat()
    if runs and stamp < runs[-1]["ts"]:
        raise ValueError(f"snapshot at {stamp} is older than the last run at {runs[-1]['ts']}")
    if runs and stamp == runs[-1]["ts"]:
        runs = runs[:-1]
    before = spark.read.parquet(f"{path}/open/{runs[-1]['id']}") if runs else None
    ensure_checkpoint_dir(spark)
    after = scd2_apply(before, current, ts, key=key).checkpoint(eager=True)
    run = {"ts": stamp, "id": uuid.uuid4().hex}
    still = F.col("dbt_valid_to").isNull()
    after.where(still).write.parquet(f"{path}/open/{run['id']}")
    after.where(~still).write.parquet(f"{path}/closed/{run['id']}")
    _publish_runs(spark, path, [*runs, run])
    return read_snapshot(spark, path)
