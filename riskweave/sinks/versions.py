"""Versioned tables: every write is a new version, switched by one rename.

Layout of a table folder:
  data/__run=<id>/<partition>=<value>/   Parquet files of one run, never changed
  _versions/<number>.json                a manifest: for each partition the runs that make it up,
                                         the table's schema and the schema of every run
  _staged/<id>/                          a run being written

A writer stages its rows, moves them to data/ and publishes a manifest under the next number by a
rename that must not replace a file (HDFS keeps that promise; on a local disk the check and the
rename are two steps). Readers hold one manifest, so they see a version whole, before and after a
switch. A writer that dies leaves files that no manifest names.

Writers are optimistic: a manifest says which version it was made from. If another writer came
first, the commit is put on top of it as long as the partitions it rewrites are unchanged since;
otherwise it is a Conflict, and an upsert merges again from the newer version.

Schemas: a version has the columns of its last batch. A shared column may widen (int to long,
float to double, and so on) and older runs are cast when read; any other change of type is an
error, before anything is published.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = "__run"
# many small folders take time by their number, so tasks may be smaller than Spark's least partition
LEAST, LEAST_BYTES = "spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k"
LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_ORDER = ["tinyint", "smallint", "int", "bigint"]


class Conflict(Exception):
    """Another writer changed partitions that this commit rewrites."""


class SchemaError(ValueError):
    """A column's type would lose values."""


@dataclass(frozen=True)
class Version:
    number: int
    base: int
    schema: str
    partition_col: str
    parts: dict[str, list[str]] = field(default_factory=dict)
    runs: dict[str, str] = field(default_factory=dict)
    note: dict = field(default_factory=dict)


# --- files --------------------------------------------------------------------------------


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(conf), conf


def _children(spark: SparkSession, path: str) -> list[str]:
    _, p, fs, _ = _hadoop(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def _rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename unless the target exists; whether it was done."""
    jvm, src, fs, conf = _hadoop(spark, source)
    dst = jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    qualified = fs.makeQualified(src)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), conf)
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(qualified, fs.makeQualified(dst), none)
    except Exception as e:  # py4j wraps the JVM's exception
        if "FileAlreadyExists" in str(e):
            return False
        raise
    return True


def _put(spark: SparkSession, path: str, text: str) -> None:
    _, p, fs, _ = _hadoop(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()


# --- versions -----------------------------------------------------------------------------


def numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n in _children(spark, f"{path}/_versions") if n.endswith(".json") and n[:-5].isdigit()]


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version's manifest, the newest by default; None for a table without any."""
    if number is None:
        known = numbers(spark, path)
        if not known:
            return None
        number = max(known)
    text = "\n".join(r[0] for r in spark.read.text(f"{path}/_versions/{number:020d}.json", wholetext=True).collect())
    return Version(**json.loads(text))


def _publish(spark: SparkSession, path: str, v: Version) -> bool:
    """Write the manifest of version v unless its number is taken."""
    draft = f"{path}/_staged/{uuid.uuid4().hex}.json"
    _put(spark, draft, json.dumps(asdict(v)))
    return _rename_new(spark, draft, f"{path}/_versions/{v.number:020d}.json")


def struct(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


# --- schemas (SNK4) -----------------------------------------------------------------------


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of `old` is a value of `new`."""
    if old == new:
        return True
    a, b = old.simpleString(), new.simpleString()
    if a in _ORDER and b in _ORDER:
        return _ORDER.index(a) < _ORDER.index(b)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return b == "double" and a in ("float", "tinyint", "smallint", "int") or (b == "timestamp_ntz" and a == "date")


def reconcile(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of `new`; a SchemaError if a shared one would narrow."""
    before = {f.name: f.dataType for f in old}
    for f in new:
        if f.name in before and not widens(before[f.name], f.dataType):
            raise SchemaError(f"{f.name}: {before[f.name].simpleString()} does not fit {f.dataType.simpleString()}")
    return new


def _as(df: DataFrame, schema: T.StructType) -> DataFrame:
    have = set(df.columns)
    return df.select(*(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


# --- reading ------------------------------------------------------------------------------


def run_folder(path: str, run: str) -> str:
    return f"{path}/data/{RUN}={run}"


@contextmanager
def _with(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _listing(spark: SparkSession) -> AbstractContextManager[None]:
    """Folders are listed by a few tasks, not by a task for each folder."""
    return _with(spark, LISTERS, str(min(int(spark.conf.get(LISTERS)), 2 * spark.sparkContext.defaultParallelism)))


def read_run(spark: SparkSession, path: str, run: str, schema: T.StructType) -> DataFrame:
    """All rows of one run, named by a version or not."""
    with _listing(spark):
        return spark.read.schema(schema).parquet(run_folder(path, run))


def read(spark: SparkSession, path: str, number: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
    """The table at a version (the newest by default), or only some of its partition folders.
    Runs of one schema are one scan, so filters on the partition column prune folders."""
    v = version(spark, path, number)
    if v is None:
        raise FileNotFoundError(f"no version at {path}")
    return read_version(spark, path, v, parts)


def read_version(spark: SparkSession, path: str, v: Version, parts: Sequence[str] | None = None) -> DataFrame:
    """The rows that a manifest names, in its schema."""
    schema = struct(v.schema)
    folders: dict[str, list[str]] = {}
    for part in v.parts if parts is None else parts:
        for run in v.parts.get(part, []):
            folders.setdefault(v.runs[run], []).append(f"{run_folder(path, run)}/{part}")
    with _listing(spark):
        scans = [
            spark.read.schema(struct(own).add(RUN, "string")).option("basePath", f"{path}/data").parquet(*found)
            for own, found in sorted(folders.items())
        ]
    if not scans:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, (_as(s, schema) for s in scans))


# --- writing ------------------------------------------------------------------------------


def write_run(df: DataFrame, path: str, partition_col: str, check=None) -> tuple[str, list[str]]:
    """Rows as a run that no version names yet: its id and its partition folders. check(folder)
    may refuse the staged rows. Rows are first dealt by their partition, so a folder holds one file,
    or several where adaptive execution splits a large partition, and not one of every task."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    staged = f"{path}/_staged/{run}"
    with _with(spark, LEAST, LEAST_BYTES):
        df.hint("rebalance", partition_col).write.option("partitionOverwriteMode", "static").partitionBy(partition_col).parquet(staged)
    if check:
        check(staged)
    parts = [x for x in _children(spark, staged) if x.startswith(f"{partition_col}=")]
    if not _rename_new(spark, staged, run_folder(path, run)):
        raise FileExistsError(staged)
    return run, parts


def commit(spark: SparkSession, path: str, base: Version | None, made: Version) -> Version:
    """Publish `made`, whose parts are those that it rewrites, on top of the newest version."""
    while True:
        now = version(spark, path)
        if now is not None and (base is None or now.number != base.number):
            known = base.parts if base else {}
            changed = [p for p in made.parts if now.parts.get(p) != known.get(p)]
            if changed or base is None or now.schema != base.schema:
                raise Conflict(f"version {now.number} changed {changed or 'the schema'}")
        parts = {**(now.parts if now else {}), **made.parts}
        used = {r for runs in parts.values() for r in runs}
        runs = {r: s for r, s in {**(now.runs if now else {}), **made.runs}.items() if r in used}
        out = replace(made, number=now.number + 1 if now else 1, base=now.number if now else 0, parts=parts, runs=runs)
        if _publish(spark, path, out):
            return out


def upsert(batch: DataFrame, path: str, keys: Sequence[str], partition_col: str, touched: Sequence | None = None, note: dict | None = None, attempts: int = 5) -> Version:
    """Rows of the batch replace those of their keys; other rows of its partitions stay; other
    partitions keep their runs. The batch is written once, and the kept rows of its partitions
    once, by reading only those folders. touched: the partition values that it may hold."""
    spark, schema = batch.sparkSession, batch.schema

    def check(staged: str) -> None:
        if touched is None:
            return
        held = {r[0] for r in spark.read.schema(schema).parquet(staged).select(partition_col).distinct().collect()}
        if outside := held - set(touched):
            raise ValueError(f"{partition_col} outside the touched partitions: {sorted(map(str, outside))}")

    if base := version(spark, path):
        reconcile(struct(base.schema), schema)
    elif any(x.startswith(f"{partition_col}=") for x in _children(spark, path)):
        raise ValueError(f"{path} holds partitions without a version")
    run, parts = write_run(batch, path, partition_col, check)
    new = read_run(spark, path, run, schema)
    for _ in range(attempts):
        made = Version(0, 0, schema.json(), partition_col, {p: [run] for p in parts}, {run: schema.json()}, note or {})
        base = version(spark, path)
        if base is not None:
            schema_now = reconcile(struct(base.schema), schema)
            old = [p for p in parts if p in base.parts]
            if old:
                before = _as(read_version(spark, path, replace(base, schema=schema_now.json()), old), schema_now)
                kept, kept_parts = write_run(before.join(new.select(*keys), list(keys), "left_anti"), path, partition_col)
                made = replace(made, parts={p: [run, kept] if p in kept_parts else [run] for p in parts}, runs={run: schema.json(), kept: schema.json()})
        try:
            return commit(spark, path, base, made)
        except Conflict:
            continue
    raise Conflict(f"gave up after {attempts} attempts")


def replace_all(df: DataFrame, path: str, partition_col: str, note: dict | None = None) -> Version:
    """A version of these rows alone (a full rebuild); its schema may be any."""
    spark = df.sparkSession
    run, parts = write_run(df, path, partition_col)
    while True:
        now = version(spark, path)
        out = Version(now.number + 1 if now else 1, now.number if now else 0, df.schema.json(), partition_col, {p: [run] for p in parts}, {run: df.schema.json()}, note or {})
        if _publish(spark, path, out):
            return out


def vacuum(spark: SparkSession, path: str, keep: int = 2, min_age_hours: float = 24.0) -> list[str]:
    """Delete runs that none of the last `keep` versions names and that are old enough not to be
    a running writer's; the manifests of earlier versions go with them. Returns the runs."""
    known = sorted(numbers(spark, path))
    used = {r for n in known[-keep:] for r in version(spark, path, n).runs}
    gone = []
    jvm, _, fs, _ = _hadoop(spark, path)
    limit = (time.time() - min_age_hours * 3600) * 1000
    for name in _children(spark, f"{path}/data"):
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/data/{name}")
        if name.removeprefix(f"{RUN}=") not in used and fs.getFileStatus(folder).getModificationTime() <= limit:
            fs.delete(folder, True)
            gone.append(name.removeprefix(f"{RUN}="))
    if gone:
        for n in known[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/_versions/{n:020d}.json"), False)
    return gone


__all__ = ["Conflict", "SchemaError", "Version", "version", "read", "read_version", "read_run", "run_folder", "write_run", "commit", "upsert", "replace_all", "vacuum", "reconcile", "widens"]
