"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import ensure_checkpoint_dir, scratch_path

# text bytes that one vectorised step looks at: bounds the temporaries of a Python worker
BLOCK_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the cluster's shared folder and read again: cuts the lineage,
    survives lost executors, and lets the planner see the true size."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, number: str, name: str) -> DataFrame:
    """df with a row number in the column `number`, stored together: every later reading finds the
    same number at a row, whatever the partitions are that the reading packs files into."""
    return stored(df.withColumn(number, F.monotonically_increasing_id()), name)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not use, for helper columns beside unknown extra ones."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of an Arrow string or binary column; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, offsets


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole rows in steps of at most `limit` bytes (a longer text is a step of its own):
    first row, end row, bytes, offsets into these bytes."""
    raw, offsets = as_bytes(column)
    row, rows = 0, len(column)
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end





def bounded_batches(spark: SparkSession, limit: int = 32 << 20) -> None:
    """Hold the bytes of an Arrow batch that a Python worker gets to `limit`, unless the session
    asks for less already."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(key).rstrip("bB"))
    if not 0 < now <= limit:
        spark.conf.set(key, str(limit))


def packed(text: Column) -> Column:
    """UTF-8 of text under zstd, for a shuffle: well under half of the text, and less than the
    shuffle's own compression makes of it. Null is the empty text."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        raw, at = as_bytes(texts)
        press = zstandard.ZstdCompressor(level=1)
        return pa.array([press.compress(raw[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())

    return pack(text)


def unpacked(column: pa.Array) -> Iterator[bytes]:
    """The texts of a packed() column, one at a time."""
    press = zstandard.ZstdDecompressor()
    return (press.decompress(x.as_py()) for x in column)


def unpacked_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """blocks() of a packed() column; only the texts of one step are unpacked at a time."""
    held: list[bytes] = []
    size = first = 0

    def step() -> tuple[int, int, np.ndarray, np.ndarray]:
        return first, first + len(held), np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)])

    for text in unpacked(column):
        if held and size + len(text) > limit:
            yield step()
            first, size = first + len(held), 0
            held.clear()
        held.append(text)
        size += len(text)
    if held:
        yield step()
