"""Helpers shared by the training-data operators: written intermediates, Arrow text chunks, word spans.

Intermediates are Parquet tables under the cluster's ``spark.checkpoint.dir``, so a lost executor
never costs more than the tasks it held.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from hydromart.session import checkpoint_dir

WORD_BYTES = np.ones(256, dtype=bool)
WORD_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
MASK64 = (1 << 64) - 1


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, once per application.

    The package goes as a zip into the shared checkpoint folder, and Spark hands it to the workers.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, f"{package.name}/{file.relative_to(package)}")
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{package.name}-{uuid.uuid4().hex}.zip"
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(held.getvalue()))
    stream.close()
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


class Scratch:
    """A folder of written intermediates under the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def write(self, df: DataFrame, table: str, partition_by: str | None = None) -> DataFrame:
        """Write ``df`` and read it back: the lineage ends at the written files."""
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(table))
        return self.read(df.schema, table)

    def read(self, schema, table: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(table))

    def drop(self, table: str) -> None:
        """Delete a written intermediate that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.path(table))
        fs = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of plans that nothing refers to any more."""
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = 1 << 19) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows with about ``max_bytes`` of text each: (slice, bytes, row offsets).

    Nulls count as empty. A longer text forms a slice of its own, so memory follows the longest
    single text and not the Arrow batch.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        col = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")
        _, offsets_buf, data_buf = col.buffers()
        offsets = np.frombuffer(offsets_buf, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
        data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
        start = 0
        while start < len(col):
            stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
            stop = min(max(stop, start + 1), len(col))
            yield (batch.slice(start, stop - start), data[offsets[start]:offsets[stop]],
                   offsets[start:stop + 1] - offsets[start])
            start = stop


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of concatenated texts: byte starts, ends, and word offsets per row."""
    inside = WORD_BYTES[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False  # a text never continues the one before it
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def join_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words one after another with one space behind each, and the place of each word."""
    size = ends - starts
    at = np.cumsum(size + 1) - (size + 1)
    out = np.full(int(size.sum()) + len(size), 32, np.uint8)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at, size) + step] = data[np.repeat(starts, size) + step]
    return out.tobytes(), at


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    got = _POWERS.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.empty(size, np.uint64), np.empty(size, np.uint64)
        up[0] = down[0] = 1
        up[1:], down[1:] = base, pow(base, -1, 1 << 64)
        got = (np.cumprod(up), np.cumprod(down))
        if n <= 1 << 20:  # powers for one huge text are not kept
            _POWERS[base] = got
    return got[0][:n], got[1][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser (public constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """64-bit hash of every ``values[start:end]`` from prefix sums of a polynomial with an odd base."""
    up, down = _powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
