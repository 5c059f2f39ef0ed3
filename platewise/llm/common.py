"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import json
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from platewise.session import scratch_dir

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PRIME = np.uint64(0x9E3779B97F4A7C15)
MASK52 = (1 << 52) - 1
KEPT = 2  # shared values that a worker keeps


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of the driver as literals of the plan: ``createDataFrame`` would start Python workers for them."""
    names = [column.split()[0] for column in schema.split(",")]
    text = json.dumps([dict(zip(names, row)) for row in rows], allow_nan=False)
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema.replace(' ', ': ').replace(',: ', ', ')}>>")))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it back; ``discard`` removes it when nothing needs it any more.

    The shuffle files behind it are of no use from then on. Spark removes them when the driver has
    collected its garbage, which a driver with little to do puts off; so this asks for it.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return stored


def discard(*stored: DataFrame) -> None:
    """Remove written results that no later result reads."""
    for frame in stored:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared(spark: SparkSession, value) -> Callable[[], object]:
    """A function that gives ``value`` inside tasks: broadcast as bytes, unpacked once by each worker.

    Classes of this package travel by value with it, so executors need no copy of the package. A worker keeps the
    last KEPT values, with what they keep for themselves (caches), and takes equal bytes of a later job for the same value.
    """
    packed = cloudpickle.dumps(value)
    key, held, most = hashlib.sha256(packed).hexdigest(), spark.sparkContext.broadcast(packed), KEPT

    def get():
        from types import ModuleType
        # Task functions travel by value, so what is to outlive a task is kept in a module of the worker.
        kept = sys.modules.setdefault("_shared_values", ModuleType("_shared_values")).__dict__.setdefault("values", {})
        if key not in kept:
            while len(kept) >= most:
                del kept[next(iter(kept))]
            kept[key] = cloudpickle.loads(held.value)
        return kept[key]

    return get


def trim() -> None:
    """Give free memory that Arrow's pool and the C library hold back to the system."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if give_back is not None:
        give_back(0)


def release() -> None:
    """In a task: give back what this worker keeps of earlier jobs, shared values and free memory."""
    kept = sys.modules.get("_shared_values")
    if kept is not None and kept.__dict__.pop("values", None):
        gc.collect()
    trim()


def released(run: Callable) -> Callable:
    """A task function over batches whose worker keeps nothing of earlier jobs, and no free memory between its tasks."""
    def lean(batches):
        release()
        yield from run(batches)
        trim()
    return lean


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs inside hand Python workers so many rows at a time at most: bounds their memory where rows are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def hash52(*parts: Column | str) -> Column:
    """52 even bits of the parts' md5 as a long: the same number in any engine."""
    text = F.concat_ws(":", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("null"))
                              for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def crc_of(column: Column) -> Column:
    """CRC-32 of a value's text, as an unsigned long; null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a multiply-and-shift finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes as one array, and the n + 1 offsets; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pa.array(texts).cast(pa.large_binary())
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_chunks(texts: pa.Array, most_bytes: int = 1 << 20):
    """Slices (first row, end row) of about ``most_bytes``, one row at least: bounds the memory of a task."""
    sizes = np.asarray(pc.binary_length(texts).fill_null(0), dtype=np.int64)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        before = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield first, end
        first = end


def hash_slices(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte slice: eight bytes a step are taken in and spread; the length takes part."""
    sizes = (ends - starts).astype(np.int64)
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([raw, np.zeros(8, np.uint8)]), 8)
    h = mix(sizes.astype(np.uint64) + PRIME)
    rows, step = np.flatnonzero(sizes > 0), 0
    while len(rows):
        block = np.ascontiguousarray(words[starts[rows] + step]).view(np.uint64).ravel()
        left = sizes[rows] - step
        keep = np.where(left >= 8, np.uint64(0xFFFFFFFFFFFFFFFF),
                        (np.uint64(1) << (np.minimum(left, 7).astype(np.uint64) * np.uint64(8))) - np.uint64(1))
        h[rows] = mix((h[rows] ^ (block & keep)) * PRIME + np.uint64(step + 1))
        rows = rows[left > 8]
        step += 8
    return h


class Words:
    """The words (runs without ASCII white space) of a block of texts: places, document numbers, 64-bit hashes."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        raw, offsets = joined_bytes(texts)
        self.raw, self.offsets = raw, offsets
        n = len(raw)
        if lower:
            raw = LOWER[raw]
        inside = ~SPACE[raw]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | edge[:n]))
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.bounds = np.searchsorted(self.starts, offsets)  # first word of each text, and the end
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))
        self.hashes = hash_slices(raw, self.starts, self.ends)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of k words inside one text, and the number of each run's first word."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = self.hashes[:n - k + 1].copy()
        for i in range(1, k):
            h = mix(h * PRIME + self.hashes[i:n - k + 1 + i])
        ok = np.flatnonzero(self.doc[:n - k + 1] == self.doc[k - 1:])
        return h[ok], ok


def ragged(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """List array of consecutive runs of ``values``."""
    return pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(values)).cast(
        pa.list_(pa.array(values[:0]).type))
