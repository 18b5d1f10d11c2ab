"""Shared helpers: tables, the cluster's shared folder, work sizing and byte-level text scans."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    A local session that names none (tests) gets a temporary folder; on a cluster that is an error,
    as executors would write to their own disks and later reads would miss those files.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="shelfwise-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/shelfwise/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._shelfwise_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete the folders of materialized tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._shelfwise_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps now, not when the driver's heap fills."""
    gc.collect()
    spark._jvm.System.gc()


def shrink_heaps(spark: SparkSession) -> None:
    """Have executors collect their garbage and give freed heap back, so that a step's Python workers don't
    stand beside the heap that the steps before have grown. One task for each core; an executor that gets none stays as it is."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).selectExpr("reflect('java.lang.System', 'gc') AS done").collect()


#: From this size on an optimizer's estimate is its default for data that it can't size.
_UNSIZED = 1 << 60
#: Bytes of text that take one stored byte, about.
_PACKED_TEXT = 3


def plan_bytes(df: DataFrame, text: str = "text") -> int:
    """Stored size of the tables that ``df`` reads, as file listings give it; no scan is run.

    Only for data without files (local rows, an RDD) the bytes of column ``text`` are summed.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if size < _UNSIZED:
        return size
    return int(df.agg(F.sum(F.octet_length(text))).first()[0] or 0) // _PACKED_TEXT


def buckets_for(df: DataFrame, bytes_each: int, text: str = "text") -> int:
    """Work units in proportion to the input, and at least the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, plan_bytes(df, text) // bytes_each + 1)


#: Cells of a key's hash; bounds the table that ``split_by_key`` broadcasts.
KEY_CELLS = 1 << 20


def split_by_key(df: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``column`` may be among ``keys``, and rows for which that is ruled out.

    Only the hash cells that the keys fall into are broadcast, at most ``KEY_CELLS`` integers
    whatever the input, so an exact join needs to shuffle the first part alone.
    """
    cells = materialize(keys.select(F.pmod(F.xxhash64(column), F.lit(KEY_CELLS)).cast("int").alias("_cell")).distinct(), "cells")
    same = F.pmod(F.xxhash64(df[column]), F.lit(KEY_CELLS)).cast("int") == F.col("_cell")
    return df.join(F.broadcast(cells), same, "left_semi"), df.join(F.broadcast(cells), same, "left_anti")


def bound_batches(spark: SparkSession, rows: int = 1024, size: int = 4 << 20) -> None:
    """Have this session send whole texts to Python in small Arrow batches; smaller settings stay.

    Ten thousand texts in a batch, the default, take hundreds of megabytes of an executor's memory.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key, None)
        digits = re.match(r"\d+", now or "")
        if now is not None and not (digits and digits[0] == now and 0 < int(now) <= most):
            spark.conf.set(key, str(most))


def trim_memory() -> None:
    """Give a Python worker's freed memory back to the system; idle workers would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run):
    """A task function over batches that trims its worker's memory when it ends."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            trim_memory()

    return tidied


def ascii_lower(col):
    return F.translate(col, UPPER, LOWER)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of SplitMix64, a bijection on 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z only) words in UTF-8 ``data`` and their start offsets.

    Words are maximal runs without the bytes 0x20 and 0x09-0x0D, which never occur inside
    a multi-byte UTF-8 character.
    """
    raw = np.frombuffer(data.translate(_FOLD), dtype=np.uint8)
    word = np.empty(len(raw) + 2, dtype=np.int8)
    word[0] = word[-1] = 0
    np.logical_not(_SPACE[raw], out=word[1:-1], casting="unsafe")
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return span_hashes(raw, starts, ends), starts


#: Spans of more bytes than this are hashed one by one.
_LONG_SPAN = 512


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans ``raw[start:end]``.

    Eight bytes at a time go through a bijection that isn't linear, so no structure of a span
    cancels out; long spans take their BLAKE2 digest.
    """
    size = ends - starts
    out = mix64(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    if not len(starts):
        return out
    padded = np.concatenate([raw, np.zeros(8, dtype=np.uint8)])
    lanes = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    live = np.flatnonzero((size > 0) & (size <= _LONG_SPAN))
    at, left = starts[live], size[live]
    while len(live):
        part = lanes[at]
        short = left < 8
        part[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        out[live] = mix64((out[live] ^ part) + np.uint64(0xD6E8FEB86659FD93))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > _LONG_SPAN):
        digest = hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, dtype="<u8")[0]
    return out


def same_spans(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> bool:
    """Whether every span of ``raw`` from ``a`` on equals the one from ``b`` on, byte by byte, ``size`` bytes each."""
    padded = np.concatenate([raw, np.zeros(8, dtype=np.uint8)])
    lanes = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    differ = a != b
    for i in np.flatnonzero(differ & (size > _LONG_SPAN)):
        if not np.array_equal(raw[a[i] : a[i] + size[i]], raw[b[i] : b[i] + size[i]]):
            return False
    live = differ & (size > 0) & (size <= _LONG_SPAN)
    a, b, left = a[live], b[live], size[live]
    while len(a):
        gap = lanes[a] ^ lanes[b]
        short = left < 8
        gap[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        if gap.any():
            return False
        more = left > 8
        a, b, left = a[more] + 8, b[more] + 8, left[more] - 8
    return True


_STEP = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_sets(texts: pa.Array, width: int = 5, chunk_bytes: int = 1 << 20):
    """Yield for every text the sorted distinct 64-bit hashes of its ``width``-word shingles.

    A text of fewer words is one shingle made of its whole word sequence; a null text or one
    without words has none.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    view = memoryview(body) if body is not None else memoryview(b"")
    empty = np.empty(0, dtype=np.uint64)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + chunk_bytes, side="right")) - 1
        end = min(max(end, at + 1), len(texts))
        # a separator between texts keeps words apart
        pieces = [view[offsets[i] : offsets[i + 1]] for i in range(at, end)]
        hashes, starts = word_hashes(b"\n".join(pieces))
        begins = offsets[at : end + 1] - offsets[at] + np.arange(end - at + 1)
        cut = np.searchsorted(starts, begins)
        grams = empty
        if len(hashes) >= width:
            grams = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
            for j in range(width):
                grams += hashes[j : len(hashes) - width + 1 + j] * _STEP[j % 5] * np.uint64(2 * j + 1)
            grams = mix64(grams)
        for i in range(end - at):
            a, b = int(cut[i]), int(cut[i + 1])
            if b == a:
                yield empty
            elif b - a < width:
                h = np.uint64(b - a)
                with np.errstate(over="ignore"):
                    for w in hashes[a:b]:
                        h = mix64(np.array([h * _STEP[1] + w], dtype=np.uint64))[0]
                yield np.array([h], dtype=np.uint64)
            else:
                yield np.unique(grams[a : b - width + 1])
        at = end
