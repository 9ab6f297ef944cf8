"""Shared pieces of the training-data operators: staging and vectorised text scans.

Texts are scanned as the bytes of an Arrow batch, in chunks of whole documents of
about ``CHUNK_BYTES``, so memory stays bounded however many rows a batch has.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 1 << 19  # hashes take 8 bytes and more a byte of it, which a Python worker keeps
#: Bytes of an Arrow batch on its way to a Python worker (Spark's own bound is 64 MB, on either side of the pipe).
BATCH_BYTES = 1 << 22
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_staged: dict[str, SparkSession] = {}
_malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees (``spark.checkpoint.dir``); set here only if unset."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or getattr(spark, "_factline_dir", None)
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="factline-", dir=_checkpoint_root())
        spark._factline_dir = path
    return path.rstrip("/")


def _checkpoint_root() -> str:
    os.makedirs("/tmp/checkpoints", exist_ok=True)
    return "/tmp/checkpoints"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back: lineage ends at files
    that outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _staged[path] = spark
    out._staged_path = path
    return out


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Plans run inside send Arrow batches of BATCH_BYTES (or one row), whatever the length of the rows."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads again: what came of them is staged itself."""
    for df in tables:
        _delete(df._staged_path)


def release() -> None:
    """Lets Spark drop the shuffle files of finished jobs (it does when the driver collects garbage).

    Twice, as what Python lets go and what the JVM finds dead are given up a moment later."""
    spark = SparkSession.getActiveSession()
    for _ in range(2):
        gc.collect()
        if spark is not None:
            spark.sparkContext._jvm.System.gc()
            time.sleep(0.3)


def _delete(path: str) -> None:
    spark = _staged.pop(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for path in list(_staged):
        try:
            _delete(path)
        except Exception:  # noqa: BLE001 - the session may be gone already
            return


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# --- bytes of a batch -------------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Whole documents in runs of about ``size`` bytes: first document, bytes, offsets."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    _trim()


def _trim() -> None:
    """Gives free memory back: a Python worker waits for its next task with what it holds, and an executor has several."""
    pa.default_memory_pool().release_unused()
    if _malloc_trim is not None:
        _malloc_trim(0)


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = ~byte_table(b" \t\n\x0b\x0c\r")
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased
ALNUM = byte_table(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each document the index of its first word (n+1 values)."""
    inside = table[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[:-1][np.diff(offsets) > 0]  # documents touch in the buffer
    starts[edge] = inside[edge]
    ends[edge[edge > 0] - 1] = inside[edge[edge > 0] - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


# --- hashes -----------------------------------------------------------------------------

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(0, 1 << 63, 1 << 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_STEP = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for k, base in ((0, _P), (1, _P_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: polynomial over the bytes by differences of one running sum.

    Equal bytes give equal hashes wherever they stand."""
    up, down = _power(len(data))
    run = np.empty(len(data) + 1, np.uint64)
    run[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_windows(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """The hash of each k consecutive word hashes (k <= 32), over one array, ends of documents ignored."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += words[j : j + n] * _STEP[(salt * 31 + j) % 64]
    return mix(out + np.uint64(k + 977 * salt))


def owners(first: np.ndarray) -> np.ndarray:
    """The document of each word, from word_spans' third value."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
