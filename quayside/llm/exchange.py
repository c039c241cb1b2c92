"""Shuffling many small fixed-size entries as few binary rows.

A map task collects (64-bit key, integer columns) entries, sorts them by key and emits one row
per key range ("bucket") with the entries packed as byte planes: sorted keys as differences,
integers relative to their minimum, each with as many bytes as its largest value needs. Spark
shuffles the rows by bucket; the reduce task unpacks them with numpy. Against one row per
entry this saves the row overhead and most of the JVM work, and lets equal keys of one task be
merged before they are shuffled.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "bucket"
BLOB_SCHEMA = pa.schema([(BUCKET, pa.int32()), ("blob", pa.binary())])
BLOB_DDL = "bucket int, blob binary"


def release_memory() -> None:
    """Gives memory that numpy and Arrow have freed back to the system: Python workers are kept
    for later tasks, and what one stage needed at its peak would stay with them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def settle_driver(spark: SparkSession) -> None:
    """Has the driver give back what it holds of ended jobs: its Python first, since handles there keep
    plans alive in the JVM, whose heap grows to its limit if nothing collects it. Spark then drops the
    shuffle files that nothing refers to any more."""
    gc.collect()
    release_memory()
    spark.sparkContext._jvm.java.lang.System.gc()


def settle(spark: SparkSession) -> None:
    """Has idle Python workers give back what they hold of earlier stages: a task's last batch
    and what it was made of stay with the worker until its next task. A few empty tasks per core reach
    them all, as Spark hands out idle workers in turn. The driver gives back its own."""
    settle_driver(spark)

    def give_back(batches):
        gc.collect()
        release_memory()
        yield from batches

    n = 4 * spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).mapInArrow(give_back, "id long").write.format("noop").mode("overwrite").save()


def _planes(x: np.ndarray) -> tuple[int, bytes]:
    top = int(x.max()) if len(x) else 0
    width = max(1, (top.bit_length() + 7) // 8)
    return width, np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unplanes(buf: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(buf, np.uint8, n * width).reshape(n, width)
    return out.reshape(-1).view(np.uint64)


def pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Keys (sorted uint64) and int64 columns of the same length as one blob."""
    n = len(keys)
    head, body = [n, len(columns), int(keys[0]) if n else 0], []
    for i, x in enumerate((keys, *columns)):
        if i == 0:
            x = np.diff(x, prepend=x[:1])
        else:
            x = x.astype(np.int64)
            low = int(x.min()) if n else 0
            head.append(low)
            x = (x - low).view(np.uint64)
        width, b = _planes(x)
        head.append(width)
        body.append(b)
    return np.array([h - (1 << 64) if h >= 1 << 63 else h for h in head], np.int64).tobytes() + b"".join(body)


def unpack(blob: bytes) -> list[np.ndarray]:
    """[keys, column, ...] of one blob."""
    buf = memoryview(blob)
    n, k, first = np.frombuffer(buf, np.int64, 3)
    head = np.frombuffer(buf, np.int64, 4 + 2 * int(k))
    at, out = 8 * len(head), []
    for i in range(int(k) + 1):
        width = int(head[3 + 2 * i])
        x = _unplanes(buf[at:], int(n), width)
        at += int(n) * width
        out.append(np.cumsum(x) + np.array(first).view(np.uint64) if i == 0 else x.view(np.int64) + head[2 + 2 * i])
    return out


def split(keys: np.ndarray, columns: list[np.ndarray], bits: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, blob) for each of the 2**bits ranges of sorted keys that has entries."""
    if not len(keys):
        return
    if bits:
        bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(bucket)) + 1
    else:
        bucket, cuts = np.zeros(len(keys), np.int64), np.zeros(0, np.int64)
    for a, b in zip([0, *cuts], [*cuts, len(keys)]):
        yield int(bucket[a]), pack(keys[a:b], *(c[a:b] for c in columns))


def blob_rows(keys: np.ndarray, columns: list[np.ndarray], bits: int) -> pa.RecordBatch | None:
    rows = list(split(keys, columns, bits))
    if not rows:
        return None
    return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], schema=BLOB_SCHEMA)


def gather(blobs: Iterable[bytes]) -> list[np.ndarray]:
    """The entries of several blobs, one array per column (keys first), not sorted."""
    parts = [unpack(b) for b in blobs]
    return [np.concatenate(x) for x in zip(*parts)]


def by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Blobs of each bucket, from rows that are sorted by bucket within the partition."""
    now, blobs = None, []
    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            if bucket != now:
                if blobs:
                    yield now, blobs
                now, blobs = bucket, []
            blobs.append(blob.as_py())
    if blobs:
        yield now, blobs


def deal(blobs: DataFrame, partitions: int) -> DataFrame:
    """Blob rows of one bucket together and next to each other."""
    return blobs.repartition(partitions, F.col(BUCKET)).sortWithinPartitions(BUCKET)


def plan_partitions(docs: DataFrame, text: str, per_partition: int = 16 << 20) -> tuple[int, int]:
    """(partitions, bucket bits) for a shuffle whose volume follows the bytes of ``text``:
    one partition per ``per_partition`` bytes of text, at least the session's shuffle
    partitions, and at least eight buckets per partition, so that buckets spread evenly."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // per_partition), 1)
    return n, (8 * n - 1).bit_length()
