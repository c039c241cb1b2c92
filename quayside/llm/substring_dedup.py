"""Substring deduplication by Rabin-Karp window hashes.

Every window of ``window`` consecutive words gets a 64-bit rolling hash. The hashes are counted
in Spark, by hash range: a window is a *repeat* in a document if the same window also starts in
a document with a smaller id. Overlapping and adjacent repeats of a document merge into maximal
removal intervals.

Plan: (1) map tasks hash all windows of a run of documents and keep, per distinct hash, the
smallest id (a window that a third of all documents share leaves one entry per run, not one per
document); other documents of the run know at once that theirs is a repeat. (2) One shuffle by
hash range finds, for each run's smallest id, whether a smaller one exists. (3) Repeated hashes
go back to their documents by id (again as packed rows), and each document marks the words they cover.
Texts without repeats stay where they are.

Judged by hash: two different windows of one corpus collide with a chance of about n*n/2**65
for n windows. Defined results: a null text has no words; a row with a null id is returned
unchanged and takes no part (it has no place in the order of ids); rows that share an id are
judged separately against smaller ids; extra columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import exchange
from quayside.llm.words import mix, slices
from quayside.operators.broadcasts import measured_bytes
from quayside.session import scratch_path

RUN_WINDOWS = 200_000  # windows that a map task sorts at a time (some 20 MB)
RUN_REPEATS = 250_000  # repeats that a task of the way back sorts at a time
BROADCAST_BYTES = 16 << 20  # of the ids of documents with repeats (16 bytes each)
_FLAGS = "__repeat_hashes"


def _first_of_groups(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys with their smallest id, and the (key, id) entries beyond it,
    without repeats."""
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    start = np.flatnonzero(new)
    if not len(start):
        return keys, ids, keys, ids
    low = np.minimum.reduceat(ids, start)
    group = np.cumsum(new) - 1
    more = ids > low[group]
    if more.any():
        mk, mi = keys[more], ids[more]
        order = np.lexsort((mi, mk))
        mk, mi = mk[order], mi[order]
        keep = np.ones(len(mk), bool)
        keep[1:] = (mk[1:] != mk[:-1]) | (mi[1:] != mi[:-1])
        mk, mi = mk[keep], mi[keep]
    else:
        mk, mi = keys[:0], ids[:0]
    return keys[start], low, mk, mi


_SCHEMA = pa.schema([("bucket", pa.int32()), ("blob", pa.binary()), ("repeats", pa.bool_())])


def _rows(keys, ids, bits, repeats) -> Iterator[pa.RecordBatch]:
    rows = list(exchange.split(keys, [ids], bits))
    if rows:
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([repeats] * len(rows))], schema=_SCHEMA)


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """(id, hashes): packed uint64 hashes of windows of document ``id`` that also start in a
    document with a smaller id; one row per id that has any."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    parts, bits = exchange.plan_partitions(docs, "text")
    back = (2 * parts - 1).bit_length()  # buckets of the way back: fewer, for less data

    def hash_windows(batches):
        held, n = [], 0

        def flush():
            keys, ids, mk, mi = _first_of_groups(np.concatenate([h for h, _ in held]), np.concatenate([i for _, i in held]))
            yield from _rows(keys, ids, bits, False)
            yield from _rows(mk, mi, bits, True)

        for batch in batches:
            id_ = np.asarray(batch.column(0))
            for a, _, w in slices(batch.column(1)):
                h, doc, _ = w.windows(window)
                if len(h):
                    held.append((h, id_[a + doc]))
                    n += len(h)
                if n >= RUN_WINDOWS:
                    yield from flush()
                    held, n = [], 0
                    exchange.release_memory()
        if held:
            yield from flush()
        held = []
        exchange.release_memory()

    def compare(batches):
        out: list[tuple[np.ndarray, np.ndarray]] = []
        now, mins = None, []

        def close():
            if mins:
                keys, ids = exchange.gather(mins)
                _, _, mk, mi = _first_of_groups(keys, ids)
                out.append((mk, mi))

        def flush():
            keys, ids = (np.concatenate(x) for x in zip(*out))
            bucket = (mix(ids.view(np.uint64)) >> np.uint64(64 - back)).astype(np.int64)
            order = np.lexsort((ids, bucket))
            bucket, keys, ids = bucket[order], keys[order].view(np.int64), ids[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            rows = [(int(bucket[a]), exchange.pack(ids[a:b].view(np.uint64), keys[a:b])) for a, b in zip([0, *cuts], [*cuts, len(ids)]) if b > a]
            return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], schema=exchange.BLOB_SCHEMA)

        for batch in batches:
            for bucket, blob, repeats in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if bucket != now:
                    close()
                    now, mins = bucket, []
                    if sum(len(k) for k, _ in out) >= RUN_REPEATS:
                        yield flush()
                        out.clear()
                        exchange.release_memory()
                if repeats:
                    out.append(tuple(exchange.unpack(blob.as_py())))
                else:
                    mins.append(blob.as_py())
        close()
        mins = []
        if out:
            yield flush()
        out.clear()
        exchange.release_memory()

    def collect(batches):
        for _, blobs in exchange.by_bucket(batches):
            ids, keys = exchange.gather(blobs)
            order = np.argsort(ids, kind="stable")
            ids, keys = ids[order].view(np.int64), keys[order]
            cuts = np.flatnonzero(np.diff(ids)) + 1
            start = np.concatenate([[0], cuts]).astype(np.int64)
            yield pa.record_batch([pa.array(ids[start], pa.int64()), pa.array([x.tobytes() for x in np.split(keys, cuts)], pa.binary())], names=["id", "hashes"])
            del blobs, ids, keys, order, cuts, start
            exchange.release_memory()

    blobs = docs.mapInArrow(hash_windows, "bucket int, blob binary, repeats boolean")
    dealt = blobs.repartition(parts, F.col("bucket")).sortWithinPartitions("bucket")
    found = dealt.mapInArrow(compare, exchange.BLOB_DDL)
    return exchange.deal(found, parts).mapInArrow(collect, "id long, hashes binary")


def _marks(texts: pa.Array, flags: list, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word mask) of the rows that lose words: true for words covered by a repeat."""
    rows = [i for i, f in enumerate(flags) if f]
    if not rows:
        return
    for a, b, w in slices(texts.take(pa.array(rows))):
        h, doc, pos = w.windows(window)
        at = np.searchsorted(doc, np.arange(b - a + 1))
        for j in range(b - a):
            mine, where = h[at[j] : at[j + 1]], pos[at[j] : at[j + 1]]
            hit = where[np.isin(mine, np.frombuffer(flags[rows[a + j]], np.uint64))]
            cover = np.zeros(w.count[j] + 1, np.int64)
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + window, -1)
            mask = np.cumsum(cover)[:-1] > 0
            if mask.any():
                yield rows[a + j], mask


def _joined(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``docs`` with the packed hashes of their repeats (null: none). Where the ids that have any
    are few enough to broadcast, texts without repeats are not shuffled; else all are."""
    path = scratch_path(docs.sparkSession, "repeat_flags")
    repeated_windows(docs, id_col, text_col, window).write.parquet(path)
    exchange.settle(docs.sparkSession)
    flags = docs.sparkSession.read.schema("id long, hashes binary").parquet(path).toDF("__repeat_id", _FLAGS)
    same = docs[id_col].cast("long") == F.col("__repeat_id")
    ids = flags.select("__repeat_id")
    if measured_bytes(ids) > BROADCAST_BYTES:
        return docs.join(flags, same, "left").drop("__repeat_id")
    some = docs.join(F.broadcast(ids), same, "left_semi").join(flags, same).drop("__repeat_id")
    return some.union(docs.join(F.broadcast(ids), same, "left_anti").withColumn(_FLAGS, F.lit(None).cast("binary")))


def removal_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """(id, from_word, to_word): the maximal runs [from_word, to_word) of removed words."""

    def run(batches):
        for batch in batches:
            ids, out = batch.column(0), []
            for row, mask in _marks(batch.column(1), batch.column(2).to_pylist(), window):
                edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
                out += [(ids[row].as_py(), int(a), int(b)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
            cols = list(zip(*out)) or [[], [], []]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["id", "from_word", "to_word"])
        exchange.release_memory()

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return _joined(slim, "id", "text", window).mapInArrow(run, "id long, from_word long, to_word long")


def _kept(batch_text: pa.Array, flags: list, window: int) -> Iterator[tuple[list[bytes], np.ndarray | None]]:
    """Per row its words and, where it loses some, the mask of lost ones."""
    lost = dict(_marks(batch_text, flags, window))
    for i, t in enumerate(batch_text.to_pylist()):
        yield (t or "").encode().split(), lost.get(i)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """``docs`` with the removed words gone. A text that loses nothing stays as it is; of
    others the kept words are joined by one space."""
    joined = _joined(docs, id_col, text_col, window)
    names, at = joined.columns, joined.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for row, mask in _marks(batch.column(at), batch.column(len(names) - 1).to_pylist(), window):
                texts[row] = b" ".join(compress(texts[row].encode().split(), ~mask)).decode()
            cols = [pa.array(texts, batch.schema.field(at).type) if i == at else batch.column(i) for i in range(len(names) - 1)]
            yield pa.RecordBatch.from_arrays(cols, names=names[:-1])
            del batch, texts, cols
            exchange.release_memory()

    return joined.mapInArrow(run, docs.schema)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""

    def run(batches):
        for batch in batches:
            n, removed, sha = [], [], []
            for words, mask in _kept(batch.column(1), batch.column(2).to_pylist(), window):
                n.append(len(words))
                removed.append(0 if mask is None else int(mask.sum()))
                sha.append(hashlib.sha256(b" ".join(words if mask is None else compress(words, ~mask))).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])
        exchange.release_memory()

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _joined(slim, "doc_id", "text", window).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
