"""Benchmark decontamination by a prefix-filtered set join with item-sized windows.

Each benchmark item gives records: its windows of ``window`` consecutive words (an item of fewer
words is one record). A record is the set of its word shingles (``shingle`` words each, with
their place in the record). It is contained in a document if all its shingles occur there in an
item-sized window, in their places: its words, in sequence.

* Shingles are ordered by rarity, counted over all documents in a first pass. Full containment
  requires every shingle, so the necessary prefix of a record is its rarest shingle alone.
* The second pass joins the shingles of the documents with these prefixes. A match at a
  position fixes the record's place: the positional bound (enough words before it) and the
  length bound (enough words behind it) drop places that do not fit, a hash of the whole window
  drops nearly all others, and the words themselves are compared last.

Benchmarks are split into blocks of at most about ``BLOCK_BYTES`` of text by a hash of the item
id; one block at a time is sent to the tasks, so memory does not grow with the benchmark. The
documents are not shuffled; the second pass carries its hits from block to block.

Words are runs of letters and digits (ASCII) and other non-ASCII characters, A-Z lower-cased.
Defined results: null or empty texts have no words; items without words or with a null id give
no records; equal items all count; repeated and null document ids are judged row by row; extra
columns pass through ``remove_contaminated`` and are ignored by ``digest``.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import exchange
from quayside.llm.words import Words, separator_table, slices
from quayside.session import scratch_path

BLOCK_BYTES = 8 << 20
_SEPARATORS = separator_table([b for b in range(128) if not chr(b).isalnum()])
_U = np.uint64


class Block(NamedTuple):
    """Records of a part of the benchmark. ``sizes``: record lengths that occur."""

    words: np.ndarray  # words of each record
    hashes: np.ndarray  # hash of each record's whole window
    texts: list[bytes]  # its words, joined by one space
    items: list[np.ndarray]  # indexes into ids of the items that have it
    ids: list  # item ids
    shingles: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # words -> (hash, record, place)


def _lowered(w: Words, a: int, b: int) -> bytes:
    return b" ".join(w.text(i) for i in range(a, b)).lower()  # bytes.lower changes A-Z only


def build_block(items: list[tuple], window: int, shingle: int) -> Block:
    """Records and their shingles; equal windows are one record."""
    records: dict[bytes, list[int]] = {}
    sizes: dict[bytes, tuple[int, int]] = {}
    places = []
    for _, _, w in slices(pa.array([t for _, t in items], pa.string()), True, _SEPARATORS, 1 << 40):
        for doc in range(w.n_docs):
            a, b = int(w.first[doc]), int(w.first[doc + 1])
            n = min(window, b - a)
            for at in range(a, b - n + 1) if n else ():
                text = _lowered(w, at, at + n)
                if text not in records:
                    records[text] = []
                    sizes[text] = (n, at)
                if not records[text] or records[text][-1] != doc:
                    records[text].append(doc)
        texts = list(records)
        length = np.array([sizes[t][0] for t in texts], np.int64)
        start = np.array([sizes[t][1] for t in texts], np.int64)
        hashes = np.zeros(len(texts), _U)
        for n in np.unique(length):
            mine = length == n
            hashes[mine] = w.run_hash(start[mine], int(n))
        for n in np.unique(np.minimum(length, shingle)):
            mine = np.flatnonzero(np.minimum(length, shingle) == n)
            count = length[mine] - n + 1
            record = np.repeat(mine, count)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            places.append((int(n), w.run_hash(start[record] + place, int(n)), record, place))
        return Block(length, hashes, texts, [np.array(records[t]) for t in texts], [i for i, _ in items], {n: (h, r, p) for n, h, r, p in places})
    return Block(np.zeros(0, np.int64), np.zeros(0, _U), [], [], [], {})


class _Lookup:
    """Positions of a sorted hash array in which hashes of documents occur."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hashes & _U((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into h, index of the first equal hash) of the hashes that occur."""
        at = np.flatnonzero(self.maybe[(h & _U((1 << 20) - 1)).astype(np.int64)])
        i = np.minimum(np.searchsorted(self.hashes, h[at]), max(len(self.hashes) - 1, 0))
        same = self.hashes[i] == h[at] if len(self.hashes) else np.zeros(0, bool)
        return at[same], i[same]


def rarity(docs: DataFrame, text_col: str, block: Block) -> dict[int, np.ndarray]:
    """Occurrences in the documents of each distinct shingle of a block, by shingle length;
    aligned with np.unique of the block's hashes."""
    spark = docs.sparkSession
    keys = {n: np.unique(h) for n, (h, _, _) in block.shingles.items()}
    sent = spark.sparkContext.broadcast(keys)

    def run(batches):
        lookups = {n: _Lookup(k) for n, k in sent.value.items()}
        counts = {n: np.zeros(len(k), np.int64) for n, k in sent.value.items()}
        for batch in batches:
            for _, _, w in slices(batch.column(0), True, _SEPARATORS):
                for n, lookup in lookups.items():
                    _, i = lookup.find(w.windows(n)[0])
                    np.add.at(counts[n], i, 1)
        for n, c in counts.items():
            some = np.flatnonzero(c)
            yield pa.record_batch([pa.array(np.full(len(some), n), pa.int32()), pa.array(some, pa.int64()), pa.array(c[some], pa.int64())], names=["n", "i", "c"])

    found = docs.select(text_col).mapInArrow(run, "n int, i long, c long").groupBy("n", "i").agg(F.sum("c").alias("c"))
    out = {n: np.zeros(len(k), np.int64) for n, k in keys.items()}
    for n, i, c in found.collect():  # at most a row for each shingle of the block
        out[n][i] = c
    sent.unpersist()
    return out


def prefixes(block: Block, counts: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each record's rarest shingle, by shingle length: (sorted hash, record, place)."""
    out = {}
    for n, (h, record, place) in block.shingles.items():
        c = counts[n][np.searchsorted(np.unique(h), h)]
        order = np.lexsort((place, h, c, record))
        first = order[np.concatenate([[True], np.diff(record[order]) > 0])] if len(order) else order
        first = first[np.argsort(h[first], kind="stable")]
        out[n] = h[first], record[first], place[first]
    return out


_HITS = "__benchmark_hits"


def _match(docs: DataFrame, text_col: str, block: Block, chosen: dict, then, schema) -> DataFrame:
    """Adds to the hits of each row: one (first word, words, item id as text) per occurrence of
    a record of the block and item that has it. ``then`` makes the batches of ``schema`` of these in the
    same task: steps in a row would hold a Python worker each."""
    sent = docs.sparkSession.sparkContext.broadcast((block, chosen))
    at = docs.columns.index(text_col)
    hits_at = docs.columns.index(_HITS)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32()), ("item", pa.string())]))

    def hit(batches):
        block, chosen = sent.value
        lookups = {n: _Lookup(h) for n, (h, _, _) in chosen.items()}
        for batch in batches:
            found: dict[int, list] = {}
            for a, _, w in slices(batch.column(at), True, _SEPARATORS):
                for n, (h, record, place) in chosen.items():
                    hashes, doc, pos = w.windows(n)
                    where, i = lookups[n].find(hashes)
                    if not len(where):
                        continue
                    many = np.searchsorted(h, h[i], side="right") - i  # records with this prefix
                    k = np.repeat(i, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    d, p, r = doc[np.repeat(where, many)], pos[np.repeat(where, many)], record[k]
                    start = p - place[k]
                    fits = (start >= 0) & (start + block.words[r] <= w.count[d])  # position and length
                    d, start, r = d[fits], start[fits], r[fits]
                    for size in np.unique(block.words[r]):
                        mine = np.flatnonzero(block.words[r] == size)
                        same = w.run_hash(w.first[d[mine]] + start[mine], int(size)) == block.hashes[r[mine]]
                        for j in mine[same]:
                            x = int(w.first[d[j]] + start[j])
                            if _lowered(w, x, x + int(size)) == block.texts[r[j]]:
                                found.setdefault(a + int(d[j]), []).extend({"start": int(start[j]), "size": int(size), "item": str(block.ids[i])} for i in block.items[r[j]])
            cols = list(batch.columns)
            if found:
                old = cols[hits_at].to_pylist()
                cols[hits_at] = pa.array([(o or []) + found[i] if i in found else o for i, o in enumerate(old)], kind)
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)
        exchange.release_memory()

    return docs.mapInArrow(lambda batches: then(hit(batches)), schema)


def matched(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 13, shingle: int = 3, then=None, schema=None
) -> DataFrame:
    """``docs`` with a column of hits (null: none) as its last one, or what ``then`` makes of its batches."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-int(size) // BLOCK_BYTES))
    out = docs.withColumn(_HITS, F.lit(None).cast("array<struct<start:int,size:int,item:string>>"))
    whole, done = out.schema, False
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k).collect()  # about BLOCK_BYTES
        block = build_block(sorted(((r.i, r.t) for r in part), key=lambda x: str(x[0])), window, shingle)
        if not block.texts:
            continue
        done = then is not None and k + 1 == blocks
        out = _match(out, text_col, block, prefixes(block, rarity(docs, text_col, block)), then if done else iter, schema if done else whole)
        if k + 1 < blocks:  # one block's tasks at a time
            path = scratch_path(spark, "decontaminate")
            out.write.parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
    return out if done or then is None else out.mapInArrow(then, schema)


def _judge(texts: pa.Array, hits: list, rows: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(words, hit words) of the given rows."""
    n, hit = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    for a, b, w in slices(texts.take(pa.array(rows, pa.int64())), True, _SEPARATORS):
        n[a:b] = w.count
        for j in range(a, b):
            if hits[rows[j]]:
                mask = np.zeros(int(w.count[j - a]), bool)
                for h in hits[rows[j]]:
                    mask[h["start"] : h["start"] + h["size"]] = True
                hit[j] = mask.sum()
    return n, hit


def digest(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row;
    contaminated: hit words are at least one in ``share``."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))

    def run(batches):
        for batch in batches:
            hits = batch.column(2).to_pylist()
            n, hit = _judge(batch.column(1), hits, list(range(len(batch))))
            items = [sorted({x["item"] for x in h or ()}) for h in hits]
            sha = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
            cols = [batch.column(0), pa.array(n), pa.array(hit), pa.array([len(i) for i in items], pa.int64()), pa.array(sha), pa.array((hit > 0) & (share * hit >= n))]
            yield pa.record_batch(cols, names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return matched(slim, benchmark, window=window, then=run, schema="doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = 13, share: int = 20) -> DataFrame:
    """``docs`` without the contaminated rows."""
    at, last = docs.columns.index(text_col), len(docs.columns)

    def run(batches):
        for batch in batches:
            keep = np.ones(len(batch), bool)
            hits = batch.column(last).to_pylist()
            rows = [i for i, h in enumerate(hits) if h]
            if rows:
                n, hit = _judge(batch.column(at), hits, rows)
                keep[rows] = ~((hit > 0) & (share * hit >= n))
            yield pa.RecordBatch.from_arrays(batch.filter(pa.array(keep)).columns[:last], names=batch.schema.names[:last])

    return matched(docs, benchmark, text_col, window=window, then=run, schema=docs.schema)
