"""Token-id output: texts to ids with a tokenizers file, ids to block-coded binary files.

Documents are range-partitioned and sorted by id; each partition tokenizes its documents, ends
each with the end id, and writes one file in the block format of ``id_coder`` (context-mixing
range coder, blocks that reset and carry checksums), committed by renaming. A manifest with one
row per file, written last, holds the files' places in the order of all ids.

File: ``MAGIC``, coded blocks, the deflated document table (ids and lengths), and a footer with
the number of blocks, documents, null ids and ids, the table's place, size and CRC-32.

Ids of repeated words come from a bounded memo per Python worker where the tokenizer's
pre-tokenization provably cuts there (at blanks, and between letters and a final period or
comma); otherwise whole texts are encoded.

Defined results: a null or empty text has the end id only; rows with a null id come first; rows
that share an id are ordered by text; extra columns are ignored; an empty table gives an empty
manifest.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import exchange, filestore, id_coder

MAGIC = b"QIDS1\n"
_FOOT = "<QQQQQQI"  # blocks, documents, null ids, ids, table start, table bytes, table CRC
MEMO = 150_000  # words in each of the two generations of a worker's memo
_LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed value: the public tokenizer's pattern


class Tokens:
    """Ids of texts, as packed little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        marks = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers") or []]
        self.by_word = (
            steps[0].get("pattern") == {"Regex": _LETTER_RUNS} and steps[0].get("invert") is True and marks == ["NFC", "Replace", "Lowercase"]
            and not spec["model"].get("dropout") and not any(t["lstrip"] or t["rstrip"] or t["normalized"] or " " in t["content"] for t in spec["added_tokens"])
        )
        self.cut = re.compile(r"[^ \t\n\r]+").findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _keys(words: list[str]) -> list[str]:
        """The words whose ids, in a row, are the text's."""
        out = []
        for w in words:
            # some letters become a letter and a mark in lower case, and a mark runs on with the point
            if w[-1] in ".," and w[:-1].isalpha() and (w.isascii() or w[:-1].lower().isalpha()):
                out.append(w[:-1].lower() if w.isascii() else w[:-1])
                out.append(w[-1])
            else:
                out.append(w.lower() if w.isascii() and w.isalpha() else w)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.by_word:
            return self._ids([t or "" for t in texts])
        keys = [self._keys(self.cut(t)) if t else [] for t in texts]
        need = set().union(*keys) - self.young.keys()
        known = {k: self.old[k] for k in need & self.old.keys()}
        new = list(need - known.keys())
        known.update(zip(new, self._ids(new)))
        if len(self.young) + len(known) > MEMO:
            look = {**self.young, **known}
            self.old, self.young = self.young, {k: v for k, v in known.items() if len(k) <= 64}
        else:
            self.young.update(known)
            look = self.young
        out = [b"".join(map(look.__getitem__, k)) for k in keys]
        if look is self.young and any(len(k) > 64 for k in new):
            self.young = {k: v for k, v in self.young.items() if len(k) <= 64}
        return out


_loaded: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    """The tokenizer of this Python process, loaded once (the file is read on each machine)."""
    if path not in _loaded:
        _loaded[path] = Tokens(path)
    return _loaded[path]


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> list[dict]:
    """Writes the files and the manifest; returns the manifest: file, docs, ids, start."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    parts, _ = exchange.plan_partitions(slim, "text")

    def run(batches):
        name, coder = f"part-{TaskContext.get().partitionId():06d}.ids", None
        doc_ids, lengths, rest, blocks, place = [], [], [], 0, len(MAGIC)

        def put(final):
            nonlocal rest, blocks, place
            ids = np.frombuffer(b"".join(rest), "<u4")
            whole = len(ids) if final else len(ids) // id_coder.BLOCK * id_coder.BLOCK
            for b in id_coder.encode(ids[:whole]):
                out.write(b)
                blocks, place = blocks + 1, place + len(b)
            rest = [ids[whole:].tobytes()]

        batches = iter(batches)
        first = next((b for b in batches if len(b)), None)
        if first is None:
            return
        end, held = np.array([end_id], "<u4").tobytes(), 0
        with filestore.committed(folder, name) as out:
            out.write(MAGIC)
            batch = first
            while batch is not None:
                for at in range(0, len(batch), 250):
                    some = batch.slice(at, 250)
                    got = tokens(tokenizer).encode(some.column(1).to_pylist())
                    doc_ids += some.column(0).to_pylist()
                    lengths += [len(g) // 4 + 1 for g in got]
                    rest += [g + end for g in got]
                    held += sum(len(g) // 4 + 1 for g in got)
                    if held >= id_coder.BLOCK * id_coder.LANES:
                        put(False)
                        held = 0
                batch = next(batches, None)
            put(True)
            nulls = sum(i is None for i in doc_ids)
            table = zlib.compress(np.array(doc_ids[nulls:], "<i8").tobytes() + np.array(lengths, "<u8").tobytes(), 1)
            out.write(table + struct.pack(_FOOT, blocks, len(doc_ids), nulls, sum(lengths), place, len(table), zlib.crc32(table)) + MAGIC)
        exchange.release_memory()
        yield pa.record_batch([pa.array([name]), pa.array([len(doc_ids)], pa.int64()), pa.array([sum(lengths)], pa.int64())], names=["file", "docs", "ids"])

    placed = slim.repartitionByRange(parts, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    rows = sorted(tuple(r) for r in placed.mapInArrow(run, "file string, docs long, ids long").collect())  # a row per file
    out, start = [], 0
    for file, n, ids in rows:
        out.append({"file": file, "docs": n, "ids": ids, "start": start})
        start += ids
    filestore.write_manifest(folder, out)
    return out


def read_documents(f):
    """(null ids first, ids, lengths) of an open file, and (blocks, place of the first byte after them)."""
    size = struct.calcsize(_FOOT)
    tail = size + len(MAGIC)
    f.seek(f.size() - tail)
    foot = f.read(tail)
    if foot[size:] != MAGIC:
        raise ValueError("not a token file, or cut short")
    blocks, n, nulls, ids, place, size, crc = struct.unpack(_FOOT, foot[:size])
    f.seek(place)
    table = f.read(size)
    if zlib.crc32(table) != crc:
        raise ValueError("damaged document table")
    table = np.frombuffer(zlib.decompress(table), "<i8")
    return [None] * nulls + table[: n - nulls].tolist(), table[n - nulls :], blocks, place


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids): every document, from the files of the manifest; ``ids`` as
    packed little-endian unsigned 32-bit integers."""
    schema = "id long, start long, n_tokens long, ids binary"
    rows = [(m["file"], m["start"]) for m in filestore.manifest(folder)]
    if not rows:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame(rows, "file string, start long").repartition(len(rows))

    def documents(name, start):
        with filestore.opened(folder, name) as f:
            doc_ids, lengths, blocks, place = read_documents(f)
            at = start + np.concatenate([[0], np.cumsum(lengths)])
            f.seek(len(MAGIC))
            data, where, doc, rest, taken = f.read(place - len(MAGIC)), 0, 0, np.zeros(0, "<u4"), 0
            while where < len(data) or doc < len(doc_ids):
                some = []
                while where < len(data) and len(some) < id_coder.LANES:
                    n = id_coder.size(data, where)
                    some.append(data[where : where + n])
                    where += n
                rest = np.concatenate([rest, *[x.astype("<u4") for x in id_coder.decode(some)]])
                stop = int(np.searchsorted(at[1:], start + taken + len(rest), side="right"))
                for a in range(doc, stop, 2000):
                    b = min(a + 2000, stop)
                    ids = [rest[at[i] - start - taken : at[i + 1] - start - taken].tobytes() for i in range(a, b)]
                    yield pa.record_batch([pa.array(doc_ids[a:b], pa.int64()), pa.array(at[a:b]), pa.array(lengths[a:b]), pa.array(ids, pa.binary())], names=["id", "start", "n_tokens", "ids"])
                used = int(at[stop]) - start - taken
                rest, taken, doc = rest[used:], taken + used, stop
                if not some and doc < len(doc_ids):
                    raise ValueError("token file is shorter than its document table")

    def run(batches):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from documents(name, start)
        exchange.release_memory()

    return files.mapInArrow(run, schema)


def digest(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), from files written and read back."""
    spark = docs.sparkSession
    write(docs, folder, tokenizer, end_id)
    return read(spark, folder).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
