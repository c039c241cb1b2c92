"""Deterministic sharded WARC writer and reader.

Shards are ranges of page ids with about equal payload bytes, cut from an exact histogram of the
ids, so the same rows give the same files, however Spark partitions them. A shard's records are
sorted by id and written as one gzip member each; a file that reaches ``roll_bytes`` compressed
bytes is closed and the shard goes on in the next one. Headers, record ids and digests are made
anew from the rows. Files are committed by renaming, and a manifest, written last, lists them.

Records with equal payloads of at least ``revisit_bytes``: the one with the smallest id is a
response, the others are revisits that name it and store no payload. The digests travel, not the
payloads: only (digest, smallest id) of repeated payloads and (id, digest) rows are joined.

Defined results: a null or empty html is an empty payload; a null url is an empty target; rows
with a null id are responses, written after all others; of rows that share id and payload the
first (by url) is the response; extra columns are ignored; an empty table gives an empty manifest.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import filestore
from quayside.llm.exchange import release_memory

DATE = "2024-01-01T00:00:00Z"  # records carry one date: files must not depend on the clock
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard long, roll long, records long, bytes long, sha256 string"
ROWS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


# ---- records ---------------------------------------------------------------------------------


def record_id(page_id: int | None, digest: str, url: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id} {digest} {url}'.encode()).digest()[:16], version=5)}>"


def _member(head: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(block)))])
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + z.flush()


def _line(value: str) -> str:
    """A header value on one line: line ends percent-encoded, as in a URI."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if any(c in value for c in "\r\n") else value


def page_record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, level: int) -> bytes:
    """One record as a gzip member; ``refers_to``: the id of the response of a revisit."""
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest, url)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _line(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-ID", str(refers_to))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head.append(("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"))
    return _member(head, block, level)


def info_record(shard: int, roll: int, level: int) -> bytes:
    block = f"software: quayside\r\nformat: WARC File Format 1.1\r\nisPartOf: shard {shard}, file {roll}\r\n".encode()
    name = hashlib.sha256(f"info {shard} {roll}".encode()).digest()[:16]
    return _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.UUID(bytes=name, version=5)}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], block, level)


def records(f, chunk: int = 1 << 20):
    """(headers, block) of each gzip member of an open archive, one in memory at a time."""
    rest = b""
    while True:
        rest = rest or f.read(chunk)
        if not rest:
            return
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            parts.append(z.decompress(rest))
            rest = z.unused_data
            if not z.eof:
                rest = f.read(chunk)
                if not rest:
                    raise ValueError("archive ends inside a record")
        data = b"".join(parts)
        head, _, body = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        size = int(fields["Content-Length"])
        if version != "WARC/1.1" or body[size:] != b"\r\n\r\n":
            raise ValueError("malformed record")
        yield fields, body[:size]


def page_of(fields: dict, block: bytes) -> tuple:
    """(page_id, url, type, refers_to, payload bytes, digest, payload or None); checks digests."""
    if hashlib.sha256(block).hexdigest() != fields["WARC-Block-Digest"].removeprefix("sha256:"):
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} does not match")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.decode().rpartition("Content-Length: ")[2])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not match")
    number = lambda k: int(fields[k]) if k in fields else None
    url = fields["WARC-Target-URI"]
    if "%0D" in url or "%0A" in url:
        url = url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    return number("X-Page-ID"), url, kind, number("X-Refers-To-Page-ID"), size, digest, payload if kind == "response" else None


# ---- shards ----------------------------------------------------------------------------------


def shard_starts(sizes: DataFrame, target: int, fan: int = 4096) -> list[int]:
    """First ids of ranges of about ``target`` bytes, from rows (id, bytes). A histogram over
    ``fan`` equal id ranges is refined where a range alone exceeds the target; each round
    collects at most ``fan`` rows for each range that does."""
    low, high, total = sizes.agg(F.min("id"), F.max("id"), F.sum("bytes")).first()
    if low is None:
        return []

    def cells(a: int, b: int) -> list[tuple[int, int, int]]:
        """(first, last, bytes) of cells of [a, b], in order."""
        width = max(1, -(-(b - a + 1) // fan))
        cell = F.expr(f"cast((cast(id as decimal(20,0)) - {a}) div {width} as long)").alias("c")
        found = sizes.where(F.col("id").between(a, b)).groupBy(cell).agg(F.sum("bytes")).collect()
        out = []
        for c, n in sorted(found):
            x, y = a + c * width, min(b, a + (c + 1) * width - 1)
            out += cells(x, y) if n > 2 * target and x < y else [(x, y, n)]
        return out

    starts, held = [low], 0
    for a, _, n in cells(low, high) if total > target else []:
        if held and held + n > target:
            starts.append(a)
            held = 0
        held += n
    return starts


def shard_bytes(total: int) -> int:
    """Payload bytes of a shard: about 256 shards, of 8 MB at least and 1 GB at most."""
    return min(max(total // 256, 8 << 20), 1 << 30)


def write(pages: DataFrame, folder: str, revisit_bytes: int = 100, roll_bytes: int = 512 << 20, target: int | None = None, level: int = 5) -> list[dict]:
    """Writes the archives and their manifest; returns the manifest."""
    pages = pages.select(F.col("page_id").cast("long").alias("id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    sized = pages.select("id", F.octet_length("html").cast("long").alias("bytes"))
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    starts = np.array(shard_starts(sized.where("id is not null"), target or shard_bytes(total)), np.int64)

    digests = pages.where((F.octet_length("html") >= revisit_bytes) & F.col("id").isNotNull()).select("id", F.sha2("html", 256).alias("digest"))
    first = digests.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("digest", "first")
    revisits = digests.join(first, "digest").where("id <> first").distinct()

    @F.pandas_udf("long")
    def shard_of(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(starts, ids.fillna(0).to_numpy(np.int64), side="right") - 1
        return pd.Series(np.where(ids.isna(), len(starts), np.maximum(at, 0)))

    none = F.lit(None).cast("string")
    rows = pages.select("id", "url", "html", none.alias("digest"), F.lit(None).cast("long").alias("first"))
    rows = rows.unionAll(revisits.select("id", none.alias("url"), none.alias("html"), "digest", "first"))  # sorts before the id's pages
    parts = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(starts))
    placed = rows.withColumn("shard", shard_of("id")).repartition(parts, "shard").sortWithinPartitions("shard", F.col("id").asc_nulls_last(), F.col("html").isNotNull(), "url", "html")

    def run(batches):
        done, state = [], {"shard": None}

        def close():
            if state["shard"] is not None:
                state["file"].__exit__(None, None, None)
                done.append((state["name"], state["shard"], state["roll"], state["n"], state["size"], state["sha"].hexdigest()))
                state["shard"] = None

        def put(data):
            state["out"].write(data)
            state["size"] += len(data)
            state["sha"].update(data)

        def start(shard, roll):
            name = f"shard-{shard:07d}-{roll:04d}.warc.gz"
            file = filestore.committed(folder, name)
            state.update(shard=shard, roll=roll, name=name, file=file, out=file.__enter__(), n=0, size=0, sha=hashlib.sha256())
            put(info_record(shard, roll, level))

        now, known, seen = object(), {}, set()
        try:
            for batch in batches:
                for page_id, url, html, digest, first_, shard in zip(*(batch.column(i).to_pylist() for i in range(6))):
                    if page_id is None or page_id != now:
                        now, known, seen = page_id, {}, set()
                    if html is None:
                        known[digest] = first_
                        continue
                    if state["shard"] != shard:
                        close()
                        start(shard, 0)
                    elif state["size"] >= roll_bytes:
                        roll = state["roll"] + 1
                        close()
                        start(shard, roll)
                    payload = html.encode()
                    digest = hashlib.sha256(payload).hexdigest()
                    refers = known.get(digest)
                    if refers is None and page_id is not None and len(payload) >= revisit_bytes:
                        refers = page_id if digest in seen else None
                        seen.add(digest)
                    put(page_record(page_id, url, payload, digest, refers, level))
                    state["n"] += 1
            close()
        except BaseException:
            if state["shard"] is not None:  # drop the temporary file's handle without a name
                state["out"].close()
            raise
        release_memory()
        if done:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=["file", "shard", "roll", "records", "bytes", "sha256"])

    listed = [r.asDict() for r in placed.mapInArrow(run, MANIFEST).collect()]  # a row per file
    listed.sort(key=lambda m: (m["shard"], m["roll"]))
    filestore.write_manifest(folder, listed)
    return listed


def read(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The page records of the archives that the manifest lists, digests checked. With
    ``payloads``, a column ``html`` (null for revisits)."""
    schema = ROWS + (", html string" if payloads else "")
    names = [m["file"] for m in filestore.manifest(folder)]
    if not names:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame([(n,) for n in names], "file string").repartition(len(names))
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()][: 7 if payloads else 6]
    columns = [c.split()[0] for c in schema.split(", ")]

    def batch_of(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=columns)

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with filestore.opened(folder, name) as f:
                    for fields, block in records(f):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        *row, payload = page_of(fields, block)
                        rows.append((*row, None if payload is None else payload.decode()) if payloads else tuple(row))
                        held += 200 + (len(block) if payloads else 0)
                        if held > 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return files.mapInArrow(run, schema)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, html) with the payloads of revisits filled in from their responses."""
    pages = read(spark, folder, payloads=True)
    own = pages.where("record_type = 'response'").select("page_id", "url", "html")
    first = pages.where("record_type = 'response' and page_id is not null").select(F.col("page_id").alias("first"), F.col("payload_digest").alias("digest"), F.col("html").alias("body")).dropDuplicates(["first", "digest"])
    again = pages.where("record_type = 'revisit'").select("page_id", "url", "refers_to", "payload_digest")
    return own.unionAll(again.join(first, (F.col("refers_to") == F.col("first")) & (F.col("payload_digest") == F.col("digest"))).select("page_id", "url", F.col("body").alias("html")))


def digest(pages: DataFrame, folder: str, revisit_bytes: int = 100) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), from archives written
    and read back."""
    write(pages, folder, revisit_bytes)
    return read(pages.sparkSession, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
