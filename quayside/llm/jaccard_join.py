"""N-gram Jaccard self-join by universe partition and pigeonhole, and its components.

A document is the set of its distinct word shingles (hashed to 64 bits). Two documents link if
``den * intersection >= num * union``. Then their sets differ in at most
H = (r + s) * (den - num) / (den + num) shingles.

* Sizes fall into bands whose ends have the ratio den / num, so partners are in the same or the
  next band. The scheme of band k covers pairs (k, k) and (k, k + 1): every set takes part in
  the schemes of its own band and of the band below.
* A scheme hashes the universe of shingles into m segments. The signature of a segment is a
  hash of the set's shingles in it. Some segments also index their one-deletion neighbourhood
  (the signatures after leaving out each shingle). Two sets that share no signature differ by
  at least 1 in each segment that is not empty, and by at least 2 in those with a deletion
  neighbourhood. Summed up for one set this is its *cover*; if cover > H, no partner is missed.
* The allocation (m, segments with deletions) is chosen per band by a cost model: signatures
  emitted plus candidates expected at the band's measured number of sets.
* A set whose cover is not above H (segments that stay empty by chance) also takes part in a
  second level with more segments, and then in a last one where each shingle is a segment,
  which always covers. A pair needs the cover of one side only.
* Costly lists (signatures that more than ``HOT`` sets share, for instance those of one
  passage in many documents) are left out for a set whose cover stays above H without them;
  such lists then hold only sets that need them.

Candidates: each list first compares its most central member with the others. Components of the
links found are built, and a second round compares those pairs of a list that lie in different
components. So every pair that shares a needed signature is either compared or already
connected, and a large group of near copies costs a star, not all pairs. Pairs pass an exact
size bound and an exact parity-bitmap bound before their sets are fetched and intersected; where too
many of a list pass, its sets are intersected in blocks, and only links that connect components leave.

Equal sets are one class (a 128-bit sum hash and the size); only class representatives (the
smallest id) are compared. Defined results: a text of fewer words than ``shingle`` is one
shingle; without words (or null) the set is empty and links with nothing; rows that share an id
are judged one by one; a null id gets a null component and takes no part; extra columns are
ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import exchange
from quayside.llm.components import components
from quayside.llm.words import Words, mix, slices
from quayside.operators.broadcasts import small_side
from quayside.session import scratch_path

HOT = 32  # a list with more sets is left out where the cover allows it
RUN_PAIRS = 250_000  # pairs that a task makes distinct at a time
RUN_SIGNATURES = 200_000  # entries that a map task sorts at a time
MAX_BROADCAST_IDS = 500_000  # ids (8 bytes each) broadcast to fetch texts; beyond, a shuffle join
BROADCAST_GONE = 32 << 20  # bytes (16 an id) of ids of removed rows that are broadcast; beyond, texts are shuffled
_U = np.uint64
_LEVELS = 3


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the sorted distinct shingle hashes of each text of a slice, those of
    text i at first[i]:first[i+1]."""
    h, doc, _ = w.windows(k)
    short = np.flatnonzero((w.count > 0) & (w.count < k))
    if len(short):
        extra = np.empty(len(short), _U)
        for j, i in enumerate(short):
            x = w.hash[w.first[i] : w.first[i + 1]]
            for step, v in enumerate(x):  # at most k - 1 words
                extra[j] = mix(np.array([v], _U) + (extra[j] if step else _U(len(x))))[0]
        doc = np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        h, doc = np.concatenate([h, extra])[order], doc[order]
    cut = np.searchsorted(doc, np.arange(w.n_docs + 1))
    for a, b in zip(cut[:-1], cut[1:]):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[keep], doc[keep]
    return h, np.searchsorted(doc, np.arange(w.n_docs + 1))


def _set_sums(h: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    total = np.zeros(len(h) + 1, _U)
    np.cumsum(mix(h + _U(salt)), out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def parity_bits(h: np.ndarray) -> bytes:
    """Parity bitmap of a set: bit i tells whether an odd number of members hash to i. The
    bits in which two bitmaps differ are at most the members in which the sets differ. The
    size is the power of two at least twice the set's; folding gives smaller bitmaps."""
    n = 64
    while n < 2 * len(h):
        n *= 2
    return np.packbits(np.bincount((h >> _U(7)).astype(np.int64) % n, minlength=n) & 1).tobytes()


def _differ(a: bytes, b: bytes) -> int:
    x, y = (np.frombuffer(v, np.uint8) for v in sorted((a, b), key=len))
    if len(y) > len(x):  # bit i of the smaller one is the parity of bits i, i + n, ...
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


class Scheme(NamedTuple):
    low: int  # sizes of the scheme's band
    high: int
    segments: int
    deletions: int  # the first so many segments index one-deletion neighbourhoods


def most_different(r: int, s: int, num: int, den: int) -> int:
    return (r + s) * (den - num) // (den + num)


def bands(top: int, num: int, den: int) -> list[tuple[int, int]]:
    """Size bands up to ``top``; a partner of a set lies in the same or a neighbouring band."""
    out, low = [], 1
    while low <= top:
        out.append((low, low * den // num))
        low = out[-1][1] + 1
    return out


def _expected(size: float, m: int, d: int) -> tuple[float, float]:
    """(cover, signatures) expected for a set of ``size`` with d of m segments with deletions."""
    x = size / m
    none, one = math.exp(-x), x * math.exp(-x)
    return (m - d) * (1 - none) + d * (2 - 2 * none - one), m * (1 - none) + d * (x - one)


def allocate(low: int, high: int, sets: int, num: int, den: int, shared: float = 0.3, share_rate: float = 1e-5, compare_cost: float = 20.0) -> Scheme:
    """The cheapest allocation of a band whose expected cover is above H by two standard
    deviations for sets at both ends of the band, also if a passage with the fraction ``shared``
    of a set makes the lists of its segments costly. Cost of a set: its signatures, and
    ``compare_cost`` for each candidate expected among ``sets`` others, of which ``share_rate``
    have the fraction ``shared`` of their shingles in common. The model only steers cost."""
    best = None
    for m in sorted({max(1, round((most_different(high, high * den // num, num, den) + 1) * f) + extra) for f in (0.55, 0.65, 0.8, 0.95, 1.05, 1.12, 1.25, 1.5, 2) for extra in (0, 1, 2)}):
        for d in sorted({0, m // 4, m // 2, m}):
            cost, fits = 0.0, True
            for size in (low, high):
                cover, signatures = _expected(size, m, d)
                x = size / m
                costly = (m + d) * (math.exp(-x * (1 - shared)) - math.exp(-x))
                fits &= cover - costly - 2 * math.sqrt(m * math.exp(-x)) > most_different(size, size * den // num, num, den)
                chance = math.exp(-x * (1 - shared)) - math.exp(-x)  # an equal segment that is not empty
                cost += signatures + compare_cost * sets * share_rate * (m - d + d * (1 + x)) * chance
            if fits and (best is None or cost < best[0]):
                best = cost, m, d
    if best is None:  # tiny sets: the levels below cover what this one does not
        best = 0, most_different(high, high * den // num, num, den) + 2, 0
    return Scheme(low, high, best[1], best[2])


def signatures(h: np.ndarray, first: np.ndarray, schemes: list[Scheme], num: int, den: int):
    """Signatures of the sets of a slice. Yields per level (signature, set, scheme) and
    (set, scheme, slack): the cover left above H."""
    n = np.diff(first)
    highs = np.array([s.high for s in schemes])
    band = np.searchsorted(highs, n)
    who = np.concatenate([np.flatnonzero(n > 0), np.flatnonzero((n > 0) & (band > 0))])
    scheme = np.concatenate([band[n > 0], band[(n > 0) & (band > 0)] - 1])
    m_of, d_of = (np.array([s[i] for s in schemes]) for i in (2, 3))
    # the largest partner in the scheme: for the lower band any larger set, for the upper one the band below
    own = scheme == band[who]
    partner = np.where(own, n[who] * den // num, np.minimum(highs[scheme], n[who]))
    most = (n[who] + partner) * (den - num) // (den + num)
    for level in range(_LEVELS):
        if not len(who):
            return
        size = n[who]
        last = level == _LEVELS - 1
        m = size if last else m_of[scheme] * (1 + level)
        at = np.concatenate([[0], np.cumsum(size)])
        row = np.repeat(np.arange(len(who)), size)
        x = h[np.arange(at[-1]) - at[row] + first[who][row]]
        tag = mix((scheme * _LEVELS + level + 1).astype(_U) * _U(0x9E3779B97F4A7C15))
        value = mix(x + _U(0x51ED270B))
        if last:  # each shingle a segment of its own
            yield mix(value + tag[row]), who[row], scheme[row] * _LEVELS + level, (who, scheme * _LEVELS + level, size - most - 1)
            return
        base = np.concatenate([[0], np.cumsum(m)])
        place = mix(x ^ tag[row]) % m[row].astype(_U)
        seg = place.astype(np.int64) + base[row]
        total = np.zeros(base[-1], _U)
        np.add.at(total, seg, value)
        count = np.bincount(seg, minlength=base[-1])
        seg_row = np.repeat(np.arange(len(who)), m)
        seg_at = np.arange(base[-1]) - base[seg_row]
        deletes = seg_at < d_of[scheme][seg_row]
        cover = np.add.reduceat(np.minimum(count, np.where(deletes, 2, 1)), base[:-1])
        salt = mix(tag[seg_row] + seg_at.astype(_U) * _U(0xD1342543DE82EF95))
        full = np.flatnonzero(count)
        out, rows = [mix(total[full] + salt[full])], [seg_row[full]]
        drop = np.flatnonzero(deletes[seg] & (count[seg] > 1))
        if len(drop):
            out.append(mix(total[seg[drop]] - value[drop] + salt[seg[drop]]))
            rows.append(row[drop])
        rows = np.concatenate(rows)
        slack = cover - most - 1
        yield np.concatenate(out), who[rows], scheme[rows] * _LEVELS + level, (who, scheme * _LEVELS + level, slack)
        who, scheme, most = who[slack < 0], scheme[slack < 0], most[slack < 0]


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def set_table(docs: DataFrame, shingle: int, lower: bool) -> DataFrame:
    """(id, n, key, key2, bits) of documents (id, text): size, hash and parity bitmap of each set."""

    def run(batches):
        for batch in batches:
            for a, b, w in slices(batch.column(1), lower):
                h, first = shingle_sets(w, shingle)
                key, key2 = (_set_sums(h, first, s).view(np.int64) for s in (0x1234567, 0x7654321))
                bits = [parity_bits(h[x:y]) for x, y in zip(first[:-1], first[1:])]
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(np.diff(first), pa.int64()), pa.array(key), pa.array(key2), pa.array(bits, pa.binary())], names=["id", "n", "key", "key2", "bits"])
        exchange.release_memory()

    return docs.mapInArrow(run, "id long, n long, key long, key2 long, bits binary")


_FOUND = "kind int, a long, b long, scheme int, members array<long>"
_PAIR, _LIST, _HOT_LIST, _SLACK = range(4)
_ROWS = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("scheme", pa.int32()), ("members", pa.list_(pa.int64()))])


def _lists(docs: DataFrame, shingle: int, lower: bool, schemes: list[Scheme], num: int, den: int) -> DataFrame:
    """Signature lists with at least two classes (classes by key), and slacks."""
    parts, bits = exchange.plan_partitions(docs, "text")

    def emit(batches):
        held, slack, n = [], [], 0

        def rows(buckets, blobs, keys, schemes_, slacks):
            return pa.record_batch([pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary()), pa.array(keys, pa.int64()), pa.array(schemes_, pa.int32()), pa.array(slacks, pa.int64())], names=["bucket", "blob", "key", "scheme", "slack"])

        def flush():
            sig, key, scheme = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(sig)
            sig, key, scheme = sig[order], key[order], scheme[order]
            keep = np.ones(len(sig), bool)
            keep[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])  # copies of one run count once
            out = list(exchange.split(sig[keep], [key[keep], scheme[keep]], bits))
            yield rows([o[0] for o in out], [o[1] for o in out], [None] * len(out), [None] * len(out), [None] * len(out))
            key, scheme, left = (np.concatenate(x) for x in zip(*slack))
            bucket = (mix(key.view(_U)) >> _U(64 - bits)).astype(np.int32) if bits else np.zeros(len(key), np.int32)
            yield rows(bucket, [None] * len(key), key, scheme, left)

        for batch in batches:
            for _, _, w in slices(batch.column(1), lower):
                h, first = shingle_sets(w, shingle)
                key = _set_sums(h, first, 0x1234567).view(np.int64)
                _, one = np.unique(key, return_index=True)  # one of each class of the slice
                one.sort()
                size = np.diff(first)[one]
                pick = np.repeat(first[one] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                h, key, first = h[pick], key[one], np.concatenate([[0], np.cumsum(size)])
                for sig, who, scheme, (sw, ss, left) in signatures(h, first, schemes, num, den):
                    held.append((sig, key[who], scheme))
                    slack.append((key[sw], ss, left))
                    n += len(sig)
                    if n >= RUN_SIGNATURES:
                        yield from flush()
                        held, slack, n = [], [], 0
                        exchange.release_memory()
        if held:
            yield from flush()
        held, slack = [], []
        exchange.release_memory()

    def match(batches):
        pairs, now, blobs = [], None, []

        def close():
            if not blobs:
                return
            sig, key, scheme = exchange.gather(blobs)
            order = np.lexsort((key, sig))
            sig, key, scheme = sig[order], key[order], scheme[order]
            keep = np.ones(len(sig), bool)
            keep[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
            sig, key, scheme = sig[keep], key[keep], scheme[keep]
            start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            size = np.diff(np.concatenate([start, [len(sig)]]))
            two = start[size == 2]
            pairs.append((key[two], key[two + 1]))
            lists = [(int(s), key[a : a + s]) for a, s in zip(start[size > 2], size[size > 2])]
            if lists:
                yield pa.record_batch(
                    [pa.array([_HOT_LIST if s > HOT else _LIST for s, _ in lists], pa.int32()), pa.nulls(len(lists), pa.int64()), pa.nulls(len(lists), pa.int64()), pa.array(scheme[start[size > 2]], pa.int32()), pa.array([x for _, x in lists], pa.list_(pa.int64()))],
                    schema=_ROWS,
                )

        for batch in batches:
            left = batch.filter(batch.column(1).is_null())
            if len(left):
                yield pa.record_batch([pa.array([_SLACK] * len(left), pa.int32()), left.column(2), left.column(4), left.column(3), pa.nulls(len(left), pa.list_(pa.int64()))], schema=_ROWS)
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != now:
                    yield from close()
                    now, blobs = bucket, []
                if blob.is_valid:
                    blobs.append(blob.as_py())
        yield from close()
        blobs = []
        exchange.release_memory()
        if pairs:
            a, b = (np.concatenate(x) for x in zip(*pairs))
            if len(a):
                ab = np.unique(np.stack([a, b], 1), axis=0)
                yield pa.record_batch([pa.array([_PAIR] * len(ab), pa.int32()), pa.array(ab[:, 0]), pa.array(ab[:, 1]), pa.nulls(len(ab), pa.int32()), pa.nulls(len(ab), pa.list_(pa.int64()))], schema=_ROWS)

    blobs = docs.mapInArrow(emit, "bucket int, blob binary, key long, scheme int, slack long")
    return blobs.repartition(parts, F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(match, _FOUND)


def _needed_lists(found: DataFrame, deletions: list[int]) -> DataFrame:
    """(list, key): the lists to compare; costly ones without the sets that are covered
    without them."""
    lists = found.where(F.col("kind").isin(_LIST, _HOT_LIST)).withColumn("list", F.xxhash64("members"))
    cold = lists.where(F.col("kind") == _LIST).select("list", F.explode("members").alias("key")).distinct()
    hot = lists.where(F.col("kind") == _HOT_LIST).select("list", "scheme", F.explode("members").alias("key"))
    # a costly list in a segment with deletions takes up to 2 of the cover, else 1
    twice = F.col("scheme").isin([k * _LEVELS + level for k, d in enumerate(deletions) if d for level in range(_LEVELS)])
    loss = hot.groupBy("key", "scheme").agg(F.sum(F.when(twice, 2).otherwise(1)).alias("loss"))
    slack = found.where(F.col("kind") == _SLACK).groupBy(F.col("a").alias("key"), "scheme").agg(F.min("b").alias("slack"))
    tight = loss.join(slack, ["key", "scheme"]).where("loss > slack").select("key", "scheme")
    return cold.union(hot.join(tight, ["key", "scheme"]).select("list", "key").distinct())


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, lower: bool, num: int, den: int) -> DataFrame:
    """(a, b, x, y): of pairs (a, b) of class keys those that link; x, y: their ids."""
    spark = docs.sparkSession
    side = lambda k, i: classes.select(F.col("key").alias(k), F.col("id").alias(i), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}"))
    sized = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").where("x <> y")
    sized = sized.where(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)

    def bounded(batches):
        for batch in batches:
            na, nb, ba, bb = (batch.column(i).to_pylist() for i in range(4, 8))
            keep = [_differ(p, q) <= most_different(r, s, num, den) for r, s, p, q in zip(na, nb, ba, bb)]
            yield pa.RecordBatch.from_arrays(batch.filter(pa.array(keep, pa.bool_())).columns[:4], names=["a", "b", "x", "y"])
        exchange.release_memory()

    close = sized.select("a", "b", "x", "y", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(bounded, "a long, b long, x long, y long")
    path = scratch_path(spark, "jaccard_close")
    close.write.parquet(path)
    close = spark.read.parquet(path)
    ids = close.select(F.col("x").alias("id")).union(close.select("y")).distinct()
    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)

    def sets(batches):
        for batch in batches:
            for a, b, w in slices(batch.column(1), lower):
                h, first = shingle_sets(w, shingle)
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array([h[x:y].tobytes() for x, y in zip(first[:-1], first[1:])], pa.binary())], names=["id", "shingles"])
        exchange.release_memory()

    # rows that share an id give several sets; any of them may link
    table = docs.join(ids, "id", "left_semi").mapInArrow(sets, "id long, shingles binary").distinct()

    def exact(batches):
        for batch in batches:
            keep = []
            for p, q in zip(batch.column(4), batch.column(5)):
                p, q = np.frombuffer(p.as_buffer(), _U), np.frombuffer(q.as_buffer(), _U)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(bool(both) and den * both >= num * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays(batch.filter(pa.array(keep, pa.bool_())).columns[:4], names=["a", "b", "x", "y"])
        exchange.release_memory()

    full = close.join(table.select(F.col("id").alias("x"), F.col("shingles").alias("p")), "x").join(table.select(F.col("id").alias("y"), F.col("shingles").alias("q")), "y")
    path = scratch_path(spark, "jaccard_links")
    full.select("a", "b", "x", "y", "p", "q").mapInArrow(exact, "a long, b long, x long, y long").distinct().write.parquet(path)
    return spark.read.parquet(path)


def _folded(bits: bytes, size: int) -> np.ndarray:
    """A parity bitmap folded to ``size`` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint8).reshape(-1, size), axis=0)


class _Sketches:
    """Folded parity bitmaps of a list's sets, compared at the shorter size of two."""

    def __init__(self, bits: list[bytes]):
        self.size = np.array([len(b) for b in bits])
        self.rows = {}
        for size in sorted(set(self.size.tolist())):
            rows = np.zeros((len(bits), size), np.uint8)
            for i in np.flatnonzero(self.size >= size):
                rows[i] = _folded(bits[i], size)
            self.rows[size] = rows.view(_U)

    def differ(self, i: int, j: np.ndarray) -> np.ndarray:
        """Bits in which the bitmap of set i differs from those of the sets j."""
        out, common = np.zeros(len(j), np.int64), np.minimum(self.size[j], self.size[i])
        for size in np.unique(common).tolist():
            at, rows = common == size, self.rows[size]
            out[at] = np.bitwise_count(rows[j[at]] ^ rows[i]).sum(axis=1)
        return out


_BLOCK = 512  # members of a list that a task compares at a time
_BLOCK_BYTES = 4 << 20  # and of their shingles, where these meet
_COLUMNS = 2048  # shingles that are counted at a time
DENSE = 8  # pairs for each member of a list that are verified one by one; lists with more are dense
_MEMBER = "struct<component:long,set:binary>"


def _members(classes: DataFrame) -> DataFrame:
    """(key, set): each class as it travels with every list that it is in: key, size and its bitmap
    folded to the power of two at least 3/4 of its size in bits. Half of these bits differ between
    sets that have little in common, which is above the bound; pairs that pass meet the whole bitmaps later."""

    def run(batches):
        for batch in batches:
            out = []
            for key, n, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                size = len(bits)
                while size > 8 and 4 * size >= 0.75 * n:  # half of it has 4 * size bits
                    size //= 2
                out.append(np.array([key, n], "<i8").tobytes() + _folded(bits, size).tobytes())
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], names=["key", "set"])
        exchange.release_memory()

    return classes.select("key", "n", "bits").mapInArrow(run, "key long, set binary")


def _stars(lists: DataFrame) -> DataFrame:
    """(a, b): each list's most central member with the others. The original of a group of near
    copies shares more signatures with the copies than they do with one another, so the member
    whose lists hold the most other sets is compared first."""
    size = lists.groupBy("list").agg((F.count(F.lit(1)) - 1).alias("others"))
    central = lists.join(size, "list").groupBy("key").agg(F.sum("others").alias("others"))
    pivot = lists.join(central, "key").groupBy("list").agg(F.max(F.struct("others", "key")).alias("p")).select("list", F.col("p.key").alias("a"))
    return lists.join(pivot, "list").where("key <> a").select(F.least("a", "key").alias("a"), F.greatest("a", "key").alias("b")).distinct()


def _in_blocks(members: DataFrame, by: str, blocks: DataFrame) -> DataFrame:
    """Rows (by, blocks, p, q) of ``members`` (by, component, key, set), whose groups are dealt to
    ``blocks`` (by, blocks): each block of members with null, and each pair of blocks."""
    dealt = members.join(blocks, by).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    held = dealt.groupBy(by, "block", "blocks").agg(F.collect_list(F.struct("component", "set")).alias("members"))
    one = held.select(by, "blocks", F.col("members").alias("p"), F.lit(None).cast(f"array<{_MEMBER}>").alias("q"))
    long = held.where("blocks > 1")
    ahead = F.explode(F.expr("sequence(block + 1, blocks - 1)")).alias("other")
    left = long.where("block + 1 < blocks").select(by, "blocks", ahead, F.col("members").alias("p"))
    two = left.join(long.select(by, F.col("block").alias("other"), F.col("members").alias("q")), [by, "other"])
    return one.union(two.select(by, "blocks", "p", "q"))


def _placed(lists: DataFrame, where: DataFrame) -> DataFrame:
    """(list, key, component) of ``lists``. ``where``: (key, component) of linked classes."""
    return lists.join(where, "key", "left").select("list", "key", F.coalesce("component", "key").alias("component"))


def _open_lists(lists: DataFrame, where: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(list, key, component) of ``lists`` and (list, size) of those that hold several components."""
    at = _placed(lists, where)
    sizes = at.groupBy("list").agg(F.min("component").alias("c"), F.max("component").alias("d"), F.count(F.lit(1)).alias("size")).where("c <> d and size > 2")
    return at, sizes.select("list", "size")


def _across(lists: DataFrame, where: DataFrame, classes: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(a, b): pairs of a list in different components that pass the size and bitmap bounds, and
    (list): the *dense* lists, where more pairs pass than ``DENSE`` for each member. Of these not all
    pairs are named here; ``_dense_links`` compares them. Long lists are compared in blocks of members, so
    no task holds a list; pairs that pass travel packed, since many lists find the same ones."""
    at, sizes = _open_lists(lists, where)
    members = at.join(_members(classes), "key")
    rows = _in_blocks(members, "list", sizes.select("list", F.ceil(F.col("size") / _BLOCK).cast("int").alias("blocks")))

    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = (2 * parts - 1).bit_length()

    def compare(batches):
        held, dense, n = [], [], 0

        def flush():
            ab = np.unique(np.concatenate(held), axis=0)  # lists of one group of copies share their pairs
            at = mix(ab[:, 0].view(_U) ^ mix(ab[:, 1].view(_U)))
            order = np.argsort(at)
            return with_list(*exchange.blob_rows(at[order], [ab[order, 0], ab[order, 1]], bits).columns)

        def with_list(bucket, blob, found=None):
            return pa.record_batch([bucket, blob, found or pa.nulls(len(bucket), pa.int64())], names=["bucket", "blob", "list"])

        for some in (b.slice(at, 32) for b in batches for at in range(0, len(b), 32)):
            for found, blocks, p, q in zip(*(some.column(k).to_pylist() for k in range(4))):
                both = p + (q or [])
                component = np.array([m["component"] for m in both], np.int64)
                key, size = np.frombuffer(b"".join(m["set"][:16] for m in both), "<i8").reshape(-1, 2).T
                sketches = _Sketches([m["set"][16:] for m in both])
                begin = len(p) if q else 0
                mine, most = [], DENSE * len(both) // blocks  # over all rows of a list in proportion to its size
                for i in range(len(p)):
                    j = np.arange(max(i + 1, begin), len(both))
                    j = j[(component[j] != component[i]) & (np.minimum(size[j], size[i]) * den >= np.maximum(size[j], size[i]) * num)]
                    j = j[sketches.differ(i, j) <= (size[j] + size[i]) * (den - num) // (den + num)]
                    if len(j):
                        mine.append(np.stack([np.minimum(key[i], key[j]), np.maximum(key[i], key[j])], 1))
                        most -= len(j)
                        if most < 0:
                            dense.append(found)
                            break
                else:
                    held += mine
                    n += sum(map(len, mine))
                if n > RUN_PAIRS:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()
        held = []
        if dense:
            lists_ = pa.array(sorted(set(dense)), pa.int64())
            yield with_list(pa.nulls(len(lists_), pa.int32()), pa.nulls(len(lists_), pa.binary()), lists_)
        exchange.release_memory()

    def distinct(batches):
        for _, blobs in exchange.by_bucket(batches):
            _, a, b = exchange.gather(blobs)
            ab = np.unique(np.stack([a, b], 1), axis=0)
            yield pa.record_batch([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])

    spark, schema = lists.sparkSession, f"{exchange.BLOB_DDL}, list long"
    path = scratch_path(spark, "jaccard_across")
    rows.mapInArrow(compare, schema).write.parquet(path)
    found = spark.read.schema(schema).parquet(path)
    blobs = found.where("list is null").select(*exchange.BLOB_SCHEMA.names)
    return exchange.deal(blobs, parts).mapInArrow(distinct, "a long, b long"), found.where("list is not null").select("list").distinct()


def _shared(sets: list[np.ndarray], begin: int, end: int) -> np.ndarray:
    """Sizes of the intersections of the sets before ``end`` with those from ``begin`` on."""
    who = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = times[column] > 1  # others are in no intersection
    who, column = who[keep], (np.cumsum(times > 1) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    out = np.zeros((end, len(sets) - begin), np.float32)  # exact below 2**24
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, (low, low + _COLUMNS))
        has = np.zeros((len(sets), _COLUMNS), np.float32)
        has[who[a:b], column[a:b] - low] = 1
        out += has[:end] @ has[begin:].T
    return out


def _spanning(link: np.ndarray, component: np.ndarray, begin: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect what ``link`` (i, j - begin) and equal components do."""
    label, out = np.unique(component, return_inverse=True)[1], []
    for i in range(len(link)):
        j = begin + np.flatnonzero(link[i])
        j = j[label[j] != label[i]]
        if len(j):
            merged, first = np.unique(label[j], return_index=True)
            out += [(i, int(x)) for x in j[first]]
            label[np.isin(label, merged)] = label[i]
    return out


def _dense_links(dense: DataFrame, lists: DataFrame, where: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, lower: bool, num: int, den: int) -> DataFrame:
    """(a, b, x, y): of the lists ``dense`` links that connect the components which their links connect.
    Near copies that do not quite link pass the bitmaps in numbers that grow with the square of their
    group, so the sets themselves meet here and only links leave: at most one for each member of a block
    pair. Lists with members in common hold much the same pairs; they are compared at once as one
    group, unless the group (of lists in a chain) has more pairs than its lists."""
    spark = docs.sparkSession
    # dense lists are open, so that they need not be sized and joined once more to tell: their members
    # (as many as signatures that their sets share) are picked once and read from here on
    at = _placed(lists.join(dense, "list", "left_semi"), where)
    path = scratch_path(spark, "jaccard_dense")
    at.write.parquet(path)
    at = spark.read.parquet(path)
    least = at.groupBy("list").agg(F.min("key").alias("b"), F.count(F.lit(1)).alias("size"))
    chain = components(at.join(least.select("list", "b"), "list").select(F.col("key").alias("a"), "b"))
    path = scratch_path(spark, "jaccard_chains")
    chain.write.parquet(path)
    chain = spark.read.parquet(path).toDF("key", "chain")
    of = least.join(chain, least["b"] == chain["key"]).select("list", "chain", "size")
    apart = of.groupBy("chain").agg(F.sum(F.col("size").cast("double") * F.col("size")).alias("pairs")).join(chain.groupBy("chain").agg(F.count(F.lit(1)).cast("double").alias("n")), "chain").where("n * n > pairs").select("chain")
    whole = at.select("key", "component").distinct().join(chain, "key").join(apart, "chain", "left_anti").select(F.col("chain").alias("group"), F.lit(False).alias("list"), "component", "key")
    alone = at.join(of.join(apart, "chain").select("list"), "list", "left_semi").select(F.col("list").alias("group"), F.lit(True).alias("list"), "component", "key")
    members = whole.union(alone).withColumn("group", F.xxhash64("group", "list")).drop("list").join(classes.select("key", "n"), "key")
    blocks = members.groupBy("group").agg(F.ceil(F.greatest(F.count(F.lit(1)) / _BLOCK, F.sum("n") * 8 / _BLOCK_BYTES)).cast("int").alias("blocks"))

    def sets(batches):
        for batch in batches:
            for _, _, w in slices(batch.column(0), lower):
                h, first = shingle_sets(w, shingle)
                key = _set_sums(h, first, 0x1234567).view(np.int64)
                yield pa.record_batch([pa.array(key), pa.array([k.tobytes() + h[x:y].tobytes() for k, x, y in zip(key, first[:-1], first[1:])], pa.binary())], names=["key", "set"])
        exchange.release_memory()

    wanted = classes.join(at.select("key").distinct(), "key", "left_semi").select("id").distinct()
    if wanted.count() <= MAX_BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    table = docs.join(wanted, "id", "left_semi").select("text").mapInArrow(sets, "key long, set binary").groupBy("key").agg(F.first("set").alias("set"))
    rows = _in_blocks(members.select("group", "component", "key").join(table, "key"), "group", blocks)

    def compare(batches):
        for p, q in ((p, q) for b in batches for at in range(len(b)) for p, q in zip(*(b.slice(at, 1).column(k).to_pylist() for k in (2, 3)))):
            both = p + (q or [])
            component = np.array([m["component"] for m in both], np.int64)
            key = [int(np.frombuffer(m["set"][:8], "<i8")[0]) for m in both]
            if (component == component[0]).all():
                continue
            hashes = [np.frombuffer(m["set"], _U, offset=8) for m in both]
            begin = len(p) if q else 0
            size = np.array([len(h) for h in hashes], np.int64)
            same = _shared(hashes, begin, len(p)).astype(np.int64)
            link = (same > 0) & (den * same >= num * (size[: len(p), None] + size[None, begin:] - same))
            ab = [sorted((key[i], key[j])) for i, j in _spanning(link, component, begin)]
            if ab:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*ab)], names=["a", "b"])
        exchange.release_memory()

    found = rows.mapInArrow(compare, "a long, b long").distinct()
    side = lambda k, i: classes.select(F.col("key").alias(k), F.col("id").alias(i))
    path = scratch_path(spark, "jaccard_links")
    found.join(side("a", "x"), "a").join(side("b", "y"), "b").where("x <> y").select("a", "b", "x", "y").write.parquet(path)
    return spark.read.parquet(path)


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 75, den: int = 100, lower: bool = True) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``: the smallest id reachable by links."""
    return _components_of_sets(docs, id_col, text_col, shingle, num, den, lower).select("id", "n_shingles", "component_id")


def _components_of_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int, num: int, den: int, lower: bool) -> DataFrame:
    """``similar_components`` with the set's hashes (key, key2) and its component's own: the set that
    stands for it, that of the smallest id (of several sets of this id, the one with the least hashes)."""
    spark = docs.sparkSession
    docs = _slim(docs, id_col, text_col)
    path = scratch_path(spark, "jaccard_sets")
    set_table(docs, shingle, lower).write.parquet(path)
    sets = spark.read.parquet(path)
    real = sets.where("id is not null and n > 0")
    classes = real.groupBy("n", "key", "key2").agg(F.min("id").alias("id"), F.min("bits").alias("bits"))
    path = scratch_path(spark, "jaccard_classes")
    classes.write.parquet(path)
    classes = spark.read.parquet(path)

    top = classes.agg(F.max("n")).first()[0]
    if not top:
        return sets.select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), "key", "key2", F.lit(None).cast("boolean").alias("stands"))
    ends = bands(top, num, den)
    band = F.lit(len(ends) - 1)
    for k in reversed(range(len(ends) - 1)):
        band = F.when(F.col("n") <= ends[k][1], k).otherwise(band)
    counts = dict(classes.groupBy(band.alias("k")).count().collect())  # a row per size band
    schemes = [allocate(a, b, counts.get(k, 0) + counts.get(k + 1, 0), num, den) for k, (a, b) in enumerate(ends)]

    path = scratch_path(spark, "jaccard_lists")
    named = docs.where("id is not null")
    _lists(named, shingle, lower, schemes, num, den).write.parquet(path)
    exchange.settle(spark)
    found = spark.read.schema(_FOUND).parquet(path)
    lists = _needed_lists(found, [s.deletions for s in schemes])
    path = scratch_path(spark, "jaccard_needed")
    lists.write.parquet(path)
    lists = spark.read.parquet(path)

    star = found.where(F.col("kind") == _PAIR).select("a", "b").union(_stars(lists)).distinct()
    args = (classes, named, shingle, lower, num, den)
    links = _verified(star, *args)
    exchange.settle(spark)
    first = components(links.select("a", "b")).withColumnsRenamed({"id": "key"})
    pairs, dense = _across(lists, first, classes, num, den)
    more = _verified(pairs, *args)
    if not dense.isEmpty():
        more = more.union(_dense_links(dense, lists, first, *args))

    reach = components(links.union(more).select(F.col("x").alias("a"), F.col("y").alias("b")))
    classes = classes.join(reach, "id", "left").select("id", "n", "key", "key2", F.coalesce("component", "id").alias("component_id"))
    # the class that stands for its component has the component's id; of several that share this id
    # (a repeated id) those stand that do not link, and of linked ones that of the least key
    path = scratch_path(spark, "jaccard_components")
    classes.write.parquet(path)
    classes = spark.read.parquet(path)
    shared = classes.where("id = component_id").groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("id")
    stands = F.col("id") == F.col("component_id")
    if not shared.isEmpty():
        groups = components(links.union(more).select("a", "b")).withColumnsRenamed({"id": "key", "component": "group"})
        some = classes.where("id = component_id").join(shared, "id").join(groups, "key", "left")
        least = some.groupBy("id", F.coalesce("group", "key").alias("group")).agg(F.min("key").alias("key"))
        out_of = some.join(least.select("key", F.lit(True).alias("least")), "key", "left").where("least is null").select("key", F.lit(True).alias("linked"))
        classes = classes.join(out_of, "key", "left")
        stands = stands & F.col("linked").isNull()
    classes = classes.select("n", "key", "key2", "component_id", stands.alias("stands"))
    out = sets.where("id is not null and n > 0").join(classes, ["n", "key", "key2"]).select("id", F.col("n").alias("n_shingles"), "component_id", "key", "key2", (F.col("stands") & (F.col("id") == F.col("component_id"))).alias("stands"))
    rest = sets.where("id is null or n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), "key", "key2", F.lit(None).cast("boolean"))
    return out.union(rest)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 75, den: int = 100, lower: bool = True) -> DataFrame:
    """``docs`` without near copies: of each component one row stays, that with the smallest id; of
    several such rows (a repeated id, equal sets) the one with the least text. Rows with an empty
    set or a null id stay. Rows are told apart by id and set, so a row of other content that
    shares an id with a copy is judged by itself."""
    reach = _components_of_sets(docs, id_col, text_col, shingle, num, den, lower)
    judged = reach.where(F.col("stands").isNotNull())
    # ids of rows that go, or that hold the row that stays more than once: a few columns, no texts
    path = scratch_path(docs.sparkSession, "jaccard_judged")
    judged.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.count_if("stands").alias("standing")).write.parquet(path)
    several = docs.sparkSession.read.parquet(path)
    names = docs.columns
    gone = small_side(several.where("standing = 0").select(F.col("id").alias("__gone")), BROADCAST_GONE)
    left = docs.join(gone, docs[id_col].cast("long") == gone["__gone"], "left_anti")
    mixed = several.where("rows > 1 and standing > 0").select(F.col("id").alias("__mixed"))  # repeated ids
    if mixed.isEmpty():
        return left
    path = scratch_path(docs.sparkSession, "jaccard_mixed")
    some = left.join(mixed, left[id_col].cast("long") == mixed["__mixed"], "left_semi").withColumn("__row", F.monotonically_increasing_id())
    some.write.parquet(path)
    some = docs.sparkSession.read.schema(some.schema).parquet(path)
    keyed = set_table(some.select(F.col("__row").alias("id"), F.col(text_col).alias("text")), shingle, lower).select(F.col("id").alias("__row"), "n", F.col("key").alias("__key"), F.col("key2").alias("__key2"))
    standing = judged.where("stands").select(F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("key2").alias("__key2")).distinct()
    known = keyed.join(some.select("__row", F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text")), "__row")
    empty = known.where("n = 0").select("__row")
    first = known.where("n > 0").join(standing, ["__id", "__key", "__key2"]).groupBy("__id", "__key", "__key2").agg(F.min(F.struct("__text", "__row")).alias("f")).select(F.col("f.__row").alias("__row"))
    kept = some.join(empty.union(first), "__row", "left_semi").select(*[F.col(f"`{c}`") for c in names])
    return left.join(mixed, left[id_col].cast("long") == mixed["__mixed"], "left_anti").union(kept)
