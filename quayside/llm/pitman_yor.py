"""Language-model scoring with a hierarchical Pitman-Yor model.

Every word has a restaurant whose customers are the words that follow it in the training texts,
and every pair of words has one for what follows the pair; places before the beginning of a text
count as one more word. Tables of one dish in the restaurants of all pairs that end in a word are
customers of that word's restaurant, its tables are customers of the root restaurant, and the
root's tables draw from a uniform base over the V words seen and one unknown word. So there are
as many restaurants as the texts have words and pairs.

Gibbs sampling: a sweep unseats all customers of a dish in a restaurant and seats them again one
by one, opening a table with odds (theta + d * tables) * parent probability against
(seated - d * tables of the dish); beyond the first customers in runs, within which these odds are
held. The restaurants' totals and the parent probabilities are those of the sweep before. Then
the parents seat their customers likewise. Words and pairs have one discount, the root its own.
Probabilities of a text are averaged over the samples after ``burn_in`` sweeps; ``perplexity``
sums them up.

Plan: a map task packs runs of documents into blobs: a dictionary of word hashes (common words
by place in a list of bounded size), and the distinct (word before, two before, word) with counts
and places as indices into it. One shuffle takes them
to ranges of the hash of the word before, kept as a table bucketed by range. So the restaurants of
a word and of all pairs that end in it, with all their customers, are in one range and seated
there. Only what meets in the root leaves it: per sweep a range sends the root customers of its
distinct words to ranges of word hashes, which seat the root and answer, two small shuffles; the
seating is kept as a table by range, joined without a shuffle. Words before that make up at least
``frequent`` of the tokens are dealt to several ranges by the word before them; the tables that
their pairs hold meet in the range of the dish, which seats them, and these words' totals, a small
table of bounded size, go through the driver. In the end ranges send sums per document to the
documents' runs. Shuffle files are dropped as soon as a table is written. Nothing that grows with
the texts goes through the driver. One pair of words is not split: its range holds an entry
for each document and word that has it.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end. Words are told apart by
64-bit hashes (the first word of a pair by 40 of these bits, among the pairs with one second word). Defined results: a null or empty text has the end only; rows with a null id are
training texts; repeated rows and ids are scored, and learned from, row by row; without training
texts every token is unknown; an empty table gives no rows; extra columns are ignored. Texts are
taken whole; one longer than a run is a run of its own. Row ids are taken from one scan.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import exchange
from quayside.llm.words import Words, mix, slices
from quayside.session import checkpoint_root, fresh_name, scratch_path

RUN_TOKENS = 1_500_000  # tokens that a map task sorts at a time
RANGE_BYTES = 4 << 20  # text whose tokens make up a range
CUT = 24  # a pair's first word is told apart by the other bits of its hash, among those before one word
COMMON = 1 / 32768  # share of the tokens from which a word is named by its place in a shared list
_U = np.uint64
END = int(mix(np.array([0xE0D], _U))[0])  # the hash that stands for the end of a text
START = int(mix(np.array([0x57A7], _U))[0])  # and for the places before its first word


class Rates(NamedTuple):
    d: float  # discounts and strengths of the context restaurants and of the root
    theta: float
    d0: float
    theta0: float


class Totals(NamedTuple):
    """What all ranges share of a seating."""

    root: tuple  # customers and tables of the root
    frequent: np.ndarray  # rows: customers, tables of each frequent word's restaurant


class Hot(NamedTuple):
    """Frequent words before: sorted hashes, and the ranges that each is dealt to; ``common``: hashes
    of common words, which dictionaries name by place."""

    hashes: np.ndarray
    splits: np.ndarray
    common: np.ndarray

    def of(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash, or -1."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        return _places(self.hashes, h)

    def listed(self, words: np.ndarray, cut: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes, without their lowest ``cut`` bits, as two columns to zip."""
        at = _places(self.common >> _U(cut), words)
        return _steps(at[at >= 0]), _steps(words[at < 0])

    def words(self, at: np.ndarray, rest: np.ndarray, cut: int = 0) -> np.ndarray:
        return np.sort(np.concatenate([self.common[np.cumsum(at)] >> _U(cut), _hashes(rest)]))


def _places(known: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Index of each hash among sorted ones, or -1."""
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, at, -1)


def seat(rng, count: np.ndarray, a: np.ndarray, d: float) -> np.ndarray:
    """Tables after seating ``count`` customers of each dish in turn; ``a``: the weight of a new
    table, (theta + d * all tables) * parent probability."""
    tables = (count > 0).astype(np.int64)
    live = np.flatnonzero(count > 1)
    n, c, w, t = np.ones(len(live), np.int64), count[live], a[live], np.ones(len(live), np.int64)
    while len(live):
        run = np.minimum(np.maximum(1, (0.02 * (n + w)).astype(np.int64)), c - n)
        p = w / (w + n - d * t)
        new = rng.random(len(live)) < p if run.max() == 1 else rng.binomial(run, p)
        t = np.minimum(t + new, c)
        n = n + run
        done = n >= c
        tables[live[done]] = t[done]
        go = ~done
        live, n, c, w, t = live[go], n[go], c[go], w[go], t[go]
    return tables


# ---- blobs -----------------------------------------------------------------------------------


def _zip(*columns: np.ndarray) -> bytes:
    """Columns of any lengths, 8-byte values as byte planes, each compressed by itself."""
    head, sizes, body = [len(columns)], [], []
    for x in columns:
        x = x.view(_U) if x.dtype.itemsize == 8 else x.astype(np.int64).view(_U)
        low, top = (int(x.min()), int(x.max())) if len(x) else (0, 0)
        width = ((top - low).bit_length() + 7) // 8
        head += [len(x), low, width]
        for plane in np.ascontiguousarray((x - _U(low)).view(np.uint8).reshape(-1, 8)[:, :width].T):
            raw = plane.tobytes()
            small = pa.compress(raw, codec="zstd", asbytes=True) if len(raw) > 64 else raw
            body.append(small if len(small) < len(raw) else raw)
            sizes.append(len(body[-1]))
    return np.array(head, _U).tobytes() + np.array(sizes, np.uint32).tobytes() + b"".join(body)


def _unzip(blob: bytes) -> list[np.ndarray]:
    buf = memoryview(blob)
    k = int(np.frombuffer(buf, _U, 1)[0])
    head = np.frombuffer(buf, _U, 1 + 3 * k)
    sizes = iter(np.frombuffer(buf, np.uint32, int(head[3::3].sum()), 8 * len(head)).tolist())
    at, out = 8 * len(head) + 4 * int(head[3::3].sum()), []
    for n, low, width in head[1:].reshape(-1, 3):
        n = int(n)
        x = np.zeros((n, 8), np.uint8)
        for i in range(int(width)):
            size = next(sizes)
            plane = buf[at : at + size]
            x[:, i] = np.frombuffer(plane if size == n else pa.decompress(plane, n, codec="zstd"), np.uint8)
            at += size
        out.append((x.reshape(-1).view(_U) + low).view(np.int64))
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences, as sorted numbers are zipped; ``np.cumsum`` takes them back."""
    x = x.view(_U) if x.dtype.itemsize == 8 else x.astype(_U)
    return np.diff(x, prepend=x[:0].sum(dtype=_U))


def _hashes(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x.view(_U), dtype=_U)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where the next group of equal entries begins."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for x in columns:
            new[1:] |= x[1:] != x[:-1]
    return new


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers; on runs that are sorted or short, quicker than ``np.unique``."""
    x = np.sort(x)
    return x[_changes(x)]


def _order(n: int, *columns: np.ndarray) -> np.ndarray:
    """Stable order by columns of indices below n: 16 bits at a time, which numpy sorts by radix.
    Neighbouring columns share a key as long as it has 64 bits."""
    bits, order = max(n - 1, 1).bit_length(), None
    for last in range(len(columns), 0, -max(1, 64 // bits)):
        some = columns[max(0, last - max(1, 64 // bits)) : last]
        key = some[0].astype(_U)
        for x in some[1:]:
            key = key << _U(bits) | x.view(_U)
        for shift in range(0, bits * len(some), 16):
            digit = ((key if order is None else key[order]) >> _U(shift)).astype(np.uint16)
            turn = np.argsort(digit, kind="stable")
            order = turn if order is None else order[turn]
    return order


def _groups(batches):
    """(key, lists of the other columns) of rows sorted by their first column."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if held and row[0] != now:
                yield now, [list(x) for x in zip(*held)]
                held = []
            now = row[0]
            held.append(row[1:])
    if held:
        yield now, [list(x) for x in zip(*held)]


_RUNS = pa.schema([("bucket", pa.int32()), ("run", pa.int64()), ("blob", pa.binary())])
_SENT = pa.schema([("piece", pa.int32()), ("origin", pa.int32()), ("blob", pa.binary())])
_BACK = pa.schema([("bucket", pa.int32()), ("piece", pa.int32()), ("blob", pa.binary())])
_STATE = pa.schema([("bucket", pa.int32()), ("state", pa.binary())])
_RANGES = pa.schema([("bucket", pa.int32()), ("run", pa.int64()), ("pairs", pa.binary()), ("refs", pa.binary())])


def _rows(schema: pa.Schema, rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


@contextmanager
def _short_lived_shuffles(spark: SparkSession):
    """Shuffle files of the writes inside go when the write has ended, not when the driver
    collects garbage; tables are read again from their files."""
    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(option, None)
    spark.conf.set(option, "true")
    try:
        yield
    finally:
        spark.conf.unset(option) if before is None else spark.conf.set(option, before)


def _keep(rows: DataFrame, parts: int) -> DataFrame:
    """``rows``, dealt to ``parts`` by bucket, as a table that Spark knows to be dealt so: joins on
    the bucket need no shuffle. Only its files stay, not its name."""
    spark, name = rows.sparkSession, fresh_name("pitman_yor")
    with _short_lived_shuffles(spark):
        rows.write.format("parquet").option("compression", "uncompressed").bucketBy(parts, "bucket").option("path", scratch_path(spark, "pitman_yor")).saveAsTable(name)
    out = spark.table(name)
    out.schema  # resolved here
    spark.sql(f"DROP TABLE {name}")
    return out


# ---- ranges ----------------------------------------------------------------------------------


def _tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every token of a slice, the ends included."""
    total = len(w.hash) + w.n_docs
    place, ends = np.arange(len(w.hash)) + w.doc, np.cumsum(w.count + 1) - 1
    h, doc = np.full(total, END, _U), np.zeros(total, np.int64)
    h[place], doc[place], doc[ends] = w.hash, w.doc, np.arange(w.n_docs)
    return h, doc


def _frequent(docs: DataFrame, hot: float, buckets: int, share: float = COMMON) -> Hot:
    """Words that make up ``hot`` of the tokens, and common ones: ``share`` of some run of
    documents and half of that overall, at most 2 / share. They only decide what is split and how
    dictionaries are written."""

    def run(batches):
        counts = []
        for batch in batches:
            for _, _, w in slices(batch.column(0), lower=True):
                if len(w.hash):
                    h, n = np.unique(w.hash, return_counts=True)
                    big = n >= max(2, share * len(w.hash))
                    counts.append((h[big], n[big], len(w.hash)))
        if counts:
            h, inverse = np.unique(np.concatenate([c[0] for c in counts]), return_inverse=True)
            n = np.bincount(inverse, np.concatenate([c[1] for c in counts]), minlength=len(h)).astype(np.int64)
            tokens = sum(c[2] for c in counts)
            keep = n >= share * tokens / 2
            yield pa.record_batch([pa.array(np.append(h[keep], _U(0)).view(np.int64)), pa.array(np.append(n[keep], tokens)), pa.array(np.append(np.zeros(keep.sum(), bool), True))], names=["h", "n", "all"])

    checkpoint_root(docs.sparkSession)  # known to Spark from here on
    found = docs.select("text").mapInArrow(run, "h long, n long, all boolean").groupBy("h", "all").agg(F.sum("n").alias("n")).checkpoint()
    tokens = found.where("all").agg(F.sum("n")).first()[0] or 0
    rows = found.where(~F.col("all") & (F.col("n") >= share * tokens / 2)).select("h", "n").collect()  # at most 2 / share
    h, n = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
    h, order = np.sort(h.view(_U)), np.argsort(h.view(_U))
    n = n[order]
    often = n >= hot * tokens
    return Hot(h[often], np.maximum(2, np.ceil(2 * n[often] / max(tokens, 1) * buckets)).astype(np.int64), np.unique(np.append(h, _U(END))))


def _ranges(docs: DataFrame, hot: Hot, parts: int, bits: int) -> DataFrame:
    """Rows (bucket, run, pairs, refs): of each range of words before its training counts by (word
    before, two before, word) and the places of these in the runs; and in buckets from 2**bits
    on, a row per run with its documents as ``pairs``."""
    shift = _U(64 - bits)

    def emit(batches):
        held, n = [], 0

        def flush():
            count = np.cumsum([0] + [len(x[2]) for x in held])
            h = np.concatenate([x[0] for x in held])
            doc = np.concatenate([x[1] + c for x, c in zip(held, count)])
            row, ids, null, train = (np.concatenate([x[k] for x in held]) for k in (2, 3, 4, 5))
            run = int(row[0])
            yield ((1 << bits) + int(mix(np.array([run], np.int64).view(_U))[0] >> shift), run, _zip(row, ids, null, np.bincount(doc, minlength=len(row))))
            words, w = np.unique(np.append(h, _U(START)), return_inverse=True)
            start, w = w[-1], w[:-1].astype(np.int64)
            begins = _changes(doc)
            v, u = np.empty_like(w), np.empty_like(w)
            v[1:], u[2:] = w[:-1], w[:-2]
            v[begins], u[begins], u[np.flatnonzero(begins)[np.flatnonzero(begins) + 1 < len(w)] + 1] = start, start, start
            short = words >> _U(CUT)
            first = _changes(short)
            short, u = short[first], (np.cumsum(first) - 1)[u]
            bucket = (words >> shift).astype(np.int64)[v]
            f = hot.of(words)[v]
            some = np.flatnonzero(f >= 0)
            if len(some):
                place = (mix(short[u[some]]) % hot.splits[f[some]].astype(_U)) + _U(1)
                bucket[some] = (mix(words[v[some]] ^ mix(place)) >> shift).astype(np.int64)
            order = _order(len(words), v, u, w)
            if len(some):  # else buckets ascend with the words before
                order = order[_order(1 << bits, bucket[order])]
            v, u, w, doc, bucket = v[order], u[order], w[order], doc[order], bucket[order]
            entry = _changes(v, u, w)
            ref = entry | _changes(doc)
            at, refs = np.flatnonzero(entry), np.flatnonzero(ref)
            many = np.diff(np.append(refs, len(v)))
            of = np.cumsum(entry)[refs] - 1
            counts = np.bincount(of, many * train[doc[refs]], minlength=len(at)).astype(np.int64)
            places = np.bincount(of, minlength=len(at))
            v, u, w, bucket, doc = v[at], u[at], w[at], bucket[at], doc[refs]
            ends = np.cumsum(places)
            cuts = np.append(np.flatnonzero(_changes(bucket)), len(bucket))
            index, index2 = np.zeros(len(words), np.int64), np.zeros(len(short), np.int64)
            for a, b in zip(cuts[:-1], cuts[1:]):
                before = v[a:b]
                own, own2 = _distinct(np.append(before[_changes(before)], w[a:b])), _distinct(u[a:b])
                index[own], index2[own2] = np.arange(len(own)), np.arange(len(own2))
                x, y = ends[a] - places[a], ends[b - 1]
                yield (int(bucket[a]), run, _zip(*hot.listed(words[own]), *hot.listed(short[own2], CUT), index[v[a:b]], index2[u[a:b]], index[w[a:b]], counts[a:b], places[a:b], doc[x:y], many[x:y]))

        for batch in batches:
            row, ids = batch.column(0).to_numpy(), batch.column(1)
            null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            train = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b, w in slices(batch.column(2), lower=True):
                h, doc = _tokens(w)
                held.append((h, doc, row[a:b], ids[a:b], null[a:b], train[a:b]))
                n += len(h)
                if n >= RUN_TOKENS:
                    yield _rows(_RUNS, list(flush()))
                    held, n = [], 0
                    exchange.release_memory()
        if held:
            yield _rows(_RUNS, list(flush()))
        held = []
        exchange.release_memory()

    def merge(batches):
        for bucket, (runs, blobs) in _groups(batches):
            if bucket >= 1 << bits:
                yield _rows(_RANGES, [(bucket, run, blob, None) for run, blob in zip(runs, blobs)])
                continue
            parts_ = [_unzip(b) for b in blobs]
            size = 1

            def joined(first: int, cut: int, *columns: int) -> list[np.ndarray]:
                nonlocal words, size
                known = [hot.words(p[first], p[first + 1], cut) for p in parts_]
                words = _distinct(np.concatenate(known))
                size = max(size, len(words))
                at = [np.searchsorted(words, d) for d in known]
                return [np.concatenate([i[p[k]] for i, p in zip(at, parts_)]) for k in columns]

            words = None
            (u,) = joined(2, CUT, 5)
            v, w = joined(0, 0, 4, 6)
            count = np.concatenate([p[7] for p in parts_])
            order = _order(size, v, u, w)
            v, u, w = v[order], u[order], w[order]
            new = _changes(v, u, w)
            entry = np.empty(len(order), np.int64)
            entry[order] = np.cumsum(new) - 1
            count = np.bincount(entry, count).astype(np.int64)
            v, u, w = v[new], u[new], w[new]
            pairs = _zip(*hot.listed(words), _steps(v), w, count, _changes(v, u))
            sizes, refs, base = [], [], 0
            for p in parts_:
                e = entry[base : base + len(p[4])]
                base += len(p[4])
                refs.append(_steps(np.repeat(e, p[8])))
                sizes.append(len(refs[-1]))
            refs = _zip(np.array(runs, np.int64), np.array(sizes), np.concatenate(refs), np.concatenate([p[9] for p in parts_]), np.concatenate([p[10] for p in parts_]))
            yield _rows(_RANGES, [(bucket, None, pairs, refs)])
        exchange.release_memory()

    blobs = docs.select("row", "doc_id", "text", "train").mapInArrow(emit, _ddl(_RUNS))
    dealt = blobs.repartition(parts, "bucket").sortWithinPartitions("bucket", "run")
    return _keep(dealt.mapInArrow(merge, _ddl(_RANGES)), parts)


class Range:
    """The restaurants of one range of words before. ``pair`` and ``count`` list the
    entries of pairs, ``dv``, ``dw`` the dishes of single words (index into ``words``); ``t3`` and ``t2`` are
    their tables. ``c0``, ``t0``, ``n`` are the root's customers, tables and the training count of
    each word that follows something (``after``), ``hot2`` customers and tables of the dishes of
    frequent words, in the order of ``far``."""

    def __init__(self, bucket: int, pairs: bytes, hot: Hot, seed: int, state: bytes | None = None):
        common, rest, v, w, self.count, pair = _unzip(pairs)
        self.bucket, self.seed, self.words = bucket, seed, hot.words(common, rest)
        n = len(self.words)
        v = np.cumsum(v)
        self.pair = np.cumsum(pair) - 1
        order = _order(n, v, w)
        first = _changes(v[order], w[order])
        self.dish = np.empty(len(v), np.int64)
        self.dish[order] = np.cumsum(first) - 1
        self.dv, self.dw = v[order[first]], w[order[first]]
        follows = np.bincount(self.dw, minlength=n) > 0
        self.after, self.word = np.flatnonzero(follows), (np.cumsum(follows) - 1)[self.dw]  # of each dish
        self.f = hot.of(self.words)[self.dv]
        far = np.flatnonzero(self.f >= 0)
        self.far = far[np.lexsort((self.f[far], self.word[far]))]
        self.near = np.flatnonzero(self.f < 0)
        self.total = np.bincount(self.word[self.dish], self.count, minlength=len(self.after)).astype(np.int64)
        self.take(state)

    def take(self, state: bytes | None) -> None:
        """Takes a kept seating; None: one table for each dish."""
        if state is None:
            self.t3 = (self.count > 0).astype(np.int64)
        else:
            self.t3, t2, self.c0, self.t0, self.n, c, t = _unzip(state)
        self._customers()
        if state is None:
            self.t2 = (self.c2 > 0).astype(np.int64)
            self.c0 = self.t0 = self.n = np.zeros(len(self.after), np.int64)
        else:
            self.t2 = np.zeros(len(self.dv), np.int64)
            self.t2[self.near] = t2
            self.c2[self.far], self.t2[self.far] = c, t

    def _customers(self) -> None:
        self.c2 = np.bincount(self.dish, self.t3, minlength=len(self.dv)).astype(np.int64)

    def _above(self, totals: Totals, rates: Rates, base: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each dish: root probability, tables and customers of its restaurant."""
        p0 = root_probability(self.c0, self.t0, totals, rates, base)[self.word]
        c = np.bincount(self.dv, self.c2, minlength=len(self.words))[self.dv]
        t = np.bincount(self.dv, self.t2, minlength=len(self.words))[self.dv]
        c[self.far], t[self.far] = totals.frequent[:, self.f[self.far]]
        return p0, c, t

    def after_one(self, totals: Totals, rates: Rates, base: float) -> np.ndarray:
        """Probability of each dish after the word before."""
        p0, c, t = self._above(totals, rates, base)
        return (np.maximum(self.c2 - rates.d * self.t2, 0) + (rates.theta + rates.d * t) * p0) / (rates.theta + c)

    def after_two(self, totals: Totals, rates: Rates, base: float) -> np.ndarray:
        """Probability of each entry after the two words before."""
        c, t = (np.bincount(self.pair, x)[self.pair] for x in (self.count, self.t3))
        p = self.after_one(totals, rates, base)[self.dish]
        return (np.maximum(self.count - rates.d * self.t3, 0) + (rates.theta + rates.d * t) * p) / (rates.theta + c)

    def sweep(self, number: int, totals: Totals, rates: Rates, base: float) -> None:
        rng = np.random.default_rng([self.seed, number, self.bucket])
        p2 = self.after_one(totals, rates, base)
        p0, _, t2 = self._above(totals, rates, base)
        t3 = np.bincount(self.pair, self.t3)[self.pair]
        self.t3 = seat(rng, self.count, (rates.theta + rates.d * t3) * p2[self.dish], rates.d)
        self._customers()
        self.t2 = np.zeros(len(self.dv), np.int64)
        self.t2[self.near] = seat(rng, self.c2[self.near], ((rates.theta + rates.d * t2) * p0)[self.near], rates.d)

    def messages(self, bits: int):
        """(piece, blob) for the ranges of words: root customers, count and last root seating of
        each word, customers of frequent words' dishes; statistics in the first."""
        own = np.bincount(self.word[self.near], self.t2[self.near], minlength=len(self.after)).astype(np.int64)
        stats = np.array([x for k in (1, 2) for x in ((self.count == k).sum() + (self.c2[self.near] == k).sum(),)], np.int64)
        h = self.words[self.after]
        piece = (h >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
        cuts = np.append(np.flatnonzero(_changes(piece)), len(piece))
        ends = np.searchsorted(self.word[self.far], cuts)
        for a, b, x, y in zip(cuts[:-1], cuts[1:], ends[:-1], ends[1:]):
            some = self.far[x:y]
            yield int(piece[a]), _zip(_steps(h[a:b]), own[a:b], self.total[a:b], self.c0[a:b], self.t0[a:b], self.word[some] - a, self.f[some], self.c2[some], stats)
            stats = stats * 0


def root_probability(c: np.ndarray, t: np.ndarray, totals: Totals, rates: Rates, base: float) -> np.ndarray:
    customers, tables = totals.root
    return (np.maximum(c - rates.d0 * t, 0) + (rates.theta0 + rates.d0 * tables) * base) / (rates.theta0 + customers)


def _answer(messages: list, rng, totals: Totals | None, rates: Rates, base: float, n_hot: int):
    """Seats one range of words: (an answer per message; customers and tables of the root, dishes
    there by 1 and 2 customers, dishes of frequent words likewise, words, tokens, then customers
    and tables of each frequent word)."""
    asked = [_hashes(m[0]) for m in messages]
    words = _distinct(np.concatenate(asked))
    at = [np.searchsorted(words, h) for h in asked]
    c0, n, was_c, was_t = (np.zeros(len(words), np.int64) for _ in range(4))
    for i, m in zip(at, messages):
        c0[i] += m[1]  # a range names a word once
        n[i] += m[2]
        was_c[i], was_t[i] = m[3], m[4]
    word = np.concatenate([i[m[5]] for i, m in zip(at, messages)])
    f = np.concatenate([m[6] for m in messages])
    dishes, dish = np.unique(word * max(n_hot, 1) + f, return_inverse=True)
    c2 = np.bincount(dish, np.concatenate([m[7] for m in messages]), minlength=len(dishes)).astype(np.int64)
    word, f = dishes // max(n_hot, 1), dishes % max(n_hot, 1)
    if totals is None:
        t2 = (c2 > 0).astype(np.int64)
    else:
        p0 = root_probability(was_c, was_t, totals, rates, base)
        t2 = seat(rng, c2, (rates.theta + rates.d * totals.frequent[1][f]) * p0[word], rates.d)
    c0 += np.bincount(word, t2, minlength=len(words)).astype(np.int64)
    t0 = (c0 > 0).astype(np.int64) if totals is None else seat(rng, c0, np.full(len(c0), (rates.theta0 + rates.d0 * totals.root[1]) * base), rates.d0)
    replies, x = [], 0
    for i, m in zip(at, messages):
        own = dish[x : x + len(m[5])]
        x += len(m[5])
        replies.append(_zip(c0[i], t0[i], n[i], c2[own], t2[own]))
    near = np.sum([m[8] for m in messages], axis=0)
    some = [c0.sum(), t0.sum(), (c0 == 1).sum(), (c0 == 2).sum(), near[0] + (c2 == 1).sum(), near[1] + (c2 == 2).sum(), (n > 0).sum(), n.sum()]
    return replies, np.concatenate([some, np.bincount(f, c2, minlength=n_hot), np.bincount(f, t2, minlength=n_hot)]).astype(np.int64)


def _discount(one: float, two: float) -> float:
    """Discount from the dishes with one and two customers."""
    return float(np.clip(one / (one + 2 * two), 0.1, 0.95)) if one else 0.5


class Model(NamedTuple):
    table: DataFrame  # the ranges
    states: list  # (bucket, state) after seating one table for each dish, and after each sweep
    totals: list  # of the same
    hot: Hot
    rates: Rates
    words: int  # distinct words (V)
    tokens: int  # training tokens (N)
    burn_in: int
    seed: int
    bits: int
    parts: int

    def samples(self) -> list[int]:
        last = len(self.states) - 1
        return [k for k in range(len(self.states)) if k > self.burn_in or k == last]


def fit(docs: DataFrame, sweeps: int = 3, burn_in: int = 1, frequent: float | None = None, theta: float = 1.0, seed: int = 5) -> Model:
    """``docs``: (row, text, train) and perhaps doc_id. Runs the sweeps; the model's table has all
    tokens. ``frequent`` is by default a quarter of a range's share, 1/2048 at least."""
    spark = docs.sparkSession
    if "doc_id" not in docs.columns:
        docs = docs.withColumn("doc_id", F.col("row").cast("long"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size) // (4 * RANGE_BYTES), 1)
    bits = max(2, (int(size) // RANGE_BYTES).bit_length())
    hot = _frequent(docs, frequent or max(1 / 2048, 0.25 / (1 << bits)), 1 << bits)
    table, piece_bits, n_hot = _ranges(docs, hot, parts, bits), max(0, bits - 3), len(hot.hashes)
    ranges = table.where(F.col("bucket") < 1 << bits).select("bucket", "pairs")

    def seated(number: int, last: DataFrame | None, totals: Totals | None, rates: Rates, base: float):
        sent = spark.sparkContext.broadcast((hot, totals, rates, base))  # bounded: frequent words

        def send(batches):
            hot, totals, rates, base = sent.value
            for batch in batches:
                for i, bucket in enumerate(batch.column(0).to_pylist()):
                    r = Range(bucket, batch.column(1)[i].as_py(), hot, seed, batch.column(2)[i].as_py() if totals else None)
                    if totals:
                        r.sweep(number, totals, rates, base)
                    out = [(piece, bucket, blob) for piece, blob in r.messages(piece_bits)]
                    # the range's own seating goes along to where the answers are kept
                    yield _rows(_SENT, out + [((1 << piece_bits) + bucket, bucket, _zip(r.t3, r.t2[r.near]))])
            exchange.release_memory()

        def reply(batches):
            hot, totals, rates, base = sent.value
            for piece, (origins, blobs) in _groups(batches):
                if piece >= 1 << piece_bits:
                    yield _rows(_BACK, [(origins[0], -1, blobs[0])])
                    continue
                replies, sums = _answer([_unzip(b) for b in blobs], np.random.default_rng([seed, number, piece, 1]), totals, rates, base, len(hot.hashes))
                yield _rows(_BACK, [(o, piece, b) for o, b in zip(origins, replies)] + [(-1, piece, _zip(sums))])
            exchange.release_memory()

        def receive(batches):
            for bucket, (_, blobs) in _groups(batches):
                if bucket < 0:
                    yield _rows(_STATE, [(-1, _zip(np.sum([_unzip(b)[0] for b in blobs], axis=0)))])
                    continue
                own, *answers = (_unzip(b) for b in blobs)
                yield _rows(_STATE, [(bucket, _zip(*own, *(np.concatenate(x) for x in zip(*answers))))])
            exchange.release_memory()

        source = ranges if last is None else ranges.join(last.hint("merge"), "bucket")
        up = source.mapInArrow(send, _ddl(_SENT)).repartition(parts, "piece").sortWithinPartitions("piece", "origin")
        down = up.mapInArrow(reply, _ddl(_BACK)).repartition(parts, "bucket").sortWithinPartitions("bucket", "piece")
        kept = _keep(down.mapInArrow(receive, _ddl(_STATE)), parts)
        sent.unpersist()
        row = kept.where("bucket = -1").first()
        sums = _unzip(row.state)[0].astype(float) if row else np.zeros(8 + 2 * n_hot)
        return kept.where("bucket >= 0"), sums

    states, totals = [], []
    rates, base, n_words, n_tokens = Rates(0.5, theta, 0.5, theta), 1.0, 0, 0
    for number in range(sweeps + 1):
        kept, s = seated(number, states[-1] if number else None, totals[-1] if number else None, rates, base)
        if not number:
            n_words, n_tokens = int(s[6]), int(s[7])
            base = 1.0 / (n_words + 1)
            rates = Rates(_discount(s[4], s[5]), theta, _discount(s[2], s[3]), theta)
        states.append(kept)
        totals.append(Totals((s[0], s[1]), s[8:].reshape(2, n_hot)))
    return Model(table, states, totals, hot, rates, n_words, n_tokens, burn_in, seed, bits, parts)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row, doc_id, n_tokens, n_known, base_score, score) of every row of ``docs``, the table that
    the model was fitted on."""
    spark, picked = docs.sparkSession, model.samples()
    sent = spark.sparkContext.broadcast((model._replace(table=None, states=None, totals=None), [model.totals[k] for k in picked]))
    out_ddl = "run long, kind int, blob binary"
    schema = pa.schema([("run", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        m, history = sent.value
        base, floor = 1.0 / (m.words + 1), m.tokens + 0.5 * (m.words + 1)
        held = []
        for batch in batches:
            for i, bucket in enumerate(batch.column(0).to_pylist()):
                p, r = 0.0, Range(bucket, batch.column(1)[i].as_py(), m.hot, m.seed)
                for k, totals in enumerate(history):
                    r.take(batch.column(3 + k)[i].as_py())
                    p = p + r.after_two(totals, m.rates, base)
                n = r.n[r.word[r.dish]]
                log_p, log_b = np.log10(p / len(history)), np.log10((n + 0.5) / floor)
                runs, size, entry, doc, many = _unzip(batch.column(2)[i].as_py())
                begin = np.cumsum(size) - size
                for a, s, x in zip(begin, size, runs):  # entries count up within a run
                    entry[a : a + s] = np.cumsum(entry[a : a + s])
                held.append(_sums([(np.repeat(runs, size), doc, many * (n[entry] > 0), many * log_b[entry], many * log_p[entry])]))
        if held:
            runs, doc, known, b, s = _sums(held)
            cuts = np.append(np.flatnonzero(_changes(runs)), len(runs))
            yield _rows(schema, [(int(runs[x]), 1, _zip(doc[x:y], known[x:y], b[x:y], s[x:y])) for x, y in zip(cuts[:-1], cuts[1:])])
        exchange.release_memory()

    def add(batches):
        for _, (kinds, blobs) in _groups(batches):
            row, ids, null, tokens = _unzip(blobs[0])
            known, b, s = np.zeros(len(row), np.int64), np.zeros(len(row)), np.zeros(len(row))
            for blob in blobs[1:]:
                doc, known_, b_, s_ = _unzip(blob)
                known[doc] += known_
                b[doc] += b_.view(np.float64)
                s[doc] += s_.view(np.float64)
            yield pa.record_batch([pa.array(row), pa.array(ids, mask=null.astype(bool)), *map(pa.array, (tokens, known, b, s))], names=["row", "doc_id", "n_tokens", "n_known", "base_score", "score"])
        exchange.release_memory()

    table = model.table.where(F.col("bucket") < 1 << model.bits).select("bucket", "pairs", "refs")
    for k in picked:
        table = table.join(model.states[k].withColumnRenamed("state", f"state{k}").hint("merge"), "bucket")
    meta = model.table.where(F.col("bucket") >= 1 << model.bits).select("run", F.lit(0).alias("kind"), F.col("pairs").alias("blob"))
    both = meta.union(table.mapInArrow(run, out_ddl)).repartition(model.parts, "run").sortWithinPartitions("run", "kind")
    return both.mapInArrow(add, "row long, doc_id long, n_tokens long, n_known long, base_score double, score double")


def _sums(parts: list) -> tuple:
    """(run, doc, known, base, score) added up by run and doc."""
    runs, doc, *values = (np.concatenate(x) for x in zip(*parts))
    begin = np.flatnonzero(_changes(runs))  # entries of a run come in rows
    names, of = np.unique(runs[begin], return_inverse=True)
    width = int(doc.max()) + 1 if len(doc) else 1
    order = _order(len(names) * width, np.repeat(of, np.diff(np.append(begin, len(runs)))) * width + doc)
    runs, doc = runs[order], doc[order]
    at = np.flatnonzero(_changes(runs, doc))
    return runs[at], doc[at], *(np.add.reduceat(x[order], at) if len(at) else x for x in values)


def held_out(id_col: str, parts: int = 5, part: int = 1) -> Column:
    """crc32 of the id as text, modulo ``parts``, is ``part``; false for null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def digest(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    slim = slim.withColumn("train", ~held_out("doc_id"))
    model = fit(slim, **options)
    out = score(slim, model).withColumn("held_out", held_out("doc_id"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def perplexity(scores: DataFrame) -> DataFrame:
    """(held_out, tokens, base_perplexity, perplexity) of a ``digest``."""
    power = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(F.sum("n_tokens").alias("tokens"), power("base_score").alias("base_perplexity"), power("score").alias("perplexity"))


__all__ = ["digest", "fit", "perplexity", "score", "seat"]
