"""Exact top-k inner products by block-at-a-time pruning.

Components become integers, floor(scale * x). Each input task writes its vectors as index parts
of about ``PART``, in the order of their ids, and its queries beside them, to shared storage. A part's
vectors form blocks of ``BLOCK`` (document ranges), each with the largest and smallest value of
every component: the block's term maxima. For a query, the sum over components of query value times
the block's largest value (smallest, where the query is negative) bounds every score in the block.
Blocks are taken in descending order of their largest bound and scored through their forward index
(their vectors) against the queries whose bound there is not below their k-th best score so far;
blocks whose bound equals it are still scored, since ties go to the smaller id.

Queries, in groups of about ``GROUP``, meet the whole index in at most ``RUNS`` tasks a group,
each of them a run of parts; a run gives its k best per query, and the best k of those are the
result. Vectors are neither shuffled nor broadcast nor sent to the driver, which gets one short row
per part; a task holds one group and a few blocks at a time.

Defined results: vectors that are null or hold a null or non-finite component take no part, as
query or candidate, nor do rows with a null id; a shorter vector counts as padded with zeros;
rows with the query's id are no candidates of it; other repeated ids are candidates each; extra
columns are ignored; a component or score that does not fit into 64 bits is an error, never a wrong
score; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import filestore
from quayside.session import scratch_path

BLOCK = 64  # vectors of a block
RANGE = 64  # blocks of an index record
PART = 16 * BLOCK * RANGE  # vectors of an index part, about; fewer where they are long
LENGTH = 64  # components up to which a vector is not long
GROUP = 8192  # queries of a group, about; fewer where vectors are long
TILE = 2048  # queries that meet a record at a time
RUNS = 16  # runs of parts that a group meets, at most
_SINGLE, _EXACT, _LIMIT = 1 << 24, 1 << 53, 1 << 63
_NONE, _LAST = -(1 << 63), (1 << 63) - 1  # score and id where there is no candidate yet


def integers(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, v) of the vectors that take part."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("x")).where("id is not null and x is not null")
    rows = rows.where(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    beyond = F.raise_error(F.lit("a component is beyond 64 bits")).cast("long")
    return rows.select("id", F.transform("x", lambda x: F.when(F.abs(x * scale) < float(1 << 62), F.floor(x * scale).cast("long")).otherwise(beyond)).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column, padded with zeros."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    n = np.diff(offsets)
    out = np.zeros((len(n), int(n.max()) if len(n) else 0), np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], n)] = values[offsets[0] : offsets[-1]]
    return out


def _longest(a: np.ndarray) -> float:
    """What no row of ``a`` exceeds in length."""
    d = a.astype(np.float64)
    return float(np.sqrt(np.einsum("ij,ij->i", d, d).max(initial=0))) * (1 + 1e-9)


def _most(a: float, b: float) -> int:
    """What no sum of products of rows up to these lengths exceeds, nor any part of the sum."""
    return int(max(a, 1) * max(b, 1) * (1 + 1e-9)) + 1


def _product(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """``a @ b.T`` of integers, exact; through single or double floats where no sum can leave their
    exact range, through unbounded integers where one might leave that of 64 bits."""
    kind = np.float32 if most < _SINGLE else np.float64 if most < _EXACT else np.int64 if most < _LIMIT else object
    if kind is object:
        a, b = a.astype(np.int64), b.astype(np.int64)
    return a.astype(kind, copy=False) @ b.astype(kind, copy=False).T


def _in_64_bits(scores: np.ndarray) -> np.ndarray:
    """A score beyond 64 bits is an error."""
    if scores.dtype == object and any(abs(x) >= _LIMIT for x in scores.reshape(-1) if x != _NONE):
        raise OverflowError("an inner product is beyond 64 bits")
    return scores.astype(np.int64) if scores.dtype == object else scores


def _multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer matrix product."""
    return _in_64_bits(_product(a, b.T, _most(_longest(a), _longest(b.T)))).astype(np.int64)


class Rows(NamedTuple):
    ids: np.ndarray
    values: np.ndarray  # integers, as single floats where these hold them
    longest: float


def _rows(ids: np.ndarray, vectors: np.ndarray) -> Rows:
    longest = _longest(vectors)
    return Rows(ids, vectors.astype(np.float32 if longest < _SINGLE else np.int64), longest)


class Blocks(NamedTuple):
    rows: Rows  # in the order of their ids
    high: np.ndarray
    low: np.ndarray
    longest: float


def _blocks(rows: Rows) -> Blocks:
    starts = np.arange(0, len(rows.ids), BLOCK)
    high = np.maximum.reduceat(rows.values, starts, axis=0)
    low = np.minimum.reduceat(rows.values, starts, axis=0)
    return Blocks(rows, high, low, _longest(np.maximum(np.abs(high), np.abs(low))))


def _bounds(queries: Rows, blocks: Blocks) -> np.ndarray | None:
    """What no score of a query in a block exceeds; where that might leave 64 bits, no bound at all."""
    most = 2 * _most(queries.longest, blocks.longest)
    if most >= _LIMIT:
        return None
    return _product(np.maximum(queries.values, 0), blocks.high, most) + _product(np.minimum(queries.values, 0), blocks.low, most)


def _reaches(scores: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether ``scores`` (of a type that holds them exactly) reach the integers ``least``."""
    if scores.dtype != np.int64:  # no score lies outside the exact range, its ends do for what does
        end = _SINGLE if scores.dtype == np.float32 else _EXACT
        least = np.clip(least, -end, end).astype(scores.dtype)
    return scores >= least


def _wide(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _none_yet(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full((n, k), _NONE, np.int64), np.full((n, k), _LAST, np.int64)


def _merge(best_s: np.ndarray, best_i: np.ndarray, of: np.ndarray, s: np.ndarray, i: np.ndarray) -> None:
    """Puts candidates (score ``s``, id ``i``) of the queries ``of`` into these queries' k best."""
    few, k = np.unique(of), best_s.shape[1]
    of = np.concatenate([np.repeat(few, k), of])
    s, i = np.concatenate([best_s[few].reshape(-1), s]), np.concatenate([best_i[few].reshape(-1), i])
    order = np.lexsort((i, ~s, of))
    first = np.searchsorted(of[order], few)
    top = order[first[:, None] + np.arange(k)]
    best_s[few], best_i[few] = s[top], i[top]


def _search(queries: Rows, blocks: Blocks, best_s: np.ndarray, best_i: np.ndarray, step: int) -> int:
    """Puts what is among the k best into ``best_s`` and ``best_i``; gives the blocks scored, counted
    for each query."""
    rows, k, scored = blocks.rows, best_s.shape[1], 0
    width = max(queries.values.shape[1], rows.values.shape[1])
    if width > rows.values.shape[1]:
        blocks = Blocks(Rows(rows.ids, _wide(rows.values, width), rows.longest), _wide(blocks.high, width), _wide(blocks.low, width), blocks.longest)
        rows = blocks.rows
    if width > queries.values.shape[1]:
        queries = Rows(queries.ids, _wide(queries.values, width), queries.longest)
    most, bounds = _most(queries.longest, rows.longest), _bounds(queries, blocks)
    own = np.searchsorted(rows.ids, queries.ids) < np.searchsorted(rows.ids, queries.ids, "right")
    starts = np.arange(0, len(rows.ids), BLOCK)
    order = np.argsort(-bounds.max(axis=0), kind="stable") if bounds is not None else np.arange(len(starts))
    for at in range(0, len(order), step):
        some = order[at : at + step]
        if bounds is None:
            live, n = np.arange(len(queries.ids)), len(some) * len(queries.ids)
        else:
            reached = _reaches(bounds[:, some], best_s[:, -1:])
            live, n = np.flatnonzero(reached.any(axis=1)), int(reached.sum())
            if not n:
                continue
            some = some[reached.any(axis=0)]
        scored += n
        where = (starts[some][:, None] + np.arange(BLOCK)).reshape(-1)
        where = where[where < len(rows.ids)]
        ids = rows.ids[where]
        scores = _product(queries.values if len(live) == len(queries.ids) else queries.values[live], rows.values[where], most)
        same = np.flatnonzero(own[live])
        if len(same):
            q, x = np.nonzero(queries.ids[live[same]][:, None] == ids)
            scores[same[q], x] = -np.inf if scores.dtype.kind == "f" else _NONE
        scores = _in_64_bits(scores)
        least = best_s[live, -1]
        new = np.flatnonzero(least == _NONE)
        if len(new) and len(ids) > k:  # no earlier k-th score: the k-th here
            kth = np.partition(scores[new], len(ids) - k, axis=1)[:, len(ids) - k]
            least[new] = np.where(kth == -np.inf, _NONE, kth) if scores.dtype.kind == "f" else kth
        hit = np.flatnonzero(_reaches(scores.max(axis=1), least))
        if not len(hit):
            continue
        here = scores[hit]
        q, x = np.nonzero(_reaches(here, least[hit, None]))
        s, i = here[q, x], ids[x]
        real = s != (-np.inf if s.dtype.kind == "f" else _NONE)
        q, s, i = live[hit[q[real]]], s[real].astype(np.int64), i[real]
        better = (s > best_s[q, -1]) | (i < best_i[q, -1])
        if better.any():
            _merge(best_s, best_i, q[better], s[better], i[better])
    return scored


def _found(query_ids: np.ndarray, best_s: np.ndarray, best_i: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    q, r = np.nonzero(best_s != _NONE)
    return query_ids[q], best_i[q, r], best_s[q, r]


def search_blocks(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, step: int = 8) -> tuple[list[tuple], int]:
    """((query, vector id, score) of the k best of each query, blocks scored); ``ids`` sorted."""
    best = _none_yet(len(query_ids), k)
    scored = _search(_rows(query_ids, queries), _blocks(_rows(ids, vectors)), *best, step)
    return list(zip(*(x.tolist() for x in _found(query_ids, *best)))), scored


def _write(out, ids: np.ndarray, vectors: np.ndarray, rows: int) -> None:
    """Records of up to ``rows`` vectors, in the smallest integers that hold them."""
    for at in range(0, len(ids), rows):
        some = vectors[at : at + rows]
        low, high = some.min(initial=0), some.max(initial=0)
        kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
        out.write(np.array([*some.shape, np.dtype(kind).itemsize], np.int64).tobytes())
        out.write(np.ascontiguousarray(ids[at : at + rows]).tobytes())
        out.write(some.astype(kind).tobytes())


def _records(folder: str, name: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    with filestore.opened(folder, name) as f:
        while head := f.read(24):
            n, width, size = np.frombuffer(head, np.int64).tolist()
            ids = np.frombuffer(f.read(8 * n), np.int64)
            yield ids, np.frombuffer(f.read(n * width * size), f"i{size}").reshape(n, width)


def write_index(vectors: DataFrame, is_query: Column, folder: str) -> list[tuple[str, int, int, int]]:
    """(part, vectors, queries among them, most components of one) of each index part. The files
    ``vectors-<part>`` and ``queries-<part>`` hold them."""
    part, most, record = PART, PART * LENGTH, min(PART, BLOCK * RANGE)

    def pack(batches):
        task, held, n, values, made = TaskContext.get(), [], 0, 0, 0

        def flush():
            width = max(m.shape[1] for _, _, m in held)
            ids, asked = (np.concatenate([x[c] for x in held]) for c in (0, 1))
            block = np.concatenate([_wide(m, width) for _, _, m in held])
            order = np.argsort(ids, kind="stable")
            ids, asked, block = ids[order], asked[order], block[order]
            name = f"{task.partitionId()}-{made}-{task.taskAttemptId()}"  # what a failed attempt left is not named
            with filestore.committed(folder, f"vectors-{name}") as out:
                _write(out, ids, block, record)
            if asked.any():
                with filestore.committed(folder, f"queries-{name}") as out:
                    _write(out, ids[asked], block[asked], record)
            return pa.record_batch([pa.array([name]), *(pa.array([int(x)], pa.int64()) for x in (len(ids), asked.sum(), width))], names=["part", "n", "asked", "width"])

        for batch in batches:
            for at in range(0, len(batch), record):
                some = batch.slice(at, record)
                held.append((some.column(0).to_numpy(), some.column(2).to_numpy(zero_copy_only=False).astype(bool), _matrix(some.column(1))))
                n, values = n + len(some), values + held[-1][2].size
                if n >= part or values >= most:
                    yield flush()
                    held, n, values, made = [], 0, 0, made + 1
        if n:
            yield flush()

    rows = vectors.select("id", "v", F.coalesce(is_query, F.lit(False)).alias("asked"))
    written = rows.mapInArrow(pack, "part string, n long, asked long, width long").collect()
    return sorted((tuple(x) for x in written), key=lambda x: [int(n) for n in x[0].split("-")])


def plan(parts: list[tuple[str, int, int, int]], cores: int) -> tuple[int, list[int]]:
    """(queries of a group, the run of each part): runs of about as many vectors each, as many as give
    each core a few tasks and each task a few parts, ``RUNS`` at most: each of them returns k rows per query."""
    total, asked, width = sum(p[1] for p in parts), sum(p[2] for p in parts), max((p[3] for p in parts), default=0)
    group = max(1, GROUP * LENGTH // max(width, LENGTH))
    groups = max(1, -(-asked // group))
    runs = max(1, min(RUNS, len(parts), max(-(-4 * cores // groups), -(-total // (16 * PART)))))
    ends = np.cumsum([p[1] for p in parts])
    middles = ends - np.array([p[1] for p in parts], np.int64) / 2
    return group, [int(x) for x in (middles * runs // max(total, 1))]


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each query. ``is_query`` is a condition
    on ``id``."""
    spark = rows.sparkSession
    folder = scratch_path(spark, "topk_index")
    parts = write_index(integers(rows, id_col, vector_col, scale), is_query, folder)
    group, run = plan(parts, spark.sparkContext.defaultParallelism)
    asked = sum(p[2] for p in parts)
    groups, runs = -(-asked // group), len(set(run))
    place = {r: at for at, r in enumerate(sorted(set(run)))}
    if parts:
        filestore.write_manifest(folder, [{"part": p, "asked": n, "run": place[r]} for (p, _, n, _), r in zip(parts, run)])

    def queries_of(g, files):
        """The queries of a group: so many in the order of the parts."""
        at, ids, held = 0, [], []
        for f in files:
            if f["asked"] and at < (g + 1) * group and g * group < at + f["asked"]:
                for some, m in _records(folder, f"queries-{f['part']}"):
                    few = slice(max(0, g * group - at), max(0, (g + 1) * group - at))
                    ids.append(some[few])
                    held.append(m[few])
                    at += len(some)
            else:
                at += f["asked"]
        width = max(m.shape[1] for m in held)
        return np.concatenate(ids), np.concatenate([_wide(m, width) for m in held])

    def search(batches):
        files = None
        for batch in batches:
            for pair in batch.column(0).to_pylist():
                files = files or filestore.manifest(folder)
                g, r = divmod(pair, runs)
                ids, m = queries_of(g, files)
                tiles = [(_rows(ids[at : at + TILE], m[at : at + TILE]), _none_yet(len(ids[at : at + TILE]), k)) for at in range(0, len(ids), TILE)]
                for f in files:
                    for some, vectors in _records(folder, f"vectors-{f['part']}") if f["run"] == r else ():
                        blocks = _blocks(_rows(some, vectors))
                        for queries, best in tiles:
                            _search(queries, blocks, *best, 16)
                for queries, best in tiles:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in _found(queries.ids, *best)], names=["query_id", "vec_id", "score"])

    pairs = spark.range(0, groups * runs, 1, max(1, groups * runs))
    found = pairs.mapInArrow(search, "query_id long, vec_id long, score long")
    best = found.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i")))).alias("all"))
    best = best.select("query_id", F.posexplode(F.slice("all", 1, k)).alias("p", "x"))
    return best.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.i").alias("vec_id"), (-F.col("x.s")).alias("score"))
