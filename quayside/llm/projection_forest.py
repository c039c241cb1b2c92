"""Near-duplicate embeddings by a forest of random-projection trees.

Every tree splits the vectors recursively by random projections until a node holds few of them; the
vectors near a split's threshold go to both sides (spill overlap). Vectors are compared within the
leaves of all trees; pairs whose cosine reaches the threshold link, and linked vectors are united.

Plan.

1. Rows with equal vectors become one class (its smallest id, its size), counted in Spark before the
   shuffle, so thousands of copies are one vector from here on.
2. All trees grow in rounds, a round for some eight levels. A node of more than ``NODE`` vectors is
   fitted on about ``SAMPLE`` of them, chosen by a hash (the bound of the fit: what a task and a
   splitter hold does not grow with the table); all its vectors are then dealt by the splits. Nodes
   are keys of a shuffle, a large one salted over many tasks, its splitter sent to each.
3. A split takes, of ``DIRECTIONS`` random directions, the one whose projections leave the sparsest
   place in the middle half, and cuts there: groups of close vectors are seldom cut. The vectors of
   that sparse place (``SPILL`` of the node) go to both sides. A node whose vectors are mostly one tight
   group (squared length of their mean above ``TIGHT``) is not split.
4. Leaves are compared whole, in blocks of rows; one of more than ``CHUNK`` vectors (a tight group) in
   pairs of chunks, each in a task of its own, so no pair is lost and no task holds a whole group.
   Every vector carries the leaves it lies in, and a pair counts in the first leaf that both share,
   so links are counted once though pairs never leave their task: what leaves it is one row per vector
   (its links, and the smallest id it reaches there).
5. Those rows are summed, and united by connected components.

All vectors are indexed; a pair is missed only if each tree puts its two vectors apart. The work on a
tight group of m different vectors is m * m / 2 products, as every one of its pairs is a link to count.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component links with
nothing; a shorter vector counts as padded with zeros; a row with a null id takes no part and comes
back with no component, not kept; rows that repeat an id are rows of their own (equal vectors link),
and all rows that carry the component's id are kept; the operator ignores other columns, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.components import components
from quayside.llm.words import mix
from quayside.session import scratch_path

TREES = 8
NODE = 1024  # vectors of a leaf, about
SAMPLE = 8192  # vectors that a node's splits are fitted on, about
DIRECTIONS = 8
SPILL = 0.04  # share of a node on both sides of a split
TIGHT = 0.5
CHUNK = 2048  # vectors of a chunk of a leaf that stays large
_ROUTED = 50_000  # vectors of a node that one task deals
_SLACK = 1e-12  # rounding of a cosine in double precision


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a list column as rows of unit length, in double precision."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    n = np.diff(offsets)
    out = np.zeros((len(n), int(n.max()) if len(n) else 0))
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], n)] = values[offsets[0] : offsets[-1]]
    if out.size:
        out /= np.abs(out).max(axis=1, keepdims=True)  # no square can overflow or vanish
        out /= np.linalg.norm(out, axis=1, keepdims=True)
    return out


def _wide(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] >= width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


# ---- splits ----------------------------------------------------------------------------------


class Splitter:
    """The splits of one node and of the nodes below it. Nodes are numbered; ``below`` holds the two
    children of a split, or -1 - leaf."""

    def __init__(self, directions: np.ndarray, low: np.ndarray, high: np.ndarray, below: np.ndarray, again: np.ndarray):
        self.directions, self.low, self.high, self.below, self.again = directions, low, high, below, again

    @classmethod
    def fit(cls, x: np.ndarray, share: float, seed: int) -> Splitter:
        """Splits of ``x``, a sample that holds ``share`` of the node, until a leaf's part of the node is
        about ``NODE`` vectors; ``again``: leaves that may need more splits than the sample can tell."""
        rng = np.random.default_rng(seed)
        directions, low, high, below, again = [], [], [], [], []

        def grow(rows: np.ndarray) -> int:
            large = len(rows) > share * NODE
            if not large or len(rows) < 16 or float(np.square(x[rows].mean(axis=0)).sum()) > TIGHT:
                again.append(large and len(rows) < 16)
                return -len(again)
            r = rng.standard_normal((DIRECTIONS, x.shape[1]))
            r /= np.linalg.norm(r, axis=1, keepdims=True)
            places = np.sort(x[rows] @ r.T, axis=0)
            wide = max(1, int(SPILL * len(rows)))
            a, b = len(rows) // 4, max(len(rows) // 4 + 1, 3 * len(rows) // 4 - wide)
            gaps = (places[a + wide : b + wide] - places[a:b]) / np.maximum(places[-1 - len(rows) // 20] - places[len(rows) // 20], 1e-300)
            at, which = np.unravel_index(np.argmax(gaps), gaps.shape)
            if not gaps[at, which] > 0:  # equal projections: nothing to split by
                again.append(False)
                return -len(again)
            me = len(low)
            directions.append(r[which])
            low.append(places[a + at, which])
            high.append(places[a + at + wide, which])
            below.append([0, 0])
            p = x[rows] @ r[which]
            for side, part in enumerate((rows[p < high[me]], rows[p > low[me]])):
                below[me][side] = grow(part)
            return me

        root = grow(np.arange(len(x)))
        if root < 0:
            return cls(np.zeros((0, x.shape[1])), np.zeros(0), np.zeros(0), np.zeros((0, 2), np.int64), np.array(again))
        return cls(np.array(directions), np.array(low), np.array(high), np.array(below), np.array(again))

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf): one pair for each leaf a vector goes to; ``low < p < high`` goes both ways."""
        if not len(self.low):
            return np.arange(len(x)), np.zeros(len(x), np.int64)
        rows, leaves, todo = [], [], [(0, np.arange(len(x)))]
        while todo:
            node, some = todo.pop()
            if not len(some):
                continue
            if node < 0:
                rows.append(some)
                leaves.append(np.full(len(some), -1 - node))
                continue
            p = x[some] @ self.directions[node]
            left = p < self.high[node]
            right = (p > self.low[node]) | ~left
            todo += [(int(self.below[node, 0]), some[left]), (int(self.below[node, 1]), some[right])]
        return (np.concatenate(rows), np.concatenate(leaves)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def pack(self) -> bytes:
        head = np.array([*self.directions.shape, len(self.again)], np.int64)
        return b"".join(np.ascontiguousarray(a, t).tobytes() for a, t in ((head, np.int64), (self.directions, np.float64), (self.low, np.float64), (self.high, np.float64), (self.below, np.int64), (self.again, np.int64)))

    @classmethod
    def unpack(cls, blob: bytes) -> Splitter:
        n, d, leaves = (int(v) for v in np.frombuffer(blob, np.int64, 3))
        at, out = 24, []
        for count, kind in ((n * d, np.float64), (n, np.float64), (n, np.float64), (2 * n, np.int64), (leaves, np.int64)):
            out.append(np.frombuffer(blob, kind, count, at))
            at += 8 * count
        return cls(out[0].reshape(n, d), out[1], out[2], out[3].reshape(n, 2), out[4].astype(bool))


def _code(parent: int, leaf: np.ndarray) -> np.ndarray:
    """Keys of the leaves of a node: 64-bit hashes. Two nodes with one key would be compared as one."""
    return mix(mix(np.full(len(leaf), parent, np.int64).view(np.uint64)) + leaf.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


# ---- the forest ------------------------------------------------------------------------------


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _round(placed: DataFrame, width: int, seed: int) -> DataFrame | None:
    """``placed`` (code, grows, id, x) with all nodes split that hold more than ``NODE`` vectors; None
    if there is none left."""
    sizes = placed.where("grows").groupBy("code").agg(F.count(F.lit(1)).alias("size"))
    large = _stored(sizes.where(F.col("size") > NODE), "forest_nodes")
    if large.isEmpty():
        return None
    kind = placed.schema["x"].dataType.simpleString()
    known = placed.join(large, "code", "left")
    drawn = F.pmod(F.xxhash64("id", "code", F.lit(seed)), F.lit(1 << 40)) < F.lit(SAMPLE) / F.col("size") * F.lit(1 << 40)
    sample = known.where(F.col("grows") & F.col("size").isNotNull() & drawn).select("code", "size", "x")

    def fit(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        code, size = group.column("code")[0].as_py(), group.column("size")[0].as_py()
        x = _wide(matrix(group.column("x").chunk(0)), width)
        blob = Splitter.fit(x, len(x) / size, (code ^ seed) & ((1 << 63) - 1)).pack()
        return pa.table({"code": pa.array([code], pa.int64()), "size": pa.array([size], pa.int64()), "blob": pa.array([blob], pa.binary())})

    fitted = sample.groupBy("code").applyInArrow(fit, "code long, size long, blob binary")
    salts = F.ceil(F.col("size") / F.lit(_ROUTED))
    none = F.lit(None)
    first = fitted.select("code", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.lit(0).alias("kind"), "blob", none.cast("long").alias("id"), none.cast(kind).alias("x"))
    moved = known.where(F.col("grows") & F.col("size").isNotNull())
    moved = moved.select("code", F.pmod(F.xxhash64("id", F.lit(seed + 1)), salts).alias("salt"), F.lit(1).alias("kind"), none.cast("binary").alias("blob"), "id", "x")

    def route(batches):
        now, splitter = None, None
        for batch in batches:
            codes, blobs = batch.column(0).to_numpy(), batch.column(3)
            cuts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(batch.column(2).to_numpy()) < 0)) + 1).tolist(), len(batch)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b and blobs[a].is_valid:
                    now, splitter, a = int(codes[a]), Splitter.unpack(blobs[a].as_py()), a + 1
                while a < b and blobs[a].is_valid:  # the same splitter for the next salt
                    a += 1
                if a == b:
                    continue
                if splitter is None or now != int(codes[a]):  # no vector was drawn: the node stays for the next round
                    rows, leaf, again = np.arange(b - a), np.full(b - a, int(codes[a]), np.int64), np.ones(b - a, bool)
                else:
                    rows, leaves = splitter.route(_wide(matrix(batch.column(5).slice(a, b - a)), width))
                    leaf, again = _code(now, leaves), splitter.again[leaves]
                some = batch.slice(a, b - a).take(pa.array(rows))
                yield pa.record_batch([pa.array(leaf, pa.int64()), pa.array(again, pa.bool_()), some.column(4), some.column(5)], names=["code", "grows", "id", "x"])

    dealt = first.union(moved).repartition("code", "salt").sortWithinPartitions("code", "salt", "kind")
    dealt = dealt.mapInArrow(route, f"code long, grows boolean, id long, x {kind}")
    return _stored(known.where(~F.col("grows") | F.col("size").isNull()).select("code", "grows", "id", "x").union(dealt), "forest_round")


def leaves(vectors: DataFrame, trees: int = TREES, seed: int = 42) -> DataFrame:
    """(code, id): the leaves of all trees for each of ``vectors`` (id, x), ids distinct."""
    width = vectors.agg(F.max(F.size("x"))).first()[0] or 0
    placed = vectors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long"))).alias("code"), F.lit(True).alias("grows"), "id", "x")
    turn = 0
    while (done := _round(placed, width, seed + turn)) is not None:
        placed, turn = done, turn + 1
    return placed.select("code", "id")


# ---- comparison ------------------------------------------------------------------------------


def _first_shared(codes: list[np.ndarray], code: int) -> tuple[np.ndarray, np.ndarray]:
    """(kind of each vector, new): vectors of one kind lie in the same leaves before ``code``;
    ``new[a, b]``: kinds a and b share none of them, so their pairs have not been met before."""
    kinds: dict[bytes, int] = {}
    of = np.array([kinds.setdefault(c[c < code].tobytes(), len(kinds)) for c in codes], np.int64)
    held = [np.frombuffer(k, np.int64) for k in kinds]
    new = np.ones((len(held), len(held)), bool)
    if held:
        leaf, kind = np.concatenate(held), np.repeat(np.arange(len(held)), [len(h) for h in held])
        order = np.argsort(leaf, kind="stable")
        for group in np.split(kind[order], np.flatnonzero(np.diff(leaf[order])) + 1):
            new[np.ix_(group, group)] = False
    return of, new


def compare(code: int, ids: np.ndarray, sizes: np.ndarray, x: np.ndarray, codes: list[np.ndarray], chunk: np.ndarray, cell: tuple[int, int], cosine: float, block: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, links, smallest id reached) of the vectors of one cell that link: within a chunk, or
    between the two chunks of the cell. Pairs that share an earlier leaf count there."""
    hits = []
    for a in range(0, len(ids), block):
        near = x[a : a + block] @ x.T >= cosine - _SLACK
        if cell[0] != cell[1]:
            near &= chunk[a : a + block, None] != chunk[None, :]
        near[np.arange(len(near)), a + np.arange(len(near))] = False
        hits.append(near)
    near = np.concatenate(hits)
    some = np.flatnonzero(near.any(axis=1))
    near = near[np.ix_(some, some)]
    ids, sizes = ids[some], sizes[some]
    kind, new = _first_shared([codes[i] for i in some], code)
    links, low = np.zeros(len(some), np.int64), ids.copy()
    for a in range(0, len(some), block):
        links[a : a + block] = (near[a : a + block] & new[kind[a : a + block]][:, kind]) @ sizes
    order = np.argsort(ids, kind="stable")
    near, rank = near[np.ix_(order, order)], np.arange(len(some))
    while True:  # smallest linked rank, until nothing moves
        before = rank
        for a in range(0, len(rank), block):
            least = np.where(near[a : a + block], rank[None, :], len(rank)).min(axis=1)
            rank = np.concatenate([rank[:a], np.minimum(rank[a : a + block], least), rank[a + block :]])
        rank = rank[rank]
        if (rank == before).all():
            break
    low[order] = ids[order][rank]
    return ids, links, low


def _cells(vectors: DataFrame, codes: DataFrame, cosine: float) -> DataFrame:
    """(id, links, low) of every cell; ``vectors`` (id, n, x), ``codes`` (code, id)."""
    sizes = codes.groupBy("code").agg(F.count(F.lit(1)).alias("size"))
    chunks = _stored(sizes.where(F.col("size") > CHUNK).select("code", F.ceil(F.col("size") / F.lit(CHUNK)).cast("int").alias("chunks")), "forest_chunks")
    parted = codes.join(chunks, "code", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    held = parted.groupBy("id").agg(F.collect_set(F.struct("code", "chunks")).alias("held"))  # some leaves per tree
    rows = vectors.join(held, "id").select("id", "n", "x", F.sort_array(F.transform("held", lambda h: h["code"])).alias("codes"), F.explode("held").alias("at"))
    rows = rows.select("id", "n", "x", "codes", F.col("at.code").alias("code"), F.col("at.chunks").alias("chunks"))
    own = F.pmod(F.xxhash64("id", F.lit(7)), F.col("chunks")).cast("int")
    rows = rows.withColumn("chunk", own)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    rows = rows.select("*", other).select("code", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"), "chunk", "id", "n", "x", "codes")

    def run(batches):
        def cell_of(batch, i):
            return tuple(batch.column(c)[i].as_py() for c in range(3))

        def met(key, parts):
            table = pa.Table.from_batches(parts).combine_chunks()
            if len(table) < 2:
                return None
            lists = table.column("codes").chunk(0)
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            codes_ = [values[a:b] for a, b in zip(offsets, offsets[1:])]
            found = compare(key[0], table.column("id").to_numpy(), table.column("n").to_numpy(), matrix(table.column("x").chunk(0)), codes_, table.column("chunk").to_numpy(), key[1:], cosine)
            return pa.record_batch([pa.array(f, pa.int64()) for f in found], names=["id", "links", "low"])

        now, parts = None, []
        for batch in batches:
            three = np.stack([batch.column(c).to_numpy() for c in range(3)]) if len(batch) else np.zeros((3, 0), np.int64)
            cuts = [0, *(np.flatnonzero((np.diff(three, axis=1) != 0).any(axis=0)) + 1).tolist(), len(batch)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                key = cell_of(batch, a)
                if key != now:
                    if parts and (out := met(now, parts)) is not None:
                        yield out
                    now, parts = key, []
                parts.append(batch.slice(a, b - a))
        if parts and (out := met(now, parts)) is not None:
            yield out

    return rows.repartition("code", "one", "two").sortWithinPartitions("code", "one", "two").mapInArrow(run, "id long, links long, low long")


# ---- the operator ----------------------------------------------------------------------------


def _valid(x: Column) -> Column:
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & fine & F.exists(x, lambda v: v != 0), F.lit(False))


def near_duplicates(rows: DataFrame, cosine: float = 0.9, trees: int = TREES, seed: int = 42, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per row of ``rows``."""
    x = F.col(vector_col)
    if rows.select(x).schema[0].dataType.simpleString() != "array<float>":
        x = x.cast("array<double>")
    all_rows = rows.select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
    takes_part = F.col("id").isNotNull() & _valid(F.col("x"))
    valid = all_rows.where(takes_part)
    classes = _stored(valid.groupBy("x").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")).withColumn("id", F.monotonically_increasing_id()), "forest_classes")
    found = _stored(_cells(classes.select("id", "n", "x"), leaves(classes.select("id", "x"), trees, seed), cosine), "forest_links")
    # ids of classes are numbers of their own (two classes may share their smallest row id)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    united = components(found.where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b")).distinct())
    linked = classes.join(links, "id", "left").join(united, "id", "left").withColumn("component", F.coalesce("component", "id"))
    lows = linked.groupBy("component").agg(F.min("low").alias("component_id"))
    linked = linked.join(lows, "component").select("x", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = valid.join(linked, "x").select("id", "n_links", "component_id")
    out = out.union(all_rows.where(~takes_part).select("id", F.lit(0).cast("long"), "id"))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
