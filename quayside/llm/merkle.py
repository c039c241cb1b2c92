"""Merkle manifest of a dataset, its proofs made by a butterfly exchange.

Each row is a leaf, the hash of its fields. The leaves of one group (source), in the order of their
ids, are the lowest level of the group's tree; every ``fanout`` consecutive nodes become one hash
until one is left, the group's subroot. Subroots, in the order of their groups, likewise give the
root. H is lower-case hex sha256 over the concatenated inputs, digests as hex text.

Plan. Texts are hashed where they are read; what is shuffled are ids and digests. One range shuffle
sorts the leaves; ranks follow from the counts of the sorted partitions, so a group with a third of
all rows spans as many tasks as its share. Aligned blocks of ``fanout ** block_levels`` leaves are
the partitions of the exchange: each hashes its own subtree once. Then, round by round, the block p
swaps its subtree's root with the blocks whose number differs in one digit (base ``fanout``): of the
``fanout`` sibling subtrees, each member meets one member of each other. All hash the parent, the
same work in many places, and so all go on to the next round with it, and each keeps its siblings:
after the last round every block holds the proof from its root up to the top, and nothing has to be
sent down the tree. A subtree at the ragged end has fewer members than its siblings; its members
then serve several lanes each, so that no block is asked by many. A round is one shuffle of a row
per block, grouped by ``fanout`` at most.

Defined results: nulls count as ``-`` in a leaf; a null group is the first group; null ids come
first; rows that share an id ascend by their leaf, so equal rows may change places without a
trace; an empty text is a leaf like any other; other columns are ignored, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import scratch_path

FANOUT = 16
BLOCK_LEVELS = 3  # levels that a block hashes by itself: 4,096 leaves
_CHUNK = 1024  # blocks that meet one copy of their group's upper proof

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEPS = "array<struct<i:int,others:array<string>>>"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 bytes of the value, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _h(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---- ranks -----------------------------------------------------------------------------------


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (rank within ``tree``, from 0) and ``total`` (rows of the tree). Rows
    with equal keys are equal but for their place; it splits a key that many rows share."""
    spark = rows.sparkSession
    keys = ["tree", *order, "_place"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_place", F.monotonically_increasing_id())
    placed = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    placed = placed.drop("_place").withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    placed = _stored(placed, "merkle_sorted")
    runs = placed.groupBy("_part", "tree").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")
    before = F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("_part", "tree", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(tree).alias("total"))
    out = placed.join(runs, ["_part", "tree"])
    return out.withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_before")


# ---- the exchange ----------------------------------------------------------------------------


def swap(state: DataFrame, stride: int, fanout: int = FANOUT) -> DataFrame:
    """One round. ``state``: a row per block, (tree, p, blocks, root, proof), ``root`` being that of
    the subtree of ``stride`` blocks around p. Trees that have one node left stay as they are."""
    p, wide = F.col("p"), stride * fanout
    start = p - p % stride  # of the own subtree
    members = F.least(F.lit(stride).cast("long"), F.col("blocks") - start)
    lanes = F.least(F.lit(stride).cast("long"), F.col("blocks") - (p - p % wide))  # of the first, so widest, sibling
    sent = state.select(
        "tree", "blocks", F.floor(p / F.lit(wide)).alias("_group"), F.explode(F.sequence(p % stride, lanes - 1, members)).alias("_lane"),
        F.struct((F.floor(p / F.lit(stride)) % fanout).cast("int").alias("i"), "root", "p", "proof").alias("_one"),
    )
    met = sent.groupBy("tree", "blocks", "_group", "_lane").agg(F.sort_array(F.collect_list("_one")).alias("_all"))
    one = F.col("_one")
    met = met.select("tree", "blocks", "_lane", "_all", F.explode("_all").alias("_one")).where(one["p"] % stride == F.col("_lane"))
    above = F.sha2(F.array_join(F.transform("_all", lambda x: x["root"]), ""), 256)
    others = F.transform(F.filter("_all", lambda x: x["i"] != one["i"]), lambda x: x["root"])
    last = F.col("blocks") <= stride
    return met.select(
        "tree", one["p"].alias("p"), "blocks",
        F.when(last, one["root"]).otherwise(above).alias("root"),
        F.when(last, one["proof"]).otherwise(F.concat(one["proof"], F.array(F.struct(one["i"].alias("i"), others.alias("others"))))).alias("proof"),
    )


def exchange(state: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """All rounds: ``root`` becomes the tree's root, ``proof`` leads to it."""
    most = state.agg(F.max("blocks")).first()[0] or 0
    stride = 1
    while stride < most:
        state = swap(state, stride, fanout)
        stride *= fanout
    return state


# ---- blocks ----------------------------------------------------------------------------------


def block_levels(leaves: list[str], levels: int | None, fanout: int) -> list[list[str]]:
    """The levels of a block's own subtree, leaves first; ``levels`` None: until one node is left."""
    out = [leaves]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        now = out[-1]
        out.append([_h(now[a : a + fanout]) for a in range(0, len(now), fanout)])
    return out


def leaf_steps(levels: list[list[str]], i: int, fanout: int) -> Iterator[tuple[int, list[str]]]:
    """(place in its run, the run's others) of leaf ``i`` and its ancestors inside the block."""
    for nodes in levels[:-1]:
        a = i - i % fanout
        yield i - a, nodes[a:i] + nodes[i + 1 : a + fanout]
        i //= fanout


def fold(node: str, steps) -> str:
    """The root that a node and its siblings give."""
    for i, others in steps:
        node = _h([*others[:i], node, *others[i:]])
    return node


def _blocks(leaves: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """(a row per block with its sorted leaves; the proofs of blocks and groups up to the root)."""
    size = fanout**levels
    ranked = _ranked(_stored(leaves, "merkle_leaves"), ["doc_id", "leaf"])  # the range shuffle samples: texts are read once
    packed = ranked.groupBy("tree", F.floor(F.col("pos") / F.lit(size)).alias("p"), F.ceil(F.col("total") / F.lit(size)).alias("blocks")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "doc_id", "leaf", "changed"))).alias("leaves")
    )
    packed = _stored(packed, "merkle_blocks")

    def roots(batches):
        for batch in batches:
            found = [block_levels(row, None if b == 1 else levels, fanout)[-1][0] for b, row in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.record_batch([*batch.columns[:3], pa.array(found, pa.string())], names=["tree", "p", "blocks", "root"])

    hexes = F.transform("leaves", lambda x: F.lower(F.hex(x["leaf"])))
    state = packed.select("tree", "p", "blocks", hexes.alias("x")).mapInArrow(roots, "tree binary, p long, blocks long, root string")
    groups = _stored(exchange(state.withColumn("proof", F.array().cast(_STEPS)), fanout), "merkle_proofs")

    tops = _ranked(groups.where("p = 0").select(F.lit(b"").alias("tree"), F.col("tree").alias("group"), "root"), ["group"])
    tops = tops.select(F.struct("tree", "group").alias("key"), "pos", "total", "root")
    upper = exchange(tops.select(F.col("key.tree").alias("tree"), F.col("pos").alias("p"), F.col("total").alias("blocks"), "root", F.array().cast(_STEPS).alias("proof")), fanout)
    upper = upper.join(tops.select(F.col("key.group").alias("group"), F.col("pos").alias("p")), "p").select(F.col("group").alias("tree"), F.col("root").alias("top"), F.col("proof").alias("top_proof"))
    # a group's row meets its blocks in copies, one for each _CHUNK of them
    upper = upper.join(groups.where("p = 0").select("tree", "blocks"), "tree")
    upper = upper.select("tree", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / F.lit(_CHUNK)))).alias("_chunk"), "top", "top_proof")
    proofs = groups.withColumn("_chunk", F.floor(F.col("p") / F.lit(_CHUNK))).join(upper, ["tree", "_chunk"])
    return packed, proofs.select("tree", "p", F.col("root").alias("subroot"), "top", "proof", "top_proof")


def _leaves(docs: DataFrame, changed: Column | None, columns: list[str], id_col: str, group_col: str, text_col: str) -> DataFrame:
    values = [F.col(c) for c in columns]
    leaf = leaf_hash(*values)
    other = F.lit(None).cast("string")
    if changed is not None:
        other = F.when(changed, leaf_hash(*[F.translate(v.cast("string"), _UPPER, _LOWER) if c == text_col else v for c, v in zip(columns, values)]))
    # a group's key sorts as the group does, nulls first, and is never null
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).cast("binary")
    return docs.select(tree.alias("tree"), F.col(id_col).cast("long").alias("doc_id"), F.unhex(leaf).alias("leaf"), F.unhex(other).alias("changed"))


def manifest(
    docs: DataFrame, changed: Column | None = None, columns: tuple = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id", group_col: str = "source", text_col: str = "text", fanout: int = FANOUT, levels: int = BLOCK_LEVELS, steps: bool = True,
) -> DataFrame:
    """A row per row of ``docs``: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)
    and, with ``steps``, the proof itself: the place in each run and the run's others, from the
    leaf to the root. ``changed``: rows whose text counts as tampered with (A-Z lower-cased) when
    the proof is checked; ``folded_root`` is what the checked leaf and the siblings give."""
    packed, proofs = _blocks(_leaves(docs, changed, list(columns), id_col, group_col, text_col), fanout, levels)
    joined = packed.join(proofs, ["tree", "p"]).select("blocks", "leaves", "subroot", "top", "proof", "top_proof")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    if steps:
        names.append("steps")
        kinds.append(pa.list_(pa.struct([("i", pa.int32()), ("others", pa.list_(pa.string()))])))

    def run(batches):
        for batch in batches:
            for k in range(len(batch)):
                blocks, leaves, subroot, top, proof, top_proof = (batch.column(c)[k].as_py() for c in range(6))
                tree = block_levels([x["leaf"].hex() for x in leaves], None if blocks == 1 else levels, fanout)
                above = [(s["i"], s["others"]) for s in [*proof, *top_proof]]
                tail = "".join(h for _, others in above for h in others)
                rows = []
                for i, x in enumerate(leaves):
                    own = list(leaf_steps(tree, i, fanout))
                    leaf = x["leaf"].hex()
                    folded = fold(leaf if x["changed"] is None else x["changed"].hex(), [*own, *above])
                    row = (x["doc_id"], leaf, subroot, top, _h([*(h for _, others in own for h in others), tail]), folded, folded == top)
                    rows.append((*row, [{"i": a, "others": o} for a, o in [*own, *above]]) if steps else row)
                yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names)

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return joined.mapInArrow(run, schema + (f", steps {_STEPS}" if steps else ""))


def digest(docs: DataFrame, fanout: int = FANOUT, levels: int = BLOCK_LEVELS) -> DataFrame:
    """The manifest of ``documents``; the texts of rows whose id's crc32 5 divides are tampered with."""
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(docs, changed, fanout=fanout, levels=levels, steps=False)
