"""G4 (b) by a hash tree: compare two large tables by fingerprints, and rows only where they differ.

Rows fall into buckets by the hash of their key. A bucket's fingerprint is its row count and the
summed pieces of two 64-bit hashes of its rows (key and compared columns), so equal multisets of
rows, and by all odds only they, have equal fingerprints. Buckets are the leaves of a tree: a
node's fingerprint is the sum of its ``FANOUT`` children's.

1. Each side is read once for the leaves: partial sums per task, one small row per bucket and task
   in the shuffle, whatever the key's skew. The tree is written, level by level. A side's tree can
   be kept (``hash_tree``) and compared later, or elsewhere, without its rows.
2. From the root down, only children of nodes that differ are compared.
3. Only rows of differing buckets are read again, by a semi-join, and compared key by key
   (``compare_keys``). Rows of equal buckets never reach that shuffle: where ``reconcile_rows``
   shuffles both tables, this shuffles what changed.

Defined results: as ``reconcile_rows``; null keys are keys like others; two empty sides have no
differences; repeated rows count as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.reconcile import Pair, compare_keys, hash_sums
from quayside.session import scratch_path

FANOUT_BITS = 6
FANOUT = 1 << FANOUT_BITS
LEAF_ROWS = 4096  # rows of a leaf's bucket, about
MAX_LEVELS = 5  # 2**30 buckets
# Differing buckets under this count (8 bytes each) are broadcast to the rows; above it the
# semi-join shuffles.
MAX_BROADCAST_BUCKETS = 1_000_000

_SUMS = ["n", *[f"{t}{at}" for t in ("a", "b") for at in (0, 22, 44)]]


@dataclass(frozen=True)
class HashTree:
    """The stored fingerprints of one side: a folder ``level=<l>`` for each level, 0 the root."""

    path: str
    levels: int

    def level(self, spark: SparkSession, level: int) -> DataFrame:
        return spark.read.schema("node long, " + ", ".join(f"{c} long" for c in _SUMS)).parquet(f"{self.path}/level={level}")


def levels_for(rows: int) -> int:
    """Levels below the root that give buckets of about ``LEAF_ROWS`` rows."""
    levels = 1
    while levels < MAX_LEVELS and rows > LEAF_ROWS << (FANOUT_BITS * levels):
        levels += 1
    return levels


def _bucketed(rows: DataFrame, pair: Pair, levels: int) -> DataFrame:
    key = F.xxhash64(F.lit(7), *[F.col(c) for c in pair.key_columns])
    return rows.withColumn("_bucket", F.shiftrightunsigned(key, 64 - FANOUT_BITS * levels))


def hash_tree(rows: DataFrame, pair: Pair, levels: int, path: str | None = None) -> HashTree:
    """Builds and stores the tree of one side of ``pair`` (``pair.source`` or ``pair.target``)."""
    spark = rows.sparkSession
    tree = HashTree(path or scratch_path(spark, "hash_tree"), levels)
    keyed = _bucketed(rows, pair, levels).select(
        F.col("_bucket").alias("node"),
        F.xxhash64(*[F.col(c) for c in pair.key_columns], F.col("_h1")).alias("_a"),
        F.xxhash64(F.lit(3), *[F.col(c) for c in pair.key_columns], F.col("_h2")).alias("_b"),
    )
    keyed.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *hash_sums("_a", "a"), *hash_sums("_b", "b")).write.parquet(f"{tree.path}/level={levels}")
    for level in range(levels - 1, -1, -1):
        below = tree.level(spark, level + 1).withColumn("node", F.shiftright("node", FANOUT_BITS))
        below.groupBy("node").agg(*[F.sum(c).alias(c) for c in _SUMS]).write.parquet(f"{tree.path}/level={level}")
    return tree


def differing_buckets(spark: SparkSession, one: HashTree, other: HashTree) -> DataFrame:
    """``node``: the leaves whose fingerprints differ. Each level reads the children of the nodes
    that differ above; equal subtrees are not looked at again."""
    if one.levels != other.levels:
        raise ValueError(f"trees of {one.levels} and {other.levels} levels cannot be compared")
    found: DataFrame | None = None
    for level in range(one.levels + 1):
        sides = [t.level(spark, level) for t in (one, other)]
        if found is not None:
            above = found.withColumnRenamed("node", "_above")
            sides = [s.join(above, F.shiftright("node", FANOUT_BITS) == F.col("_above"), "left_semi") for s in sides]
        a, b = sides[0].alias("a"), sides[1].alias("b")
        same = F.lit(True)
        for c in _SUMS:
            same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        differ = a.join(b, F.col("a.node") == F.col("b.node"), "full_outer").where(~same).select(F.coalesce("a.node", "b.node").alias("node"))
        path = scratch_path(spark, "hash_tree_differs")
        differ.write.parquet(path)
        found = spark.read.schema("node long").parquet(path)
        if found.isEmpty():
            break
    return found


def rows_of(rows: DataFrame, pair: Pair, levels: int, buckets: DataFrame, broadcast: bool) -> DataFrame:
    """The rows of one side that lie in ``buckets``."""
    side = F.broadcast(buckets) if broadcast else buckets
    keyed = _bucketed(rows, pair, levels)
    return keyed.join(side, keyed["_bucket"] == side["node"], "left_semi").drop("_bucket")


def reconcile_tree(source: DataFrame, target: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None, levels: int | None = None) -> DataFrame:
    """``reconcile_rows`` by a hash tree: ``<keys>, status``. ``levels`` is taken from the source's
    row count where it is not given."""
    spark = source.sparkSession
    pair = Pair(source, target, keys, compare)
    if levels is None:
        levels = levels_for(source.count())
    buckets = differing_buckets(spark, hash_tree(pair.source, pair, levels), hash_tree(pair.target, pair, levels))
    small = buckets.count() <= MAX_BROADCAST_BUCKETS
    return compare_keys(pair, rows_of(pair.source, pair, levels, buckets, small), rows_of(pair.target, pair, levels, buckets, small))
