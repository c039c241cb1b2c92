"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a grouped minimum (combined before the shuffle) and a join of the edges with it. The
join deals edges by their node, so the edges of a hub meet in one task unless adaptive execution splits
that partition; they stream through it and are not gathered. The edges are written after each round:
that cuts the lineage, and a file scan packs the small files that many partitions leave into few tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.exchange import settle_driver
from quayside.session import scratch_path


def _stored(edges: DataFrame) -> DataFrame:
    path = scratch_path(edges.sparkSession, "components")
    edges.write.parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select("b", "a"))
    else:  # towards the smaller end only
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select("u", F.least("u", "m").alias("m"))
    out = both.join(low, "u")
    if large:
        out = out.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a long, b long): the smallest node that it
    reaches. Loops and repeated or reversed edges do not matter."""
    edges = _stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    mark = None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.sum(F.col("b") % 1_000_003)).first())
        if now == mark or not now[0]:
            break
        mark = now
        edges = _stored(_star(_star(edges, True), False))
    settle_driver(edges.sparkSession)
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
