"""Lineage as an edge table.

Each run appends edges ``workflow_id, task_id, source_dataset, target_dataset,
effective_date, row_count, run_id, status`` to a catalog table (the row counts come from the
load's own observed metrics, so an edge also says how much data moved; a run that failed or was
skipped leaves an edge with that status). Traversal up- or downstream iterates joins over the
distinct edges that moved data until no new dataset appears.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import checkpoint_root
from quayside.sinks.table import write_table

EDGE_COLUMNS = ["workflow_id", "task_id", "source_dataset", "target_dataset", "effective_date", "row_count", "run_id", "status"]


def edges_from_counts(counts: DataFrame, workflow_id: str, task_id: str, source: str, target: str, run_id: str, status: str = "ok") -> DataFrame:
    """Edges of one task from a per-date count frame ``(effective_date, <count>)``."""
    count_col = [c for c in counts.columns if c != "effective_date"][0]
    return counts.select(
        F.lit(workflow_id).alias("workflow_id"), F.lit(task_id).alias("task_id"),
        F.lit(source).alias("source_dataset"), F.lit(target).alias("target_dataset"),
        F.col("effective_date").cast("string").alias("effective_date"),
        F.col(count_col).cast("long").alias("row_count"), F.lit(run_id).alias("run_id"), F.lit(status).alias("status"),
    )


def record_lineage(spark: SparkSession, edges: DataFrame, table: str) -> None:
    """Append the run's edges (the table is created on first use)."""
    write_table(spark, edges.select(*EDGE_COLUMNS), table, (), "incremental")


def traverse(spark: SparkSession, table: str, start: str, direction: str = "downstream") -> DataFrame:
    """Datasets reachable from ``start``: ``dataset, depth`` (smallest depth per dataset). Each
    step joins the datasets found last with the edges and keeps those not seen before; it ends
    when there are none, whatever the length of a chain, and cycles end it as well."""
    if direction == "downstream":
        near, far = "source_dataset", "target_dataset"
    elif direction == "upstream":
        near, far = "target_dataset", "source_dataset"
    else:
        raise ValueError("direction must be 'downstream' or 'upstream'")
    checkpoint_root(spark)
    # one row per pair of datasets, not per run and date
    edges = spark.table(table).where(F.col("status") == "ok").select(F.col(near).alias("near"), F.col(far).alias("dataset")).distinct().checkpoint()
    last = edges.where(F.col("near") == start).select("dataset", F.lit(1).cast("long").alias("depth")).checkpoint()
    found, depth = last, 1
    while not last.isEmpty():
        depth += 1
        step = edges.join(last.select(F.col("dataset").alias("near")), "near").select("dataset").distinct()
        last = step.join(found.select("dataset"), "dataset", "left_anti").select("dataset", F.lit(depth).cast("long").alias("depth")).checkpoint()
        found = found.union(last).checkpoint()
    return found
