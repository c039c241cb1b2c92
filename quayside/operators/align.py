"""Align a batch to the target table's column order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_to_table(df: DataFrame, table_columns: list[str]) -> DataFrame:
    """Select the table's columns in table order (partition keys last). Extra batch
    columns are dropped; a missing one raises (Spark's UNRESOLVED_COLUMN). Name matching
    follows ``spark.sql.caseSensitive`` (insensitive by default)."""
    return df.select([F.col(f"`{c}`") for c in table_columns])
