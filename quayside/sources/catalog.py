"""Catalog table scans and lookups (``spark.catalog``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def table_columns(spark: SparkSession, table: str) -> list[str]:
    """Column names in table order (partition keys last)."""
    return [c.name for c in spark.catalog.listColumns(table)]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def read_table(spark: SparkSession, table: str, effective_date: str | None = None, date_column: str = "effective_date") -> DataFrame:
    """S8 with P2/P3: ``SELECT * FROM t [WHERE effective_date = d]``.

    The equality on a partition column prunes the scan to one partition directory."""
    df = spark.table(table)
    if effective_date is not None:
        df = df.where(F.col(date_column) == F.lit(effective_date))
    return df
