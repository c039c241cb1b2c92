"""A SQL text file as the source of a dataset."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from quayside.sources.delimited import to_spark_uri


def read_sql_text(spark: SparkSession, path: str) -> str:
    """The query text. Local files are read directly; other URIs through Spark."""
    if "://" not in path or path.startswith("file://"):
        return Path(path.replace("file://", "")).read_text()
    rows = spark.read.text(to_spark_uri(path), wholetext=True).take(1)
    if not rows:
        raise RuntimeError(f"SQL file {path} is empty")
    return rows[0][0]


def read_sql_file(spark: SparkSession, path: str, args: dict | None = None) -> DataFrame:
    """Run the query in ``path``; named parameters (``:name``) are bound from ``args``."""
    text = read_sql_text(spark, path).strip().rstrip(";")
    return spark.sql(text, args=args or None)
