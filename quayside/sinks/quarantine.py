"""Lines that do not parse go to a table of their own, in the one scan that loads the rest.

The batch is parsed once, into a staged folder split by whether the line parsed. The load then reads
the parsed rows from there, and the raw text of the others is kept, with the file it came from, in
the quarantine table: ``dataset_id, file, line, run_id`` by date. The load's dates are replaced as a
whole, so a rerun leaves no line twice, and a corrected file leaves none.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import scratch_path
from quayside.sinks.table import quote_table, write_table
from quayside.sources.catalog import table_exists

UNKNOWN_DATE = "unknown"  # of a line whose date did not parse
_FILE, _BAD = "_quayside_file", "_quayside_bad"


def stage_parsed(source: DataFrame, corrupt_column: str) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, without the raw line; ``file, line`` and the columns of the others)."""
    spark = source.sparkSession
    path = scratch_path(spark, "parsed")
    marked = source.select("*", F.col("_metadata.file_path").alias(_FILE), F.col(f"`{corrupt_column}`").isNotNull().alias(_BAD))
    marked.write.partitionBy(_BAD).parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in marked.schema.fields])
    back = spark.read.schema(schema).parquet(path)
    return back.where(~F.col(_BAD)).drop(corrupt_column, _FILE, _BAD), back.where(F.col(_BAD)).drop(_BAD)


def quarantine(spark: SparkSession, bad: DataFrame, table: str, dataset_id: str, corrupt_column: str, dates: Sequence[str], date_column: str = "effective_date", run_id: str | None = None) -> int:
    """Replaces the quarantined lines of ``dates``; the number of lines now there for them."""
    day = F.coalesce(F.col(f"`{date_column}`").cast("string"), F.lit(UNKNOWN_DATE)) if date_column in bad.columns else F.lit(str(dates[0]) if len(dates) == 1 else UNKNOWN_DATE)
    lines = bad.select(
        F.lit(dataset_id).alias("dataset_id"), F.col(_FILE).alias("file"), F.col(f"`{corrupt_column}`").alias("line"),
        F.lit(run_id or uuid.uuid4().hex).alias("run_id"), day.alias(date_column),
    )
    scratch = scratch_path(spark, "quarantine")
    lines.write.parquet(scratch)
    lines = spark.read.schema(lines.schema).parquet(scratch)
    held = {r[0] for r in lines.select(date_column).distinct().collect()}
    if table_exists(spark, table):
        for d in sorted({*map(str, dates), UNKNOWN_DATE} - held):  # dates that have no such lines any more
            spark.sql(f"ALTER TABLE {quote_table(table)} DROP IF EXISTS PARTITION (`{date_column}` = '{d}')")
    write_table(spark, lines, table, [date_column], "incremental")
    return lines.count()


def quarantined(spark: SparkSession, table: str, dates: Sequence[str], date_column: str = "effective_date") -> DataFrame:
    """The lines kept for some dates, and those without a date."""
    return spark.table(table).where(F.col(date_column).isin([*map(str, dates), UNKNOWN_DATE]))
