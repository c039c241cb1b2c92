"""Write a query result as delimited text (an extract for distribution).

The output "file" is a directory of part files written in parallel by the tasks that
hold the data; no ``coalesce(1)`` funnel through one task. A write split by columns
(one folder per date) is rebalanced on those columns first: without it every task writes
one file per date it holds (tasks x dates small files); with it AQE groups rows by date and
splits a hot date into advisory-size files.

Text round trips exactly: blanks at the ends of values are kept, quotes are doubled, and with
``escape_lines`` line ends and backslashes inside strings are written as ``\\n``, ``\\r`` and
``\\\\``, and nulls as ``\\N``, so that a record is one line, files stay splittable and an empty
string is no null. ``read_delimited`` undoes it under the same option."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sources.delimited import TIMESTAMP_FORMAT, TIMESTAMP_NTZ_FORMAT, to_spark_uri


def escaped(c: Column) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = "|",
    header: bool = True,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    rebalance: bool = True,
    escape_lines: bool = False,
) -> str:
    if escape_lines:
        df = df.select(*[escaped(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])
    if partition_by and rebalance:
        df = df.hint("rebalance", *[f"`{c}`" for c in partition_by])
    w = (
        df.write.mode(mode)
        .option("sep", sep)
        .option("header", header)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT)
        .option("timestampFormat", TIMESTAMP_FORMAT)
    )
    if escape_lines:
        w = w.option("nullValue", "\\N")
    if partition_by:
        w = w.partitionBy(*partition_by)
    out = to_spark_uri(path)
    w.csv(out)
    return out
