"""Delimited scans with a declared schema.

Design notes (scale):
- One ``spark.read.csv`` call for any number of files, so a backfill of many dates is one
  scan split into ``maxPartitionBytes`` slices across the cluster, not a driver loop.
- The declared schema is applied by header name check (``enforceSchema=false``), so a
  reordered file fails loudly instead of silently shifting columns (E16).
- The effective date of each row comes from its file: one scan over all paths, whatever the number
  of dates. The file names, which Spark has listed, are matched once each against the whole
  template, globs included, and a row finds its date by its ``_metadata.file_path`` in that table
  (a broadcast join); a path that does not match is an error, never a wrong or empty date.
"""

from __future__ import annotations

import re
from datetime import date, datetime
from typing import Iterable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the date token that path templates carry, replaced by the date as YYYYMMDD.
DATE_TOKEN = "yyyymmdd"
# Text formats for timestamps in delimited files (microseconds kept, so a
# write/read round trip is exact).
TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


# A table of file names and dates up to this size is broadcast to the scan (some 300,000 files).
MAX_FILE_TABLE_BYTES = 64 << 20


class SourceMissingError(RuntimeError):
    """A declared source path does not exist (S3)."""


def to_spark_uri(path: str) -> str:
    """Object-store paths are read through the s3a connector."""
    if path.startswith("s3://"):
        return "s3a://" + path[len("s3://"):]
    return path


def _as_yyyymmdd(d: str | date | datetime) -> str:
    if isinstance(d, (date, datetime)):
        return d.strftime("%Y%m%d")
    text = str(d).strip()
    if re.fullmatch(r"\d{8}", text):
        return text
    return datetime.strptime(text[:10], "%Y-%m-%d").strftime("%Y%m%d")


def resolve_dated_path(template: str, effective_date: str | date, data_source_user: str | None = None) -> str:
    """Fill the date token (and an optional ``{data_source_user}``) into a path template."""
    if DATE_TOKEN not in template:
        raise ValueError(f"path template {template!r} has no {DATE_TOKEN} token")
    path = template.replace(DATE_TOKEN, _as_yyyymmdd(effective_date))
    if "{data_source_user}" in path:
        if data_source_user is None:
            raise ValueError("path template needs a data_source_user")
        path = path.replace("{data_source_user}", data_source_user)
    return to_spark_uri(path)


def _reader(spark: SparkSession, schema: T.StructType, sep: str, header: bool, corrupt_column: str | None, options):
    r = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT)
        .option("timestampFormat", TIMESTAMP_FORMAT)
    )
    if header:
        # Check header names against the declared schema instead of trusting position.
        r = r.option("enforceSchema", False)
    if corrupt_column:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def _unescaped(df: DataFrame, corrupt_column: str | None) -> DataFrame:
    def undo(name):
        # Escaped text holds no raw line end, and once the escaped backslashes are taken out (a
        # line end stands for each) a backslash only comes before n or r: both make room for
        # stand-ins that no text can contain.
        c = F.replace(F.col(f"`{name}`"), F.lit("\\\\"), F.lit("\n"))
        c = F.replace(F.replace(c, F.lit("\\r"), F.lit("\r")), F.lit("\n"), F.lit("\\b"))
        return F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\")).alias(name)

    return df.select(*[undo(f.name) if isinstance(f.dataType, T.StringType) and f.name != corrupt_column else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    *,
    dataset_id: str | None = None,
    corrupt_column: str | None = None,
    options: dict | None = None,
    escape_lines: bool = False,
) -> DataFrame:
    """Scan delimited file(s) with a declared schema. ``escape_lines`` undoes the escapes of
    ``write_delimited`` in string columns.

    ``corrupt_column`` (E17) adds a string column holding the raw line of rows whose
    fields do not parse; those rows keep nulls in the bad fields and can be counted by the
    quality rules instead of disappearing."""
    if isinstance(paths, str):
        paths = [paths]
    paths = [to_spark_uri(p) for p in paths]
    if not paths:
        raise SourceMissingError(f"no source files given for dataset {dataset_id}")
    if corrupt_column and corrupt_column not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType(), True)])
    try:
        exact = {"nullValue": "\\N"} if escape_lines else {}
        out = _reader(spark, schema, sep, header, corrupt_column, exact | dict(options or {})).csv(paths)
        return _unescaped(out, corrupt_column) if escape_lines else out
    except AnalysisException as e:  # S3: the reader lists files eagerly
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise SourceMissingError(f"dataset {dataset_id}: no source at {', '.join(paths)}") from e
        raise


def literal_path(path: str) -> str:
    """A path as the reader takes it literally: glob characters escaped."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def _glob_to_regex(component: str) -> str:
    """A Hadoop glob (``* ? [ab] [!ab] {a,b}``, backslash escapes) as a regex without slashes."""
    out, i, depth = [], 0, 0
    while i < len(component):
        c = component[i]
        if c == "\\" and i + 1 < len(component):
            i += 1
            out.append(re.escape(component[i]))
        elif c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[" and "]" in component[i + 1:]:
            end = component.index("]", i + 2) if component[i + 1: i + 2] in ("]", "!", "^") and "]" in component[i + 2:] else component.index("]", i + 1)
            body = component[i + 1: end]
            negated = body[:1] in ("!", "^")
            out.append(("[^/" if negated else "[") + (body[1:] if negated else body).replace("\\", "\\\\").replace("[", "\\[") + "]")
            i = end
        elif c == "{":
            out.append("(?:")
            depth += 1
        elif c == "}" and depth:
            out.append(")")
            depth -= 1
        elif c == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(c))
        i += 1
    return "".join(out)


def dated_path_regex(template: str) -> str:
    """Regex over a decoded file path: the whole template (without scheme and authority) with
    the date as group 1, and any files below it. A repeated date token must repeat the date."""
    path = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", to_spark_uri(template))
    parts = [x for x in path.split("/") if x not in ("", ".")]
    if not any(DATE_TOKEN in x for x in parts):
        raise ValueError(f"path template {template!r} has no {DATE_TOKEN} token")
    body = "/".join(DATE_TOKEN.join(_glob_to_regex(y) for y in x.split(DATE_TOKEN)) for x in parts)
    body = body.replace(DATE_TOKEN, "([0-9]{8})", 1).replace(DATE_TOKEN, "\\1")
    # an absolute path follows the scheme and authority, a relative one any folder
    start = "^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?/+" if path.startswith("/") else "^(?:.*/)?"
    return f"{start}{body}(?:/.*)?$"


def date_from_path_column(template: str, path: Column | None = None) -> Column:
    """The ISO effective date encoded in each row's source path (``_metadata.file_path``, which
    is URL-encoded). Fails on a path that does not match the template."""
    raw = path if path is not None else F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    day = F.regexp_extract(raw, dated_path_regex(template), 1)
    iso = F.concat_ws("-", day.substr(1, 4), day.substr(5, 2), day.substr(7, 2))
    wrong = F.raise_error(F.concat(F.lit(f"no effective date by template {template} in path "), raw)).cast("string")
    return F.when(day == "", wrong).otherwise(iso)


def read_dated_files(
    spark: SparkSession,
    template: str,
    dates: Iterable[str | date],
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    *,
    date_column: str | None = "effective_date",
    data_source_user: str | None = None,
    dataset_id: str | None = None,
    corrupt_column: str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """One scan over the files of several effective dates.

    With ``date_column`` set, the date of each row is taken from its file path and added
    as the last column (ISO ``yyyy-MM-dd`` string)."""
    dates = list(dates)
    paths = [resolve_dated_path(template, d, data_source_user) for d in dates]
    if not date_column:
        return read_delimited(spark, paths, schema, sep, header, dataset_id=dataset_id, corrupt_column=corrupt_column, options=options)
    if date_column in schema.fieldNames():
        raise ValueError(f"{date_column!r} is already a file column; pass date_column=None")
    df = read_delimited(spark, paths, schema, sep, header, dataset_id=dataset_id, corrupt_column=corrupt_column, options=options)
    if len({_as_yyyymmdd(d) for d in dates}) == 1:  # every path was resolved with this date
        day = _as_yyyymmdd(dates[0])
        return df.withColumn(date_column, F.lit(f"{day[:4]}-{day[4:6]}-{day[6:]}"))
    named = template.replace("{data_source_user}", data_source_user or "{data_source_user}")
    return with_date_of_file(df, named, date_column)


def with_date_of_file(df: DataFrame, template: str, date_column: str) -> DataFrame:
    """``df``, a scan of files, with the date in each row's path as the last column."""
    table = file_table(df.inputFiles(), template)
    if sum(len(path) + 32 for path, _ in table) > MAX_FILE_TABLE_BYTES:  # same dates, matched row by row
        return df.withColumn(date_column, date_from_path_column(template))
    files = df.sparkSession.createDataFrame(table, f"_file_path string, `{date_column}` string")
    out = df.join(F.broadcast(files), F.col("_metadata.file_path") == F.col("_file_path"), "left").drop("_file_path")
    # a name that is written in another way than listed is matched itself
    return out.withColumn(date_column, F.coalesce(F.col(f"`{date_column}`"), date_from_path_column(template)))


def file_table(paths: Iterable[str], template: str) -> list[tuple[str, str]]:
    """(path, ISO date) of files, each matched once against the whole template; a path without an
    authority in both its forms (``file:///a``, ``file:/a``)."""
    pattern = re.compile(dated_path_regex(template))
    out = []
    for path in paths:
        found = pattern.match(unquote(path))
        if not found:
            raise ValueError(f"no effective date by template {template} in path {unquote(path)}")
        day = found.group(1)
        for form in {path, re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):///", r"\1:/", path)}:
            out.append((form, f"{day[:4]}-{day[4:6]}-{day[6:]}"))
    return out
