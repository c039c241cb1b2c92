"""K5 with a ledger: appends that a rerun repeats without effect.

An append of files to a table without partition keys cannot be replaced by a rerun, so it has to be
known. Each append is a batch in the hidden folder ``_ledger`` of the table's own location (so it
goes when the table is dropped or replaced):

    _ledger/<batch>/entry/   the files of the batch (path, length, time of change) and the run's id
    _ledger/<batch>/data/    its rows, staged by Spark's own committed write
    <batch>-part-...         the same files, published by renaming

1. Files that a finished entry names (same path, length and time) are left out; nothing new is
   nothing to do. A file that was written anew is a new file.
2. The entry, then the rows are written. When the rows' ``_SUCCESS`` is there, the batch is decided.
3. Its part files are renamed into the table. Names carry the batch, so this can be repeated.

A run that stops before the decision leaves a folder that nobody reads, and its files are new to the
next run; one that stops after it is finished by the next append (``recover_appends``) or by hand,
and its files are known. In both cases each row is in the table once. Readers may see a part of a
batch while it is published, as with Spark's own append. One writer per table at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.align import align_to_table
from quayside.session import fresh_name
from quayside.sinks.table import quote_table
from quayside.sources.catalog import table_columns, table_exists
from quayside.sources.delimited import to_spark_uri

FOLDER = "_ledger"
FILES_SCHEMA = "path string, length long, modified string"
ENTRY_SCHEMA = f"{FILES_SCHEMA}, run_id string, batch string"


@dataclass(frozen=True)
class AppendOutcome:
    table: str
    batch: str | None  # None: no new files
    files: int
    rows: int
    metrics: dict


def table_location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}").where("col_name = 'Location'").first()[1].rstrip("/")


class _Files:
    """The few file operations of a commit, on the table's own file system."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)))

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def rename(self, a: str, b: str) -> None:
        if not self._fs.rename(self._path(a), self._path(b)) and not self.exists(b):
            raise RuntimeError(f"could not rename {a} to {b}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def source_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The files under ``paths`` as ``FILES_SCHEMA``; their contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([to_spark_uri(p) for p in paths])
    return listed.select("path", "length", F.col("modificationTime").cast("string").alias("modified"))


def _decided(files: _Files, root: str) -> list[str]:
    return [b for b in files.names(f"{root}/{FOLDER}") if files.exists(f"{root}/{FOLDER}/{b}/data/_SUCCESS")]


def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    """Files that were appended: ``ENTRY_SCHEMA``."""
    root = table_location(spark, table)
    entries = [f"{root}/{FOLDER}/{b}/entry" for b in _decided(_Files(spark, root), root)]
    return spark.read.schema(ENTRY_SCHEMA).json(entries) if entries else spark.createDataFrame([], ENTRY_SCHEMA)


def _publish(files: _Files, root: str, batch: str) -> int:
    moved = 0
    for name in files.names(f"{root}/{FOLDER}/{batch}/data"):
        if name.startswith("part-"):
            files.rename(f"{root}/{FOLDER}/{batch}/data/{name}", f"{root}/{batch}-{name}")
            moved += 1
    return moved


def recover_appends(spark: SparkSession, table: str) -> int:
    """Publishes what decided batches have left and removes undecided ones; files moved."""
    root = table_location(spark, table)
    files = _Files(spark, root)
    decided, moved = set(_decided(files, root)), 0
    for batch in files.names(f"{root}/{FOLDER}"):
        if batch in decided:
            moved += _publish(files, root, batch)
        else:
            files.delete(f"{root}/{FOLDER}/{batch}")
    if moved:
        spark.catalog.refreshTable(table)
    return moved


_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}


def _typed(df: DataFrame, table_schema: T.StructType) -> DataFrame:
    """``df`` in the table's column order and types; only whole numbers are widened."""
    df = align_to_table(df, [f.name for f in table_schema.fields])
    out = []
    for have, want in zip(df.schema.fields, table_schema.fields):
        a, b = have.dataType, want.dataType
        if a != b and not (type(a) in _WIDTH and type(b) in _WIDTH and _WIDTH[type(a)] < _WIDTH[type(b)]):
            raise ValueError(f"column {want.name}: {a.simpleString()} cannot be appended to {b.simpleString()}")
        out.append(F.col(f"`{have.name}`").cast(b).alias(want.name))
    return df.select(*out)


def append_once(
    spark: SparkSession, table: str, files: DataFrame, read: Callable[[list[str]], DataFrame], run_id: str | None = None,
    observe: Callable[[DataFrame], DataFrame] | None = None,
) -> AppendOutcome:
    """Appends the rows of those of ``files`` (``FILES_SCHEMA``) that the ledger does not know.
    ``read`` gives the rows of some paths; ``observe`` wraps the frame right before the write. A
    table that does not exist is created by the first batch's schema."""
    run_id = run_id or uuid.uuid4().hex
    if table_exists(spark, table):
        if any(c.isPartition for c in spark.catalog.listColumns(table)):
            raise ValueError(f"{table} has partition keys: its loads replace partitions and need no ledger")
        recover_appends(spark, table)
        files = files.join(read_ledger(spark, table).select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")
    new = sorted({tuple(r) for r in files.select("path", "length", "modified").collect()})  # a name per new file, as Spark lists them
    if not new:
        return AppendOutcome(table, None, 0, 0, {})
    rows = read([p for p, _, _ in new])
    if not table_exists(spark, table):
        rows.limit(0).write.saveAsTable(table, format="parquet")
    root = table_location(spark, table)
    store = _Files(spark, root)
    batch = hashlib.sha256(repr(new).encode()).hexdigest()[:24]
    folder = f"{root}/{FOLDER}/{batch}"
    entry = spark.createDataFrame([(*f, run_id, batch) for f in new], ENTRY_SCHEMA)
    entry.coalesce(1).write.mode("overwrite").json(f"{folder}/entry")
    counted = Observation(fresh_name("append"))
    out = (observe or (lambda x: x))(rows)
    schema = spark.table(table).select(*table_columns(spark, table)).schema
    _typed(out, schema).observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{folder}/data")
    _publish(store, root, batch)
    spark.catalog.refreshTable(table)
    return AppendOutcome(table, batch, len(new), int(counted.get["n"]), {})


def published_rows(spark: SparkSession, table: str, batch: str) -> int:
    """Rows of a batch in the table, counted from its published files."""
    root = table_location(spark, table)
    parts = [f"{root}/{n}" for n in _Files(spark, root).names(root) if n.startswith(f"{batch}-")]
    return spark.read.schema(spark.table(table).schema).parquet(*parts).count() if parts else 0
