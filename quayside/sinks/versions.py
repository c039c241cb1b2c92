"""K7 without a gap: a full replacement as a new version folder and one catalog call.

A versioned table is external; its location is one folder of ``<table folder>_versions``:

1. The batch is written to a new folder by Spark's own committed write (``_SUCCESS``).
2. ``ALTER TABLE .. SET LOCATION`` points the table at it. Before that call readers see the old
   version, after it the new one; the table is never missing, and nothing is renamed or copied.
3. The newest ``keep`` committed folders stay, so that running readers and ``roll_back`` have
   them; older ones, and folders of runs that stopped, go.

A run that stops before the second step leaves the old version in place and a folder that nobody
reads; one that stops after it leaves old folders to the next replacement. Folders newer than the
shown version (of stopped runs, or left by ``roll_back``) go before the next write, so the earlier
versions are those that the table has shown. Folders found when the table is created (it was
dropped, or its creation stopped) count as earlier versions. One writer per table.

The call switches one location, not columns or catalogued partitions, so versioned tables are
unpartitioned and keep their columns: a batch with other columns or types is an error before
any job runs. Tables that need these changes are replaced by ``write_table``.
An empty batch makes an empty version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.operators.align import align_to_table
from quayside.session import fresh_name
from quayside.sinks.ledger import _Files, table_location
from quayside.sinks.table import WriteOutcome, quote_table
from quayside.sources.catalog import partition_columns, table_columns, table_exists

FOLDER = "_versions"


def _database_location(spark: SparkSession, database: str) -> str:
    rows = spark.sql("DESCRIBE DATABASE IDENTIFIER(:db)", args={"db": database}).collect()
    return next(r[1] for r in rows if r[0] == "Location").rstrip("/")


def versions(spark: SparkSession, table: str) -> list[str]:
    """Folders of the committed versions, oldest first."""
    root = table_location(spark, table).rpartition("/")[0]
    files = _Files(spark, root)
    return [f"{root}/{v}" for v in files.names(root) if files.exists(f"{root}/{v}/_SUCCESS")]


def _check(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    if not table_location(spark, table).rpartition("/")[0].endswith(FOLDER):
        raise ValueError(f"{table} is no versioned table")
    if partition_columns(spark, table):
        raise ValueError(f"{table} is partitioned: its partitions cannot be switched in one call")
    have = {f.name.lower(): f.dataType for f in spark.table(table).schema}
    new = {f.name.lower(): f.dataType for f in df.schema}
    if have != new:
        raise ValueError(f"columns of the batch differ from {table}: {sorted(set(have.items()) ^ set(new.items()), key=str)}")
    return align_to_table(df, table_columns(spark, table))


def _switch(spark: SparkSession, table: str, folder: str) -> None:
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {quote_table(table)} SET LOCATION '{place}'")
    spark.catalog.refreshTable(table)


def replace_version(spark: SparkSession, df: DataFrame, table: str, keep: int = 2) -> WriteOutcome:
    """Replaces ``table`` (``database.name``) by ``df``; creates it if it is absent."""
    if keep < 1:
        raise ValueError("keep is at least 1: the version that the table shows")
    database, _, name = table.rpartition(".")
    present = table_exists(spark, table)
    if present:
        df = _check(spark, df, table)
        root, _, shown = table_location(spark, table).rpartition("/")
        files = _Files(spark, root)
        for newer in (v for v in files.names(root) if v > shown):
            files.delete(f"{root}/{newer}")
    else:
        root = f"{_database_location(spark, database or spark.catalog.currentDatabase())}/{name}{FOLDER}"
        shown = max(_Files(spark, root).names(root), default="v0")
    folder = f"{root}/{fresh_name(f'v{int(shown.split('_')[0][1:]) + 1:010d}')}"
    df.write.parquet(folder)
    if present:
        _switch(spark, table, folder)
    else:
        spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)
    _expire(spark, table, keep)
    return WriteOutcome(table, "version_replaced" if present else "version_created", True)


def _expire(spark: SparkSession, table: str, keep: int) -> None:
    shown = table_location(spark, table)
    root, _, current = shown.rpartition("/")
    files, stay = _Files(spark, root), {v.rpartition("/")[2] for v in versions(spark, table)[-keep:]} | {current}
    for name in files.names(root):
        if name not in stay:
            files.delete(f"{root}/{name}")


def roll_back(spark: SparkSession, table: str) -> str:
    """Points ``table`` at the version before the one it shows; returns that folder."""
    found = versions(spark, table)
    at = found.index(next(v for v in found if v.endswith(table_location(spark, table).rpartition("/")[2])))
    if not at:
        raise ValueError(f"{table} has no earlier version")
    _switch(spark, table, found[at - 1])
    return found[at - 1]
