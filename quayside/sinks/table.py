"""K1-K9: the load-mode decision table.

| table   | load_type   | keys | action                                                     |
| ------- | ----------- | ---- | ---------------------------------------------------------- |
| absent  | any valid   | yes  | create, partitioned by keys (keys move last)          (K2) |
| absent  | any valid   | no   | create                                                (K3) |
| present | incremental | yes  | replace only the partitions in the batch              (K4) |
| present | incremental | no   | append (a rerun duplicates)                           (K5) |
| present | full        | yes  | replace table, schema and partitioning                (K6) |
| present | full        | no   | replace table and schema                              (K7) |
| any     | other       | any  | ValueError before any job runs                        (K8) |

Safety choices:
- K4 must replace only the batch's partitions; with Spark's default (static) the same call
  erases every other partition (E4). Partitioned tables created here carry the table option
  ``partitionOverwriteMode=dynamic``, so no session setting is touched; for a partitioned
  table created elsewhere the session setting is switched around the write and restored.
- K6/K7 write the new table under a staging name first; the old table is replaced only
  after that write committed, so a failing write leaves the old table whole (E14). A run that
  stops between the drop and the rename is finished by the next write (``recover_table``).
- No shuffle is added before a write by default: each task writes the partitions it holds
  (right for a one-date load). ``rebalance=True`` clusters rows by the keys for many-date
  loads, with AQE splitting a hot date over several writers.
"""

from __future__ import annotations

import logging
from contextlib import contextmanager
from typing import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quayside.operators.align import align_to_table
from quayside.session import fresh_name
from quayside.sources.catalog import table_columns, table_exists
from quayside.spec import LOAD_TYPES

log = logging.getLogger(__name__)

_OVERWRITE_CONF = "spark.sql.sources.partitionOverwriteMode"
_OVERWRITE_OPTION = "partitionOverwriteMode"


@dataclass(frozen=True)
class WriteOutcome:
    table: str
    action: str  # create_partitioned, create_unpartitioned, partition_overwrite, append, full_overwrite_partitioned, full_overwrite
    idempotent: bool


def check_load_type(load_type: str) -> None:
    """K8 (and E5: also checked when the table does not exist yet)."""
    if load_type not in LOAD_TYPES:
        raise ValueError(
            f"load_type {load_type!r} is none of {LOAD_TYPES}"
        )


def ensure_database(spark: SparkSession, database: str, warehouse_path: str | None = None) -> None:
    """K1: ``CREATE DATABASE IF NOT EXISTS`` (under ``<warehouse>/<database>`` when given)."""
    if warehouse_path:
        spark.sql(
            "CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db) LOCATION :loc",
            args={"db": database, "loc": f"{warehouse_path.rstrip('/')}/{database}"},
        )
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": database})


@contextmanager
def _session_conf(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


# Partition values that one writer opens files for in a write of known, many values.
VALUES_PER_WRITER = 64


@contextmanager
def _many_writers(spark: SparkSession, rebalance: bool, values: int | None):
    """AQE packs rebalanced rows by bytes alone: thousands of small dates would go to one writer,
    which opens and closes their files one by one. For a write of that many values it only splits."""
    if rebalance and values and values > VALUES_PER_WRITER:
        with _session_conf(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
            yield
    else:
        yield


def _clustered(df: DataFrame, keys: list[str], rebalance: bool, values: int | None = None) -> DataFrame:
    if not keys or not rebalance:
        return df
    if values and values > VALUES_PER_WRITER:
        return df.hint("rebalance", -(-values // VALUES_PER_WRITER), *keys)
    # REBALANCE: rows of one partition value go to the same writer where sizes allow, and
    # AQE splits a hot value into advisory-size pieces (spark.sql.adaptive.*), so a
    # many-date load writes few files per date without funnelling a hot date to one task.
    return df.hint("rebalance", *keys)


def quote_table(table: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in table.split("."))


def _create(df: DataFrame, table: str, keys: list[str], mode: str = "errorifexists") -> None:
    w = df.write
    if keys:
        # Stored with the table: every later INSERT OVERWRITE into it (ours or anyone's)
        # replaces only the partitions it writes, whatever the session setting.
        w = w.option(_OVERWRITE_OPTION, "dynamic")
    w.saveAsTable(table, format="parquet", mode=mode, partitionBy=keys or None)


def _dynamic_by_table(spark: SparkSession, table: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}").where("col_name = 'Storage Properties'").collect()
    return bool(rows) and f"{_OVERWRITE_OPTION}=dynamic" in rows[0][1].replace(" ", "")


_REPLACES = "quayside.replaces"


def recover_table(spark: SparkSession, table: str) -> bool:
    """Finishes a replacement that stopped between dropping the old table and renaming the new
    one: if ``table`` is missing and a complete staging table of it exists, that one becomes it."""
    if spark.catalog.tableExists(table):
        return False
    db, _, name = table.rpartition(".")
    if db and not spark.catalog.databaseExists(db):
        return False
    pattern = f"{name.lower()}__staging_*"
    found = [t.name for t in spark.catalog.listTables(db or None, pattern)]
    for staging in sorted(found):
        full = (f"{db}." if db else "") + staging
        props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quote_table(full)}").collect()}
        if props.get(_REPLACES, "").lower() == table.lower():
            keys = [c.name for c in spark.catalog.listColumns(full) if c.isPartition]
            log.warning("%s is missing; its complete replacement %s takes its name", table, full)
            _rename(spark, full, table, keys)
            return True
    return False


def _rename(spark: SparkSession, staging: str, table: str, keys: list[str]) -> None:
    spark.sql("ALTER TABLE IDENTIFIER(:a) RENAME TO IDENTIFIER(:b)", args={"a": staging, "b": table})
    spark.sql(f"ALTER TABLE {quote_table(table)} UNSET TBLPROPERTIES IF EXISTS ('{_REPLACES}')")
    if keys:
        # Re-list the partitions from the renamed directory (see below).
        spark.sql(f"MSCK REPAIR TABLE {quote_table(table)} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def _swap_in(spark: SparkSession, df: DataFrame, table: str, keys: list[str]) -> None:
    """Write under a staging name first; only once that write committed is the old table
    dropped and the staging table renamed. A failing write leaves the old table whole and drops
    its staging table. Between the drop and the rename the table is missing; a run that stops
    there is finished by ``recover_table``, which every later write calls first.

    The old table is dropped rather than renamed away: a rename moves the directory but
    keeps the catalog's partition paths, and dropping a renamed partitioned table would
    delete whatever now sits at those paths."""
    db, _, name = table.rpartition(".")
    staging = (f"{db}." if db else "") + fresh_name(f"{name}__staging")
    try:
        _create(df, staging, keys)
    except Exception:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": staging})
        raise
    spark.sql(f"ALTER TABLE {quote_table(staging)} SET TBLPROPERTIES ('{_REPLACES}' = '{table}')")  # complete
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": table})
    _rename(spark, staging, table, keys)


def write_table(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    partition_keys: list[str] | tuple[str, ...] = (),
    load_type: str = "incremental",
    *,
    rebalance: bool = False,
    observe: Callable[[DataFrame], DataFrame] | None = None,
    values: int | None = None,
) -> WriteOutcome:
    """Write ``df`` into ``table`` following the decision table above.

    ``values``: how many partition values the batch holds, if known; a rebalanced write of many
    gets a writer for each ``VALUES_PER_WRITER`` at least (a hot value is still split).

    ``observe`` wraps the frame right before ``.write`` (after any rebalance shuffle), so
    observed metrics live in the write's result stage, where Spark applies each task's
    metrics once even when tasks or stages are retried after an executor loss."""
    check_load_type(load_type)
    watch = observe or (lambda x: x)
    keys = list(partition_keys or ())
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"partition keys {missing} are not columns of the batch")

    with _many_writers(spark, rebalance, values):
        return _write(spark, df, table, keys, load_type, rebalance, watch, values)


def _write(spark, df, table, keys, load_type, rebalance, watch, values) -> WriteOutcome:
    recover_table(spark, table)
    if not table_exists(spark, table):
        _create(watch(_clustered(df, keys, rebalance, values)), table, keys)
        spark.catalog.refreshTable(table)  # K9
        return WriteOutcome(table, "create_partitioned" if keys else "create_unpartitioned", True)

    if load_type == "incremental":
        cols = table_columns(spark, table)
        align_to_table(df, cols)  # P1: fail on a missing column before any job runs
        if keys:
            out = align_to_table(watch(_clustered(df, keys, rebalance, values)), cols)
            if _dynamic_by_table(spark, table):
                out.write.insertInto(table, overwrite=True)
            else:  # a table created elsewhere: dynamic mode for this write only
                with _session_conf(spark, _OVERWRITE_CONF, "dynamic"):
                    out.write.insertInto(table, overwrite=True)
            return WriteOutcome(table, "partition_overwrite", True)
        log.warning("Appending to %s: a rerun of the same batch loads duplicates.", table)
        align_to_table(watch(df), cols).write.insertInto(table)
        return WriteOutcome(table, "append", False)

    _swap_in(spark, watch(_clustered(df, keys, rebalance, values)), table, keys)
    return WriteOutcome(table, "full_overwrite_partitioned" if keys else "full_overwrite", True)
