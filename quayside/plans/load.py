"""Load dated delimited file(s) into a catalog table and prove the load.

schema (S4) -> one scan (S1/S5) -> database (K1) -> observed write (K2-K7) ->
per-date compare (A3). The only data that reaches the driver is one row of observed
metrics and the per-date report (one row per date of the batch)."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.functions.schema import column_spec_to_schema
from quayside.operators.state import update_state
from quayside.operators.validate import REPORT_SCHEMA, SourceCounter, sample_loaded, validate_load
from quayside.session import fresh_name
from quayside.sinks.ledger import append_once, published_rows, source_files
from quayside.sinks.quarantine import quarantine, stage_parsed
from quayside.sinks.table import check_load_type, ensure_database, write_table
from quayside.sources.delimited import (
    DATE_TOKEN, SourceMissingError, literal_path, read_dated_files, read_delimited, resolve_dated_path, to_spark_uri, with_date_of_file,
)
from quayside.sources.sqlfile import read_sql_file
from quayside.spec import LoadSpec

log = logging.getLogger(__name__)


class LoadMismatchError(RuntimeError):
    pass


@dataclass
class LoadResult:
    table: str
    action: str
    source_count: int
    target_count: int
    status: int  # 0 = every date matched, 1 = at least one mismatch
    report: DataFrame  # (effective_date, source_count, target_count, is_match)
    report_rows: list
    source_paths: list
    corrupt_count: int = 0  # rows whose fields did not parse (E17; with LoadSpec.corrupt_column)
    metrics: dict = field(default_factory=dict)  # every metric observed during the write


def source_frame(spark: SparkSession, spec: LoadSpec) -> tuple[DataFrame, list[str]]:
    """The batch as a typed frame, and the paths it reads."""
    src = spec.source
    if src.kind == "delimited":
        schema = column_spec_to_schema(spec.columns, parity=spec.parity)
        if not src.path_template:
            raise ValueError(f"dataset {src.dataset_id} has no path template")
        file_dates = spec.source_dates if spec.source_dates is not None else spec.effective_dates
        if spec.source_dates is not None and spec.date_from_path:
            raise ValueError("source_dates and date_from_path exclude each other")
        if DATE_TOKEN in src.path_template:
            paths = [resolve_dated_path(src.path_template, d, src.data_source_user) for d in file_dates]
        else:  # one literal path
            paths = [to_spark_uri(src.path_template)]
        if spec.date_from_path:
            df = read_dated_files(
                spark, src.path_template, spec.effective_dates, schema, src.delimiter, src.header,
                date_column=spec.date_column, data_source_user=src.data_source_user, dataset_id=src.dataset_id,
                corrupt_column=spec.corrupt_column, options=dict(src.options),
            )
        else:
            df = read_delimited(spark, paths, schema, src.delimiter, src.header, dataset_id=src.dataset_id,
                                corrupt_column=spec.corrupt_column, options=dict(src.options))
        return df, paths
    if src.kind == "table":
        return spark.table(src.table.qualified), [src.table.qualified]
    if src.kind == "sql_file":
        return read_sql_file(spark, src.sql_path), [src.sql_path]
    raise RuntimeError(f"dataset {src.dataset_id}: cannot read a source of kind {src.kind!r}")


def _append_by_ledger(spark: SparkSession, spec: LoadSpec, source: DataFrame | None, extra_metrics: Sequence[Column], files: DataFrame | None = None) -> LoadResult:
    """K5 for files that the target's ledger does not name yet; ``files`` are the landed files (all
    of the spec's dates by default)."""
    if source is not None or spec.source.kind != "delimited" or spec.load_type != "incremental" or spec.target.partition_keys:
        raise ValueError("a ledger needs an incremental load of delimited files into a table without partition keys")
    src = spec.source
    if files is None:
        named = spec.source_dates if spec.source_dates is not None else spec.effective_dates
        paths = [resolve_dated_path(src.path_template, d, src.data_source_user) for d in named] if DATE_TOKEN in src.path_template else [to_spark_uri(src.path_template)]
        try:
            files = source_files(spark, paths)
        except AnalysisException as e:  # S3
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                raise SourceMissingError(f"dataset {src.dataset_id}: no source at {', '.join(paths)}") from e
            raise
    else:
        paths = [src.path_template]
    ensure_database(spark, spec.target.database, spec.warehouse_path)
    table = spec.target.qualified
    schema = column_spec_to_schema(spec.columns, parity=spec.parity)

    def read(some: list[str]) -> DataFrame:
        df = read_delimited(spark, [literal_path(p) for p in some], schema, src.delimiter, src.header, dataset_id=src.dataset_id,
                            corrupt_column=spec.corrupt_column, options=dict(src.options))
        named = src.path_template.replace("{data_source_user}", src.data_source_user or "{data_source_user}")
        return with_date_of_file(df, named, spec.date_column) if spec.date_from_path else df

    observation = Observation(fresh_name("append_counts"))

    def observed(df: DataFrame) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("total"), *extra_metrics]
        if spec.corrupt_column:
            aggs.append(F.count_if(F.col(spec.corrupt_column).isNotNull()).alias("corrupt_rows"))
        df = df.observe(observation, *aggs)
        return df.drop(spec.corrupt_column) if spec.corrupt_column else df

    def read_rows(some: list[str]) -> DataFrame:
        if not spec.quarantine_table:
            return read(some)
        good, bad = stage_parsed(read(some), spec.corrupt_column)
        dropped.append(quarantine(spark, bad, spec.quarantine_table, src.dataset_id, spec.corrupt_column, spec.effective_dates, spec.date_column))
        return good.withColumn(spec.corrupt_column, F.lit(None).cast("string"))

    dropped: list[int] = []
    done = append_once(spark, table, files, read_rows, observe=observed)
    metrics = dict(observation.get) if done.batch else {}
    src_n = int(metrics.get("total", 0))
    tgt_n = published_rows(spark, table, done.batch) if done.batch else 0
    report = spark.createDataFrame([(None, src_n, tgt_n, src_n == tgt_n)], REPORT_SCHEMA)
    status = 0 if src_n == tgt_n else 1
    log.info("%s: %d new files, %d rows appended.", table, done.files, tgt_n)
    if status and spec.strict:
        raise LoadMismatchError(f"{table}: count mismatch")
    corrupt_n = dropped[0] if dropped else int(metrics.get("corrupt_rows", 0))
    return LoadResult(table, "append" if done.batch else "append_known", src_n, tgt_n, status, report, report.collect(), paths, corrupt_n, metrics)


def append_files(spark: SparkSession, spec: LoadSpec, files: DataFrame) -> LoadResult:
    """Appends those of the landed ``files`` (path, length, modified) that the ledger does not name."""
    return _append_by_ledger(spark, spec, None, (), files)


def run_ingestion_task(spark: SparkSession, spec: LoadSpec, task_id: str | None = None) -> tuple[int, dict]:
    """run one load and return ``(status_code, result)`` with the real counts."""
    res = load_to_table(spark, spec)
    # The result's keys.
    return res.status, {
        "ingestion task id": task_id or spec.target.dataset_id or spec.target.qualified,
        "source dataset name": ",".join(res.source_paths) or spec.source.dataset_id,
        "target table name": res.table,
        "source record count": res.source_count,
        "target record count": res.target_count,
    }


def load_to_table(
    spark: SparkSession, spec: LoadSpec, *, source: DataFrame | None = None, debug: bool = False,
    extra_metrics: Sequence[Column] = (),
) -> LoadResult:
    """K10. ``extra_metrics`` are aggregate expressions computed during the same write (one
    parse of the source); their values come back in ``LoadResult.metrics``."""
    check_load_type(spec.load_type)  # E5: before any job, even for a new table
    if spec.quarantine_table and not spec.corrupt_column:
        raise ValueError("quarantine_table needs corrupt_column")
    if spec.ledger:
        return _append_by_ledger(spark, spec, source, extra_metrics)
    if source is None:
        source, paths = source_frame(spark, spec)
    else:
        paths = []
    ensure_database(spark, spec.target.database, spec.warehouse_path)
    table = spec.target.qualified
    quarantined_n = None
    if spec.quarantine_table and spec.corrupt_column in source.columns:
        source, bad_lines = stage_parsed(source, spec.corrupt_column)
        quarantined_n = quarantine(spark, bad_lines, spec.quarantine_table, spec.source.dataset_id, spec.corrupt_column, spec.effective_dates, spec.date_column)
    corrupt = spec.corrupt_column if spec.corrupt_column in source.columns else None
    counter = SourceCounter(source, spec.date_column, spec.effective_dates, corrupt_column=corrupt, extra=extra_metrics)

    def observed(df: DataFrame) -> DataFrame:
        out = counter.attach(df)
        return out.drop(corrupt) if corrupt else out

    outcome = write_table(
        spark, source, table, spec.target.partition_keys, spec.load_type,
        rebalance=spec.rebalance, observe=observed, values=len(spec.effective_dates) or None,
    )
    if debug and spec.effective_dates:
        sample_loaded(spark, table, spec.effective_dates[0], date_column=spec.date_column, debug=True)
    count_map = counter.count_map()
    if count_map is not None:  # the observed metrics cover the batch
        dates = spec.effective_dates if counter.per_date else None
        report = validate_load(spark, table, count_map, spec.date_column, dates=dates)
    else:  # dates outside the expected list, or very many dates: counted by a second pass
        report = validate_load(spark, table, counter.counts(spark), spec.date_column, dates=spec.effective_dates)
    rows = report.collect()  # one row per date of the batch
    report = spark.createDataFrame([tuple(r) for r in rows], REPORT_SCHEMA)  # counted once, not again by each reader
    src_n = sum(r.source_count for r in rows)
    tgt_n = sum(r.target_count for r in rows)
    bad = [r for r in rows if not r.is_match]
    status = 1 if bad else 0
    # The two messages.
    if bad:
        log.error("Load is unsuccessful for %s. Source Record Count = %d, Target Record Count = %d", table, src_n, tgt_n)
        if spec.strict:
            raise LoadMismatchError(f"{table}: count mismatch on {[r.effective_date for r in bad]}")
    else:
        log.info("Load is successful. Source Record Count = %d, Target Record Count = %d", src_n, tgt_n)
    if spec.state_table:
        update_state(spark, table, spec.state_table, [r.effective_date for r in rows if r.effective_date is not None and r.target_count], spec.date_column, spec.state_columns)
    corrupt_n = int(counter.metrics().get("corrupt_rows", 0)) if quarantined_n is None else quarantined_n
    if quarantined_n:
        log.warning("%s: %d source lines did not parse; they are in %s.", table, corrupt_n, spec.quarantine_table)
    elif corrupt_n:
        log.warning("%s: %d source rows did not parse; their bad fields were loaded as null.", table, corrupt_n)
    return LoadResult(table, outcome.action, src_n, tgt_n, status, report, rows, paths, corrupt_n, counter.metrics())
