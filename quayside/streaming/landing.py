"""Load dated files as they land, with Structured Streaming.

A file stream over the landing folder names the files that have not been seen; its checkpoint
records which files each micro-batch took, across restarts and executor loss. The stream only
tells which effective dates changed. For these the micro-batch loads ALL files that lie in the
landing folder, with the ordinary batch load (``load_to_table``: the spec's reader options,
observed write, per-date compare), and replaces the dates' partitions. So part files of one date
may be split over micro-batches, arrive late, or be replayed after a failure: the table always
holds each landed file of the date exactly once. A date's files therefore have to stay in the
landing folder as long as more of them may come; a late file costs reading its date again.

The target needs the date column among its partition keys, or a ledger (``LoadSpec.ledger``): a
table without keys is appended to, and the ledger of its files makes a replayed micro-batch add
nothing, so that every landed file is read once and need not stay. Other targets are refused (an
append could not be replayed). With dates in the data (no ``date_from_path``) the landing folder is
read whole and filtered to the changed dates.

``trigger="availableNow"`` loads everything present and stops (a scheduled run);
``processingTime`` keeps the query running.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.schema import column_spec_to_schema
from quayside.plans.load import LoadResult, append_files, load_to_table
from quayside.sinks.table import ensure_database
from quayside.sources.delimited import DATE_TOKEN, date_from_path_column, literal_path, read_delimited, to_spark_uri
from quayside.spec import DatasetSpec, LoadSpec


def _landing_root_and_glob(src: DatasetSpec) -> tuple[str, str, str]:
    """Template with the user filled in, folder to watch, and glob of the dated entries in it."""
    uri = to_spark_uri(src.path_template).rstrip("/")
    if "{data_source_user}" in uri:
        if src.data_source_user is None:
            raise ValueError("path template needs a data_source_user")
        uri = uri.replace("{data_source_user}", src.data_source_user)
    parent, _, leaf = uri.rpartition("/")
    if DATE_TOKEN not in leaf:
        raise ValueError("the date token must be in the last path component for a landing stream")
    return uri, parent, leaf.replace(DATE_TOKEN, "[0-9]" * 8)


def landing_stream(spark: SparkSession, spec: LoadSpec, max_files_per_trigger: int | None = None) -> DataFrame:
    """The streaming frame of newly landed files: ``(path, length, modified)``; their contents are
    not read."""
    _, root, glob = _landing_root_and_glob(spec.source)
    r = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(f"{root}/{glob}").select("path", "length", F.col("modificationTime").cast("string").alias("modified"))


def changed_dates(files: DataFrame, spec: LoadSpec) -> list[str]:
    """Effective dates of the files of a micro-batch (one row per date reaches the driver)."""
    template, _, _ = _landing_root_and_glob(spec.source)
    if spec.date_from_path:
        days = files.select(date_from_path_column(template, F.col("path")).alias("d"))
    else:
        paths = [r[0] for r in files.collect()]  # a name per new file
        schema = column_spec_to_schema(spec.columns, parity=spec.parity)
        src = spec.source
        # names come unencoded here, and the reader takes glob characters in them literally when escaped
        days = read_delimited(files.sparkSession, [literal_path(p) for p in paths], schema, src.delimiter, src.header, dataset_id=src.dataset_id, options=dict(src.options))
        days = days.select(F.col(spec.date_column).cast("string").alias("d"))
    return sorted(r[0] for r in days.distinct().collect() if r[0] is not None)


def ingest_landing(
    spark: SparkSession,
    spec: LoadSpec,
    checkpoint_location: str,
    trigger: str = "availableNow",
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = None,
) -> tuple[object, list[LoadResult]]:
    """Start (and with ``availableNow`` finish) the landing stream. Returns the streaming
    query and the results of the micro-batches run in this call."""
    dated = spec.date_column.lower() in [k.lower() for k in spec.target.partition_keys]
    if spec.load_type != "incremental" or dated == spec.ledger:
        raise ValueError(f"a landing stream needs an incremental load into a table partitioned by {spec.date_column}, or a ledger: other loads cannot be replayed")
    ensure_database(spark, spec.target.database, spec.warehouse_path)
    results: list[LoadResult] = []
    _, root, glob = _landing_root_and_glob(spec.source)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        if spec.ledger:
            if not batch.isEmpty():
                results.append(append_files(spark, spec, batch))
            return
        dates = changed_dates(batch, spec) if not batch.isEmpty() else []
        if not dates:
            return
        session, day_spec = spark, replace(spec, effective_dates=tuple(dates))  # the caller's session, whose table cache the load refreshes
        source = None
        if not spec.date_from_path:  # a date's rows may lie in any landed file
            schema, src = column_spec_to_schema(spec.columns, parity=spec.parity), spec.source
            source = read_delimited(session, f"{root}/{glob}", schema, src.delimiter, src.header, dataset_id=src.dataset_id,
                                    corrupt_column=spec.corrupt_column, options=dict(src.options))
            source = source.where(F.col(spec.date_column).cast("string").isin(dates))
        results.append(load_to_table(session, day_spec, source=source))

    w = landing_stream(spark, spec, max_files_per_trigger).writeStream.foreachBatch(load_batch).option(
        "checkpointLocation", checkpoint_location
    )
    if trigger == "availableNow":
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
    else:
        q = w.trigger(processingTime=processing_time).start()
    return q, results
