"""``spark-submit`` entry for one load, or for a whole workflow from metadata.

    spark-submit quayside/plans/job.py --source_file_path ... (see --help)
    spark-submit quayside/plans/job.py workflow --metadata m.json --workflow_id fuel \
        --cycle_date 2025-03-11 --schemas s.json --placeholder LANDING=/landing

Cluster settings come from spark-submit and the cluster's defaults, which nothing here
overrides. The reference job's own cluster options (``--spark_master_uri``,
``--spark_history_log_dir``, ``--spark_local_dir``, ``--postgres_uri``) are accepted and become
session settings where spark-submit has not decided them (see ``session_settings``).
``--postgres_uri`` selects a persistent catalog, which daily runs in separate processes need;
its JDBC driver has to be on spark-submit's class path. Without it, or a catalog named on
submit, the tables are known to one process only. Prints one JSON line with the load result and
exits 1 on a count mismatch when ``--strict`` is given. A workflow prints a line per step and exits
1 if any step failed or raised, checks and lineage included, so that the scheduler sees it;
``--main_step_only`` looks at the load or extract alone."""

from __future__ import annotations

import argparse
import json
import sys

from quayside.plans.load import LoadMismatchError, load_to_table
from quayside.plans.metadata import datasets_from_metadata
from quayside.spec import CORRUPT_COLUMN, DatasetSpec, LoadSpec, TableSpec


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Load dated delimited file(s) into a catalog table")
    p.add_argument("--warehouse_path", required=True)
    p.add_argument("--source_file_path", required=True, help="path or template with the yyyymmdd token")
    p.add_argument("--source_dataset_id", required=True)
    p.add_argument("--qual_target_table_name", required=True)
    p.add_argument("--target_database_name", required=True)
    p.add_argument("--partition_keys", required=True, help='JSON list, e.g. ["effective_date"]')
    p.add_argument("--cur_eff_date", required=True, help="ISO date; comma-separated for a backfill")
    p.add_argument("--target_table_schema", required=True, help="JSON list of {column_name, data_type}")
    p.add_argument("--load_type", required=True, choices=["full", "incremental"])
    p.add_argument("--file_delim", help="delimiter; that of the dataset's metadata record when omitted, else a comma")
    p.add_argument("--metadata", help="JSON file with dataset records, for the source's delimiter and data source user")
    p.add_argument("--date_from_path", action="store_true", help="take effective_date from the file path")
    p.add_argument("--parity", action="store_true", help="two-type schema mapping (decimal or string)")
    p.add_argument("--strict", action="store_true", help="exit 1 on a count mismatch")
    p.add_argument("--quarantine_table", help="table for lines that do not parse; only parsed rows are loaded")
    p.add_argument("--state_table", help="table of the target's stored daily state, kept up by the load")
    p.add_argument("--ledger", action="store_true", help="append files once each, by the target's ledger (no partition keys)")
    p.add_argument("--debug", nargs="?", const="y", default="n")
    p.add_argument("--spark_master_uri", help="master URL; spark-submit's --master when omitted")
    p.add_argument("--spark_history_log_dir", help="event-log folder (spark.eventLog.dir)")
    p.add_argument("--spark_local_dir", help="executor scratch folder (spark.local.dir)")
    p.add_argument("--postgres_uri", help="JDBC URL of the Hive metastore database")
    return p.parse_args(argv)


def session_settings(a: argparse.Namespace) -> tuple[str | None, dict]:
    """``(master, settings)`` for the session from the reference job's cluster options; only
    options that were given are set, everything else stays with spark-submit."""
    extra = {}
    if a.spark_history_log_dir:
        extra["spark.eventLog.enabled"] = "true"
        extra["spark.eventLog.dir"] = a.spark_history_log_dir
    if a.spark_local_dir:
        extra["spark.local.dir"] = a.spark_local_dir
    if a.postgres_uri:
        # A persistent catalog: tables of one run are found by the next.
        extra["spark.sql.catalogImplementation"] = "hive"
        extra["spark.hadoop.javax.jdo.option.ConnectionURL"] = a.postgres_uri
        extra["spark.hadoop.javax.jdo.option.ConnectionDriverName"] = "org.postgresql.Driver"
    return a.spark_master_uri, extra


def spec_from_args(a: argparse.Namespace) -> LoadSpec:
    db, _, name = a.qual_target_table_name.rpartition(".")
    if db and db != a.target_database_name:
        raise ValueError("qual_target_table_name and target_database_name disagree")
    dates = tuple(d.strip() for d in a.cur_eff_date.split(",") if d.strip())
    delimiter, user = a.file_delim, None
    if a.metadata:
        with open(a.metadata) as f:
            metadata = json.load(f)
        known = datasets_from_metadata([r for r in metadata.get("datasets", ()) if r["dataset_id"] == a.source_dataset_id], {}, metadata.get("data_sources", ()))
        if a.source_dataset_id not in known:
            raise KeyError(f"dataset {a.source_dataset_id} is not in {a.metadata}")
        described = known[a.source_dataset_id]
        delimiter, user = delimiter or described.delimiter, described.data_source_user
    return LoadSpec(
        source=DatasetSpec(a.source_dataset_id, path_template=a.source_file_path, delimiter=delimiter or ",", data_source_user=user),
        target=TableSpec(a.target_database_name, name, tuple(json.loads(a.partition_keys))),
        columns=json.loads(a.target_table_schema),
        load_type=a.load_type,
        effective_dates=dates,
        date_from_path=a.date_from_path,
        warehouse_path=a.warehouse_path,
        parity=a.parity,
        strict=a.strict,
        corrupt_column=CORRUPT_COLUMN if a.quarantine_table else None,
        quarantine_table=a.quarantine_table,
        state_table=a.state_table,
        ledger=a.ledger,
    )


def workflow_main(argv) -> int:
    """Run a workflow id from metadata records (datasets, integration_tasks, workflows)."""
    from quayside.plans.metadata import workflow_from_metadata
    from quayside.plans.workflow import run_workflow
    from quayside.session import build_session

    p = argparse.ArgumentParser(description="Run a workflow from metadata records")
    p.add_argument("--metadata", required=True, help="JSON file with datasets, integration_tasks, workflows")
    p.add_argument("--workflow_id", required=True)
    p.add_argument("--cycle_date", required=True, help="effective date of the run (ISO)")
    p.add_argument("--schemas", required=True, help="JSON file: target dataset id -> column spec")
    p.add_argument("--placeholder", action="append", default=[], help="NAME=path, e.g. LANDING=/landing")
    p.add_argument("--main_step_only", action="store_true", help="exit status by the load or extract alone, not by checks")
    p.add_argument("--warehouse_path")
    p.add_argument("--lineage_table")
    a = p.parse_args(argv)
    with open(a.metadata) as f:
        metadata = json.load(f)
    with open(a.schemas) as f:
        schemas = json.load(f)
    placeholders = dict(x.split("=", 1) for x in a.placeholder)
    wf = workflow_from_metadata(
        metadata, a.workflow_id, a.cycle_date, schemas, placeholders=placeholders,
        warehouse_path=a.warehouse_path, lineage_table=a.lineage_table,
    )
    spark = build_session(master=None, app=f"workflow {a.workflow_id}")
    rows = [r.asDict() for r in run_workflow(spark, wf).collect()]  # one row per step
    for r in rows:
        print(json.dumps(r))
    return exit_status(rows, a.main_step_only)


def exit_status(rows: list[dict], main_step_only: bool = False) -> int:
    """1 if a step has failed or raised (a skipped one has not), else 0."""
    looked_at = [r for r in rows if not main_step_only or r["step"] == "main"]
    return 0 if all(r["status"] in ("ok", "skipped") for r in looked_at) else 1


def main(argv=None) -> int:
    from quayside.session import build_session

    argv = sys.argv[1:] if argv is None else list(argv)
    if argv[:1] == ["workflow"]:
        return workflow_main(argv[1:])
    a = parse_args(argv)
    spec = spec_from_args(a)
    master, extra = session_settings(a)
    spark = build_session(master=master, app=f"load {spec.target.qualified}", extra=extra)
    try:
        res = load_to_table(spark, spec, debug=a.debug == "y")
    except LoadMismatchError as e:
        print(json.dumps({"table": spec.target.qualified, "status": 1, "error": str(e)}))
        return 1
    print(json.dumps({
        "table": res.table, "action": res.action, "status": res.status,
        "source_count": res.source_count, "target_count": res.target_count, "corrupt_count": res.corrupt_count,
    }))
    return 0


if __name__ == "__main__":
    sys.exit(main())
