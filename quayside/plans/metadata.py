"""Workflows from the reference's metadata records.

The reference keeps datasets, integration tasks and workflows as JSON records (its
README shows them). ``workflow_from_metadata`` turns those records into a ``Workflow``,
so a user can run the same workflow ids here. The column specs, the effective date and
the values of path placeholders such as ``APP_DATA_IN_DIR`` are arguments (the
reference took them from its schema, calendar and configuration services).
"""

from __future__ import annotations

from dataclasses import replace
from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from quayside.plans.workflow import ExtractSpec, ManagementTask, Workflow, run_workflow
from quayside.spec import CORRUPT_COLUMN, DatasetSpec, LoadSpec


def _resolve(path: str | None, placeholders: Mapping[str, str]) -> str | None:
    if path is None:
        return None
    for k, v in placeholders.items():
        path = path.replace(k, v.rstrip("/"))
    return path


def datasets_from_metadata(records: Sequence[Mapping[str, Any]], placeholders: Mapping[str, str], data_sources: Sequence[Mapping[str, Any]] = ()) -> dict[str, DatasetSpec]:
    """``data_sources``: records ``data_source_id, data_source_user``; a dataset that names one reads
    the paths of its user."""
    users = {d["data_source_id"]: d.get("data_source_user") for d in data_sources}
    out = {}
    for rec in records:
        ds = DatasetSpec.from_record(rec)
        if ds.data_source_user is None and rec.get("data_source_id") in users:
            ds = replace(ds, data_source_user=users[rec["data_source_id"]])
        out[ds.dataset_id] = replace(
            ds,
            path_template=_resolve(ds.path_template, placeholders),
            recon_path_template=_resolve(ds.recon_path_template, placeholders),
            sql_path=_resolve(ds.sql_path, placeholders),
        )
    return out


def _tasks(recs) -> tuple[ManagementTask, ...]:
    return tuple(ManagementTask(t["name"], t["required_parameters"]["dataset_id"], dict(t.get("parameters", {}))) for t in recs or ())


def workflow_from_metadata(
    metadata: Mapping[str, Any],
    workflow_id: str,
    effective_date: str,
    schemas: Mapping[str, Sequence[Mapping[str, str]]],
    placeholders: Mapping[str, str] | None = None,
    warehouse_path: str | None = None,
    task_params: Mapping[str, Mapping[str, Any]] | None = None,
    lineage_table: str | None = None,
) -> Workflow:
    """``metadata`` holds the three record lists ``datasets``, ``integration_tasks`` and
    ``workflows``, and may hold ``data_sources``; ``schemas`` maps a target dataset id to its column spec (for a
    distribution task: the extract's dataset id). ``task_params`` adds rule lists and
    other parameters per management-task name."""
    datasets = datasets_from_metadata(metadata["datasets"], placeholders or {}, metadata.get("data_sources", ()))
    wf = next((w for w in metadata["workflows"] if w["workflow_id"] == workflow_id), None)
    if wf is None:
        raise KeyError(f"workflow {workflow_id} is not among the records: {sorted(w['workflow_id'] for w in metadata['workflows'])}")
    tasks = {t["task_id"]: t for t in metadata["integration_tasks"]}
    params = task_params or {}

    def with_params(ts):
        return tuple(replace(t, params={**params.get(t.name, {}), **t.params}) for t in ts)

    load = extract = None
    if wf.get("workflow_type", "ingestion") == "ingestion":
        task = tasks[wf["ingestion_task_id"]]
        src, tgt = datasets[task["source_dataset_id"]], datasets[task["target_dataset_id"]]
        keys = tgt.table.partition_keys
        load = LoadSpec(
            source=src,
            target=replace(tgt.table, dataset_id=tgt.dataset_id),
            columns=schemas[tgt.dataset_id],
            load_type=task["ingestion_pattern"]["load_type"],
            effective_dates=(effective_date,),
            # A file without the date column gets it from its path when the table is keyed by it.
            date_from_path="effective_date" in keys and not any(
                c["column_name"].lower() == "effective_date" for c in schemas[tgt.dataset_id]
            ),
            warehouse_path=warehouse_path,
            # our own, optional parts of the pattern
            corrupt_column=CORRUPT_COLUMN if task["ingestion_pattern"].get("quarantine_table") else None,
            quarantine_table=task["ingestion_pattern"].get("quarantine_table"),
            state_table=task["ingestion_pattern"].get("state_table"),
            ledger=bool(task["ingestion_pattern"].get("ledger")),
        )
    else:
        task = tasks[wf["distribution_task_id"]]
        src, tgt = datasets[task["source_dataset_id"]], datasets[task["target_dataset_id"]]
        extract = ExtractSpec(source=src, target=tgt, effective_date=effective_date, columns=schemas.get(tgt.dataset_id, ()))
    return Workflow(
        workflow_id=workflow_id, load=load, extract=extract,
        pre_tasks=with_params(_tasks(wf.get("pre_tasks"))), post_tasks=with_params(_tasks(wf.get("post_tasks"))),
        datasets=datasets, columns=schemas, lineage_table=lineage_table,
    )


def run_workflow_from_metadata(spark: SparkSession, metadata: Mapping[str, Any], workflow_id: str, effective_date: str, **kwargs) -> DataFrame:
    return run_workflow(spark, workflow_from_metadata(metadata, workflow_id, effective_date, **kwargs))
