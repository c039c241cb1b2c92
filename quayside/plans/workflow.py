"""a workflow = pre tasks, one ingestion (load) or distribution (extract) task,
post tasks (only when the main task succeeded), and lineage (always).

Everything runs in the caller's Spark session; each management task is a distributed job
whose one-row-per-rule / per-date / per-column summary is all that reaches the driver.
The result is a small frame, one row per step, with real counts.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field, replace
from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.operators.anomaly import score_daily, volume_against_history, volume_anomalies
from quayside.operators.lineage import edges_from_counts, record_lineage
from quayside.operators.profile import profile_columns
from quayside.operators.isolation import CONTAMINATION, learned_outliers
from quayside.operators.quality import KEY_RULE_KINDS, Rule, check_key_rules, check_rules, split_rules
from quayside.operators.reconcile import control_schema, reconcile_totals
from quayside.plans.load import LoadResult, load_to_table, source_frame
from quayside.sinks.delimited import write_delimited
from quayside.sinks.quarantine import quarantined
from quayside.sources.delimited import read_delimited, resolve_dated_path
from quayside.sources.sqlfile import read_sql_file
from quayside.spec import DatasetSpec, LoadSpec
from quayside.functions.schema import column_spec_to_schema

log = logging.getLogger(__name__)

RESULT_SCHEMA = (
    "workflow_id string, step string, task string, dataset_id string, status string, "
    "checked_rows long, issue_count long, source_count long, target_count long"
)
TASK_NAMES = ("data quality", "data quality ml", "data profile", "data reconciliation")


@dataclass(frozen=True)
class ManagementTask:
    name: str
    dataset_id: str
    params: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class ExtractSpec:
    """Distribution task: a SQL file's result to a dated delimited file (S10 + K11)."""

    source: DatasetSpec  # kind sql_file
    target: DatasetSpec  # kind delimited, path template with the date token
    effective_date: str
    columns: Sequence[Mapping[str, str]] = ()
    args: Mapping[str, Any] = field(default_factory=dict)  # named SQL parameters
    upstream: tuple[str, ...] = ()  # datasets the query reads (lineage sources)


@dataclass(frozen=True)
class Workflow:
    workflow_id: str
    load: LoadSpec | None = None
    extract: ExtractSpec | None = None
    pre_tasks: tuple[ManagementTask, ...] = ()
    post_tasks: tuple[ManagementTask, ...] = ()
    datasets: Mapping[str, DatasetSpec] = field(default_factory=dict)
    columns: Mapping[str, Sequence[Mapping[str, str]]] = field(default_factory=dict)  # of delimited datasets besides the load's
    lineage_table: str | None = None
    gate: bool = False  # E11: pre-task failures block the load only when set
    # Run quality, volume and profile tasks on the same dataset in one pass over it
    # (operators/onepass.py); a profile that asks for exact distinct counts runs alone.
    fuse_checks: bool = True


def _row(wf, step, task, ds, status, checked=None, issues=None, src=None, tgt=None):
    return (wf, step, task, ds, status, checked, issues, src, tgt)


def _dataset_frame(spark: SparkSession, wf: Workflow, dataset_id: str) -> DataFrame:
    if wf.load is not None:
        if dataset_id == wf.load.source.dataset_id:
            return source_frame(spark, wf.load)[0]
        if dataset_id in (wf.load.target.qualified, wf.load.target.dataset_id):
            # a task after an incremental load is about the run's dates, not all history
            table = spark.table(wf.load.target.qualified)
            if wf.load.load_type == "incremental" and wf.load.effective_dates and wf.load.date_column in table.columns:
                table = table.where(F.col(wf.load.date_column).cast("string").isin([str(d) for d in wf.load.effective_dates]))
            return table
    if wf.extract is not None and dataset_id == wf.extract.target.dataset_id:
        path = resolve_dated_path(wf.extract.target.path_template, wf.extract.effective_date)
        return read_delimited(spark, path, column_spec_to_schema(wf.extract.columns), wf.extract.target.delimiter, wf.extract.target.header, escape_lines=True)
    ds = wf.datasets.get(dataset_id)
    if ds is None:
        raise KeyError(f"unknown dataset {dataset_id}")
    if ds.kind == "delimited" and wf.load is not None and ds.path_template:
        # Another delimited dataset: its own declared columns, at the load's dates.
        if dataset_id not in wf.columns:
            raise RuntimeError(f"dataset {dataset_id}: no declared columns to read it with (Workflow.columns)")
        spec = replace(wf.load, source=ds, columns=wf.columns[dataset_id], corrupt_column=None, quarantine_table=None, ledger=False)
        names = {c["column_name"].lower() for c in spec.columns}
        return source_frame(spark, replace(spec, date_from_path=spec.date_from_path and spec.date_column.lower() not in names))[0]
    if ds.kind == "table":
        return spark.table(ds.table.qualified)
    if ds.kind == "sql_file":
        return read_sql_file(spark, ds.sql_path)
    raise RuntimeError(f"dataset {dataset_id}: no schema to read it with")


def _parent(spark: SparkSession, wf: Workflow):
    """The parent of a foreign-key rule: a frame, or the id of a dataset of the workflow."""
    return lambda p: p if isinstance(p, DataFrame) else _dataset_frame(spark, wf, p)


def _with_key_rules(spark: SparkSession, wf: Workflow, task: ManagementTask, df: DataFrame, quality: DataFrame | None) -> DataFrame:
    """The report of the row rules with that of the task's unique and foreign-key rules."""
    keys = split_rules(_rules(task, df))[1]
    if not keys:
        return quality
    more = check_key_rules(df, keys, _parent(spark, wf))
    return more if quality is None else quality.unionByName(more)


def _with_bad_lines(spark: SparkSession, wf: Workflow, task: ManagementTask, df: DataFrame, quality: DataFrame) -> DataFrame:
    """After a load with a quarantine, a task on its target reports the lines that did not parse."""
    load = wf.load
    if load is None or not load.quarantine_table or task.dataset_id not in (load.target.dataset_id, load.target.qualified):
        return quality
    lines = quarantined(spark, load.quarantine_table, load.effective_dates, load.date_column).select(F.count(F.lit(1))).scalar()
    found = df.agg((F.count(F.lit(1)) + lines).alias("checked_rows"), lines.alias("failed_rows"))
    return quality.unionByName(found.select(
        F.lit("lines_parse").alias("rule_name"), F.lit("parse").alias("rule_type"), F.lit(None).cast("string").alias("column_name"),
        "checked_rows", "failed_rows", (F.col("failed_rows") == 0).alias("passed"),
    ))


def _rules(task: ManagementTask, df: DataFrame) -> list[Rule]:
    p = task.params
    rules = [r if isinstance(r, Rule) else Rule(**r) for r in p.get("rules", ())]
    return rules or [Rule(f"{c}_not_null", "not_null", c) for c in p.get("not_null", df.columns)]


def _summarise(wf: Workflow, task: ManagementTask, step: str, quality=None, daily=None, profile=None, keep: dict | None = None) -> tuple:
    """Result row of a quality / volume / profile task from its result frame, which is kept."""
    if keep is not None:
        frame = {"data quality": quality, "data quality ml": daily}.get(task.name, profile)
        tasks = wf.pre_tasks if step == "pre" else wf.post_tasks
        keep[(step, next(i for i, t in enumerate(tasks) if t is task), task.name)] = frame
    if task.name == "data quality":
        res = quality.agg(F.max("checked_rows").alias("checked"), F.sum("failed_rows").alias("failed")).first()
        return _row(wf.workflow_id, step, task.name, task.dataset_id, "ok" if not res.failed else "failed", res.checked, res.failed)
    if task.name == "data quality ml":
        res = daily.agg(F.sum("n").alias("rows"), F.count_if("is_anomaly").alias("bad")).first()
        return _row(wf.workflow_id, step, task.name, task.dataset_id, "ok" if not res.bad else "failed", res.rows, res.bad)
    res = profile.agg(F.max("row_count").alias("rows")).first()
    return _row(wf.workflow_id, step, task.name, task.dataset_id, "ok", res.rows, 0)


FUSABLE = ("data quality", "data quality ml", "data profile")


def _first_of_each_name(tasks: Sequence[ManagementTask], idx: list[int]) -> list[int]:
    """One task per kind shares a pass; a repeated kind (other rules) runs on its own."""
    seen: set[str] = set()
    out = []
    for i in idx:
        if tasks[i].name not in seen:
            seen.add(tasks[i].name)
            out.append(i)
    return out


def _volume_score(spark: SparkSession, wf: Workflow, dataset_id: str, date_column: str):
    """How a task's daily volumes are scored: those of the load's source or target against the
    days that the target holds besides the run's; others among themselves."""
    load = wf.load
    if load is not None and date_column == load.date_column and dataset_id in (load.source.dataset_id, load.target.dataset_id, load.target.qualified):
        return lambda daily: volume_against_history(daily, spark, load.target.qualified, date_column, load.effective_dates, state_table=load.state_table)
    return score_daily


def _fused_rows(spark: SparkSession, wf: Workflow, tasks: Sequence[ManagementTask], step: str, keep: dict | None = None) -> dict[int, tuple]:
    """Rows of the tasks that share one pass over their dataset, by task index."""
    from quayside.operators.onepass import source_checks

    out: dict[int, tuple] = {}
    if not wf.fuse_checks:
        return out
    by_ds: dict[str, list[int]] = {}
    for i, t in enumerate(tasks):
        if t.name in FUSABLE and not t.params.get("exact") and not t.params.get("features"):
            by_ds.setdefault(t.dataset_id, []).append(i)
    for ds, idx in by_ds.items():
        idx = _first_of_each_name(tasks, idx)
        if len(idx) < 2:
            continue
        group = [tasks[i] for i in idx]
        date_col = next((t.params["date_column"] for t in group if "date_column" in t.params), "effective_date")
        df = _dataset_frame(spark, wf, ds)
        if date_col not in df.columns:
            continue
        dq = next((t for t in group if t.name == "data quality"), None)
        prof = next((t for t in group if t.name == "data profile"), None)
        rules = split_rules(_rules(dq, df))[0] if dq else []
        checks = source_checks(df, date_col, rules, prof.params.get("columns") if prof else None)
        if dq:
            checks.quality = _with_bad_lines(spark, wf, dq, df, _with_key_rules(spark, wf, dq, df, checks.quality))
        daily = _volume_score(spark, wf, ds, date_col)(checks.daily.select("dt", "n"))
        for i, t in zip(idx, group):
            out[i] = _summarise(wf, t, step, checks.quality, daily, checks.profile, keep)
    return out


def run_tasks(spark: SparkSession, wf: Workflow, tasks: Sequence[ManagementTask], step: str, skip: Sequence[int] = (), keep: dict | None = None) -> dict[int, tuple]:
    """Result rows by task index; tasks in ``skip`` are left to the caller. A task that raises
    has the status ``error``; the others still run."""
    todo = [(i, t) for i, t in enumerate(tasks) if i not in skip]
    try:
        fused = _fused_rows(spark, wf, [t for _, t in todo], step, keep)
    except Exception as e:  # the tasks then run one by one, and the one that fails says so
        log.warning("%s: shared pass of the %s tasks failed: %s", wf.workflow_id, step, e)
        fused = {}
    out = {}
    for j, (i, t) in enumerate(todo):
        try:
            out[i] = fused[j] if j in fused else run_management_task(spark, wf, t, step, keep)
        except Exception as e:
            log.error("%s: %s task %r on %s failed: %s", wf.workflow_id, step, t.name, t.dataset_id, e)
            out[i] = _row(wf.workflow_id, step, t.name, t.dataset_id, "error")
    return out


def _checks_in_load(spark: SparkSession, wf: Workflow):
    """Pre tasks that can run as observed metrics of the load's own write: the workflow is
    not gated (so nothing waits for them), the task reads the load's source and uses its
    date column, and asks for no exact profile, learned detector or key rules. Returns
    ``(indices, ObservedChecks)`` or ``None``."""
    from quayside.operators.onepass import ObservedChecks

    load = wf.load
    if wf.gate or load is None or not wf.fuse_checks or load.ledger:  # a ledger may leave files out
        return None
    candidates = _first_of_each_name(wf.pre_tasks, [
        i for i, t in enumerate(wf.pre_tasks)
        if t.name in FUSABLE and t.dataset_id == load.source.dataset_id
        and not t.params.get("exact") and not t.params.get("features")
        and not any((r if isinstance(r, Rule) else Rule(**r)).kind in KEY_RULE_KINDS for r in t.params.get("rules", ()))
    ])
    if not candidates:
        return None
    df = source_frame(spark, load)[0]  # lazy: only its schema is used here
    idx = []
    for i in candidates:
        t = wf.pre_tasks[i]
        if t.name == "data quality ml" and (
            t.params.get("date_column", load.date_column) != load.date_column or load.date_column not in df.columns
        ):
            continue
        idx.append(i)
    tasks = {wf.pre_tasks[i].name: wf.pre_tasks[i] for i in idx}
    fields = []
    if "data profile" in tasks:
        wanted = tasks["data profile"].params.get("columns")
        fields = [f for f in df.schema.fields
                  if f.name not in (load.date_column, load.corrupt_column) and (wanted is None or f.name in wanted)]
    if not idx:
        return None
    rules = _rules(tasks["data quality"], df) if "data quality" in tasks else []
    return idx, ObservedChecks(fields, rules)


def run_management_task(spark: SparkSession, wf: Workflow, task: ManagementTask, step: str, keep: dict | None = None) -> tuple:
    """One governance task; returns its result row."""
    df = _dataset_frame(spark, wf, task.dataset_id)
    p = task.params
    date_column = p.get("date_column", "effective_date")
    if task.name == "data quality":
        quality = check_rules(df, _rules(task, df), _parent(spark, wf))
        return _summarise(wf, task, step, quality=_with_bad_lines(spark, wf, task, df, quality), keep=keep)
    if task.name == "data profile":
        return _summarise(wf, task, step, profile=profile_columns(df, p.get("columns"), exact=p.get("exact", False)), keep=keep)
    if task.name == "data quality ml" and p.get("features"):
        # a learned detector over the rows; more than twice the expected share is a finding
        share = p.get("contamination", CONTAMINATION)
        rows = learned_outliers(df, p["features"], share, id_columns=p.get("id_columns", ()))
        res = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anomaly").alias("bad")).first()
        if keep is not None:
            tasks = wf.pre_tasks if step == "pre" else wf.post_tasks
            keep[(step, next(i for i, t in enumerate(tasks) if t is task), task.name)] = rows.where("is_anomaly")
        status = "ok" if res.bad <= 2 * share * res.n else "failed"
        return _row(wf.workflow_id, step, task.name, task.dataset_id, status, res.n, res.bad)
    if task.name == "data quality ml":
        daily = volume_anomalies(df, date_column).select("dt", "n")
        return _summarise(wf, task, step, daily=_volume_score(spark, wf, task.dataset_id, date_column)(daily), keep=keep)
    if task.name == "data reconciliation":
        ds = wf.datasets.get(task.dataset_id) or (wf.load.source if wf.load else None)
        template = p.get("control_path_template") or (ds.recon_path_template if ds else None)
        if not template:
            raise ValueError(f"no control file template for dataset {task.dataset_id}")
        dates = p.get("dates") or (wf.load.effective_dates if wf.load else ())
        paths = [resolve_dated_path(template, d) for d in dates]
        scale = p.get("amount_scale", 2)
        control = read_delimited(spark, paths, control_schema(scale), sep=p.get("control_delimiter") or (ds.recon_delimiter if ds else "|"))
        report = reconcile_totals(control, df, date_column, p.get("amount_column"), dates=dates, scale=scale)
        if keep is not None:
            tasks = wf.pre_tasks if step == "pre" else wf.post_tasks
            keep[(step, next(i for i, t in enumerate(tasks) if t is task), task.name)] = report
        res = report.agg(
            F.sum("target_count").alias("rows"), F.count_if(~F.col("is_match")).alias("bad"),
            F.sum("control_count").alias("ctl"),
        ).first()
        return _row(wf.workflow_id, step, task.name, task.dataset_id, "ok" if not res.bad else "failed", res.rows, res.bad, res.ctl, res.rows)
    raise ValueError(f"unknown management task {task.name!r}; expected one of {TASK_NAMES}")


def run_extract(spark: SparkSession, spec: ExtractSpec) -> tuple[int, int, str]:
    """Distribution task: query result to a dated delimited file; rows written are
    observed during the write and the file is read back and counted."""
    df = read_sql_file(spark, spec.source.sql_path, dict(spec.args) or None)
    obs = Observation(f"extract_{uuid.uuid4().hex[:8]}")
    path = resolve_dated_path(spec.target.path_template, spec.effective_date)
    write_delimited(df.observe(obs, F.count(F.lit(1)).alias("n")), path, sep=spec.target.delimiter, header=spec.target.header, escape_lines=True)
    written = int(obs.get["n"])
    back = read_delimited(spark, path, df.schema, spec.target.delimiter, spec.target.header, dataset_id=spec.target.dataset_id, escape_lines=True).count()
    return written, back, path


def run_workflow(spark: SparkSession, wf: Workflow, run_id: str | None = None, keep: dict | None = None) -> DataFrame:
    """Runs a workflow; one result row per step. ``keep`` receives the result frames of the
    management tasks by ``(step, index, task name)``: failed rules, profiles, daily scores,
    reconciliation. Statuses: ``ok``; ``failed`` (a check or count does not hold); ``error``
    (the step raised, see the log); ``skipped``. Lineage is recorded with the main step's status,
    whatever it is."""
    run_id = run_id or uuid.uuid4().hex
    # Pre tasks on the load's own source ride along with the load's write when nothing
    # waits for them (one parse of the source for the whole workflow); the others run now.
    try:
        in_load = _checks_in_load(spark, wf)
    except Exception as e:  # the source cannot be read: the tasks and the load say so below
        log.warning("%s: %s", wf.workflow_id, e)
        in_load = None
    in_load_idx = in_load[0] if in_load else []
    pre = run_tasks(spark, wf, wf.pre_tasks, "pre", skip=in_load_idx, keep=keep)
    blocked = wf.gate and any(r[4] != "ok" for r in pre.values())

    status = "skipped"
    counts = None
    if wf.extract is not None and wf.load is None:
        src_id, tgt_id, name = wf.extract.source.dataset_id, wf.extract.target.dataset_id, "distribution"
        dates = [wf.extract.effective_date]
    else:
        load = wf.load
        src_id, tgt_id = (load.source.dataset_id, load.target.dataset_id or load.target.qualified) if load else (None, None)
        name, dates = "ingestion", list(load.effective_dates) if load else []
    main: list[tuple] = []
    try:
        if blocked:
            main.append(_row(wf.workflow_id, "main", name, tgt_id, "skipped"))
        elif wf.load is not None:
            res: LoadResult = load_to_table(spark, wf.load, extra_metrics=in_load[1].exprs() if in_load else ())
            status = "ok" if res.status == 0 else "failed"
            # rows that differ, over all dates: +1 on one and -1 on another are two
            off = sum(abs(r.target_count - r.source_count) for r in res.report_rows)
            main.append(_row(wf.workflow_id, "main", name, tgt_id, status, res.source_count, off, res.source_count, res.target_count))
            counts = res.report.select("effective_date", "target_count")
            if in_load:
                per_date = {r.effective_date: r.source_count for r in res.report_rows}
                score = _volume_score(spark, wf, wf.load.source.dataset_id, wf.load.date_column)
                checks = in_load[1].results(spark, res.metrics, per_date, score=score)
                for i in in_load_idx:
                    pre[i] = _summarise(wf, wf.pre_tasks[i], "pre", checks.quality, checks.daily, checks.profile, keep)
        elif wf.extract is not None:
            written, back, _ = run_extract(spark, wf.extract)
            status = "ok" if written == back else "failed"
            main.append(_row(wf.workflow_id, "main", name, tgt_id, status, written, abs(written - back), written, back))
            counts = spark.createDataFrame([(wf.extract.effective_date, back)], "effective_date string, n long")
    except Exception as e:
        log.error("%s: main task failed: %s", wf.workflow_id, e)
        if not main:  # else the load itself is done and recorded
            status = "error"
            main.append(_row(wf.workflow_id, "main", name, tgt_id, status))
    for i in in_load_idx:
        pre.setdefault(i, _row(wf.workflow_id, "pre", wf.pre_tasks[i].name, wf.pre_tasks[i].dataset_id, "error"))

    results = [pre[i] for i in sorted(pre)] + main
    if status == "ok":  # post tasks only after a successful main task
        post = run_tasks(spark, wf, wf.post_tasks, "post", keep=keep)
        results += [post[i] for i in sorted(post)]

    # Lineage always runs, also after a failed or skipped main task: its edges carry the status.
    edges_n, lineage = 0, status
    try:
        if src_id is not None:
            if counts is None:
                counts = spark.createDataFrame([(str(d), 0) for d in dates] or [(None, 0)], "effective_date string, n long")
            sources = (wf.extract.upstream or (src_id,)) if wf.load is None else (src_id,)
            edges = None
            for s in sources:
                e = edges_from_counts(counts, wf.workflow_id, "main", s, tgt_id, run_id, status)
                edges = e if edges is None else edges.unionByName(e)
            if wf.lineage_table:
                record_lineage(spark, edges, wf.lineage_table)
            edges_n = edges.count()
    except Exception as e:
        log.error("%s: lineage failed: %s", wf.workflow_id, e)
        lineage = "error"
    results.append(_row(wf.workflow_id, "lineage", "data lineage", tgt_id, lineage, edges_n, 0))
    return spark.createDataFrame(results, RESULT_SCHEMA)
