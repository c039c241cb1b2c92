import json
import os

from quayside.operators.quality import Rule
from quayside.plans.job import main as job_main, parse_args, spec_from_args
from quayside.plans.workflow import ManagementTask, Workflow, run_workflow
from quayside.spec import DatasetSpec, LoadSpec, TableSpec

SPEC = [{"column_name": "id", "data_type": "bigint"}, {"column_name": "v", "data_type": "decimal(10,2)"},
        {"column_name": "effective_date", "data_type": "string"}]


def _files(scratch, date="2024-01-02", rows=("1,2.50", "2,-1.00")):
    d = f"{scratch}/in"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/pos_{date.replace('-', '')}.csv", "w") as f:
        f.write("id,v,effective_date\n" + "".join(f"{r},{date}\n" for r in rows))
    with open(f"{d}/pos_{date.replace('-', '')}.recon", "w") as f:
        f.write(f"effective_date|row_count|amount_total\n{date}|{len(rows)}|1.50\n")
    return f"{d}/pos_yyyymmdd.csv", f"{d}/pos_yyyymmdd.recon"


def _wf(db, template, recon, gate=False, rules=None):
    src = DatasetSpec("pos_file", path_template=template, recon_path_template=recon)
    load = LoadSpec(source=src, target=TableSpec(db, "pos", ("effective_date",), "pos_table"), columns=SPEC,
                    effective_dates=("2024-01-02",))
    return Workflow(
        "wf1", load=load, gate=gate, datasets={"pos_file": src}, lineage_table=f"{db}.lineage",
        pre_tasks=(ManagementTask("data quality", "pos_file", {"rules": rules or [Rule("v_non_negative", "range", "v", min=0)]}),
                   ManagementTask("data profile", "pos_file")),
        post_tasks=(ManagementTask("data reconciliation", "pos_table", {"amount_column": "v"}),),
    )


def test_workflow_runs_all_steps_with_real_counts(spark, scratch, db):
    t, r = _files(scratch)
    res = [tuple(x) for x in run_workflow(spark, _wf(db, t, r)).collect()]
    steps = [(x[1], x[2], x[4]) for x in res]
    assert steps == [("pre", "data quality", "failed"), ("pre", "data profile", "ok"), ("main", "ingestion", "ok"),
                     ("post", "data reconciliation", "ok"), ("lineage", "data lineage", "ok")]
    main = [x for x in res if x[1] == "main"][0]
    assert (main[7], main[8]) == (2, 2)  # real counts, not zeros (E9)
    assert spark.table(f"{db}.lineage").count() == 1


def test_gate_blocks_load_and_lineage_still_runs(spark, scratch, db):
    t, r = _files(scratch)
    res = [tuple(x) for x in run_workflow(spark, _wf(db, t, r, gate=True)).collect()]
    assert [(x[1], x[4]) for x in res] == [("pre", "failed"), ("pre", "ok"), ("main", "skipped"), ("lineage", "skipped")]
    assert [r.status for r in spark.table(f"{db}.lineage").collect()] == ["skipped"]
    assert not spark.catalog.tableExists(f"{db}.pos")


def test_job_script(spark, scratch, db, capsys):
    t, _ = _files(scratch)
    argv = [
        "--warehouse_path", f"{scratch}/wh", "--source_file_path", t, "--source_dataset_id", "pos_file",
        "--qual_target_table_name", f"{db}.pos", "--target_database_name", db,
        "--partition_keys", '["effective_date"]', "--cur_eff_date", "2024-01-02",
        "--target_table_schema", json.dumps(SPEC), "--load_type", "incremental",
    ]
    spec = spec_from_args(parse_args(argv))
    assert spec.target.partition_keys == ("effective_date",) and spec.effective_dates == ("2024-01-02",)
    assert job_main(argv) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["status"] == 0 and out["source_count"] == out["target_count"] == 2


def test_ungated_pre_checks_run_inside_the_load_and_match_the_separate_pass(spark, scratch, db):
    from quayside.plans.workflow import _checks_in_load

    t, r = _files(scratch)
    wf = _wf(db, t, r)
    assert _checks_in_load(spark, wf)[0] == [0, 1]  # quality and profile ride on the load's write
    fused = [tuple(x)[1:] for x in run_workflow(spark, wf).collect() if x.step == "pre"]
    separate = [tuple(x)[1:] for x in run_workflow(spark, _wf(f"{db}", t, r).__class__(
        **{**wf.__dict__, "fuse_checks": False, "lineage_table": None})).collect() if x.step == "pre"]
    assert fused == separate == [("pre", "data quality", "pos_file", "failed", 2, 1, None, None),
                                 ("pre", "data profile", "pos_file", "ok", 2, 0, None, None)]
    assert _checks_in_load(spark, _wf(db, t, r, gate=True)) is None  # a gate must see the checks first


def test_job_accepts_the_reference_cluster_options():
    from quayside.plans.job import session_settings

    base = ["--warehouse_path", "/wh", "--source_file_path", "/in/a_yyyymmdd.csv", "--source_dataset_id", "a",
            "--qual_target_table_name", "d.a", "--target_database_name", "d", "--partition_keys", "[]",
            "--cur_eff_date", "2024-12-26", "--target_table_schema", "[]", "--load_type", "full"]
    assert session_settings(parse_args(base)) == (None, {})  # nothing given: spark-submit decides
    a = parse_args(base + ["--spark_master_uri", "spark://m:7077", "--spark_history_log_dir", "/logs",
                           "--spark_local_dir", "/scratch", "--postgres_uri", "jdbc:postgresql://h/metastore"])
    master, extra = session_settings(a)
    assert master == "spark://m:7077"
    assert extra == {"spark.eventLog.enabled": "true", "spark.eventLog.dir": "/logs", "spark.local.dir": "/scratch",
                     "spark.sql.catalogImplementation": "hive",
                     "spark.hadoop.javax.jdo.option.ConnectionURL": "jdbc:postgresql://h/metastore",
                     "spark.hadoop.javax.jdo.option.ConnectionDriverName": "org.postgresql.Driver"}


def test_two_quality_tasks_on_one_source_keep_their_own_rules(spark, scratch, db):
    t, r = _files(scratch)
    base = _wf(db, t, r)
    both = base.__class__(**{**base.__dict__, "pre_tasks": (
        ManagementTask("data quality", "pos_file", {"rules": [Rule("v_non_negative", "range", "v", min=0)]}),
        ManagementTask("data quality", "pos_file", {"rules": [Rule("v_not_null", "not_null", "v")]}),
        ManagementTask("data profile", "pos_file"),
    )})
    for wf in (both, both.__class__(**{**both.__dict__, "gate": True})):  # in the load, and in the grouped pass
        pre = [(x.task, x.status, x.issue_count) for x in run_workflow(spark, wf).collect() if x.step == "pre"]
        assert pre == [("data quality", "failed", 1), ("data quality", "ok", 0), ("data profile", "ok", 0)]


def test_a_missing_source_leaves_results_and_lineage(spark, scratch, db):
    wf = _wf(db, f"{scratch}/nowhere/pos_yyyymmdd.csv", f"{scratch}/nowhere/pos_yyyymmdd.recon")
    res = [tuple(x) for x in run_workflow(spark, wf).collect()]
    assert [(x[1], x[2], x[4]) for x in res] == [("pre", "data quality", "error"), ("pre", "data profile", "error"), ("main", "ingestion", "error"), ("lineage", "data lineage", "error")]
    assert [(r.source_dataset, r.status) for r in spark.table(f"{db}.lineage").collect()] == [("pos_file", "error")]


def test_default_rules_cover_every_column_and_frames_are_kept(spark, scratch, db):
    t, r = _files(scratch, rows=("1,", "2,"))
    src = DatasetSpec("pos_file", path_template=t, recon_path_template=r)
    load = LoadSpec(source=src, target=TableSpec(db, "pos", ("effective_date",), "pos_table"), columns=SPEC, effective_dates=("2024-01-02",))
    wf = Workflow("wf1", load=load, datasets={"pos_file": src}, pre_tasks=(ManagementTask("data quality", "pos_file"), ManagementTask("data profile", "pos_file")))
    keep = {}
    assert [x.status for x in run_workflow(spark, wf, keep=keep).collect()][:1] == ["failed"]
    assert {x.column_name: x.failed_rows for x in keep[("pre", 0, "data quality")].collect()} == {"id": 0, "v": 2, "effective_date": 0}
    assert {x.column_name: x.null_count for x in keep[("pre", 1, "data profile")].collect()}["v"] == 2


def test_a_small_day_fails_against_stored_days(spark, scratch, db):
    from dataclasses import replace

    dates = [f"2024-01-{d:02d}" for d in range(1, 13)]
    for i, d in enumerate(dates):
        _files(scratch, d, rows=["1,2.50"] * (1 if i == 11 else 33 + i % 3))
    base = _wf(db, f"{scratch}/in/pos_yyyymmdd.csv", f"{scratch}/in/pos_yyyymmdd.recon")
    load = base.load
    run_workflow(spark, Workflow("wf1", load=replace(load, effective_dates=tuple(dates[:-1]))))
    for gate in (False, True):
        wf = Workflow("wf1", load=replace(load, effective_dates=(dates[-1],)), gate=gate, pre_tasks=(ManagementTask("data quality ml", "pos_file"),))
        assert run_workflow(spark, wf).collect()[0].status == "failed"


def test_control_files_use_the_datasets_delimiter(spark, scratch, db):
    t, r = _files(scratch)
    path = r.replace("yyyymmdd", "20240102")
    with open(path) as f:
        text = f.read().replace("|", ",")
    with open(path, "w") as f:
        f.write(text)
    wf = _wf(db, t, r)
    src = DatasetSpec("pos_file", path_template=t, recon_path_template=r, recon_delimiter=",")
    from dataclasses import replace

    res = run_workflow(spark, replace(wf, load=replace(wf.load, source=src), datasets={"pos_file": src})).collect()
    assert [x.status for x in res if x.step == "post"] == ["ok"]
