import os
from dataclasses import replace

import pytest

from quayside.operators.quality import Rule
from quayside.plans.load import load_to_table
from quayside.plans.workflow import ManagementTask, Workflow, run_workflow
from quayside.spec import DatasetSpec, LoadSpec, TableSpec

COLUMNS = [{"column_name": "id", "data_type": "bigint"}, {"column_name": "price", "data_type": "decimal(9,2)"}]


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("id,price\n" + "\n".join(lines) + "\n")


@pytest.fixture
def spec(scratch, db):
    write(f"{scratch}/in/p_20240101.csv", ["1,2.50", "x,oops", "2,3.00"])
    write(f"{scratch}/in/p_20240102.csv", ["3,1.00", "4,1e", "\"5\",7.00,extra"])
    return LoadSpec(
        source=DatasetSpec("prices", path_template=f"{scratch}/in/p_yyyymmdd.csv"), target=TableSpec(db, "prices", ("effective_date",), "prices_table"), columns=COLUMNS,
        effective_dates=("2024-01-01", "2024-01-02"), date_from_path=True, corrupt_column="_bad", quarantine_table=f"{db}.prices_bad",
    )


def lines(spark, spec):
    return sorted((r.effective_date, r.line, os.path.basename(r.file), r.dataset_id) for r in spark.table(spec.quarantine_table).collect())


def test_parsed_rows_and_raw_lines_each_once(spark, spec):
    for _ in range(2):
        res = load_to_table(spark, spec)
        assert (res.source_count, res.target_count, res.corrupt_count, res.status) == (3, 3, 3, 0)
    got = sorted((r.id, str(r.price), r.effective_date) for r in spark.table(spec.target.qualified).collect())
    assert got == [(1, "2.50", "2024-01-01"), (2, "3.00", "2024-01-01"), (3, "1.00", "2024-01-02")]
    assert lines(spark, spec) == [("2024-01-01", "x,oops", "p_20240101.csv", "prices"), ("2024-01-02", '"5",7.00,extra', "p_20240102.csv", "prices"), ("2024-01-02", "4,1e", "p_20240102.csv", "prices")]


def test_a_corrected_file_empties_its_dates_and_no_other(spark, spec, scratch):
    load_to_table(spark, spec)
    write(f"{scratch}/in/p_20240101.csv", ["1,2.50", "7,9.00", "2,3.00"])
    load_to_table(spark, replace(spec, effective_dates=("2024-01-01",)))
    assert {x[0] for x in lines(spark, spec)} == {"2024-01-02"}
    assert spark.table(spec.target.qualified).count() == 4


def test_quality_tasks_on_the_target_report_the_lines(spark, spec):
    keep = {}
    rules = [Rule("priced", "not_null", "price")]
    out = run_workflow(spark, Workflow("w", load=spec, post_tasks=(ManagementTask("data quality", "prices_table", {"rules": rules}),)), keep=keep).collect()
    report = {r.rule_name: (r.checked_rows, r.failed_rows, r.passed) for r in keep[("post", 0, "data quality")].collect()}
    assert report == {"priced": (3, 0, True), "lines_parse": (6, 3, False)}
    assert [r.status for r in out if r.step == "post"] == ["failed"]


def test_a_clean_batch_makes_an_empty_quarantine(spark, spec, scratch):
    write(f"{scratch}/in/p_20240101.csv", ["1,2.50"])
    write(f"{scratch}/in/p_20240102.csv", [])
    res = load_to_table(spark, spec)
    assert (res.corrupt_count, res.target_count) == (0, 1) and lines(spark, spec) == []


def test_it_needs_a_column_for_the_raw_line(spark, spec):
    with pytest.raises(ValueError):
        load_to_table(spark, replace(spec, corrupt_column=None))
