import os

import pytest
from pyspark.sql import functions as F

from quayside.plans.load import load_to_table
from quayside.sinks import ledger
from quayside.sinks.ledger import append_once, read_ledger, recover_appends, source_files
from quayside.spec import DatasetSpec, LoadSpec, TableSpec

COLUMNS = [{"column_name": "id", "data_type": "bigint"}, {"column_name": "v", "data_type": "string"}]


def write(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("id,v\n" + "".join(f"{i},{v}\n" for i, v in rows))


def spec_of(scratch, db, **more):
    return LoadSpec(source=DatasetSpec("f", path_template=f"{scratch}/in/f_yyyymmdd.csv"), target=TableSpec(db, "t"), columns=COLUMNS, ledger=True, **more)


def rows(spark, db):
    return sorted(tuple(r) for r in spark.table(f"{db}.t").collect())


def load(spark, scratch, db, *days, **more):
    return load_to_table(spark, spec_of(scratch, db, effective_dates=days, **more))


def test_a_rerun_and_an_overlapping_run_add_nothing_twice(spark, scratch, db):
    write(f"{scratch}/in/f_20240101.csv", [(1, "a"), (1, "a")])
    write(f"{scratch}/in/f_20240102.csv", [(2, "b")])
    first = load(spark, scratch, db, "2024-01-01")
    assert (first.action, first.source_count, first.target_count, first.status) == ("append", 2, 2, 0)
    again = load(spark, scratch, db, "2024-01-01")
    assert (again.action, again.source_count, again.status) == ("append_known", 0, 0)
    assert load(spark, scratch, db, "2024-01-01", "2024-01-02").source_count == 1
    assert rows(spark, db) == [(1, "a"), (1, "a"), (2, "b")]
    assert read_ledger(spark, f"{db}.t").count() == 2
    write(f"{scratch}/in/f_20240102.csv", [(2, "b"), (3, "new")])  # another file under that name
    assert load(spark, scratch, db, "2024-01-02").source_count == 2
    assert len(rows(spark, db)) == 5


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["entry", "data", "first rename", "all renames"])
def test_a_run_that_stops_after_any_step_is_finished_or_repeated(spark, scratch, db, monkeypatch, step):
    write(f"{scratch}/in/f_20240101.csv", [(1, "a")])
    load(spark, scratch, db, "2024-01-01")
    for part in range(3):
        write(f"{scratch}/in/f_20240102.csv/part-{part}.csv", [(10 + part, "b"), (20 + part, "c")])
    real_publish, real_rename, real_typed = ledger._publish, ledger._Files.rename, ledger._typed
    moved = []

    def stop(*a):
        raise Stopped

    def rename_once(self, a, b):
        if moved:
            raise Stopped
        moved.append(a)
        real_rename(self, a, b)

    if step == "entry":
        monkeypatch.setattr(ledger, "_typed", stop)
    elif step == "data":
        monkeypatch.setattr(ledger, "_publish", stop)
    elif step == "first rename":
        monkeypatch.setattr(ledger._Files, "rename", rename_once)
    else:
        monkeypatch.setattr(ledger, "_publish", lambda *a: (real_publish(*a), stop()))
    with pytest.raises(Stopped):
        load(spark, scratch, db, "2024-01-02")
    monkeypatch.setattr(ledger, "_publish", real_publish)
    monkeypatch.setattr(ledger._Files, "rename", real_rename)
    monkeypatch.setattr(ledger, "_typed", real_typed)
    load(spark, scratch, db, "2024-01-02")
    want = sorted([(1, "a")] + [(10 + p, "b") for p in range(3)] + [(20 + p, "c") for p in range(3)])
    assert rows(spark, db) == want
    load(spark, scratch, db, "2024-01-01", "2024-01-02")
    assert rows(spark, db) == want


def test_recovery_by_hand_and_leftovers(spark, scratch, db):
    write(f"{scratch}/in/f_20240101.csv", [(1, "a")])
    load(spark, scratch, db, "2024-01-01")
    root = ledger.table_location(spark, f"{db}.t")
    spark.range(3).write.json(f"{root}/_ledger/undecided/entry")
    assert recover_appends(spark, f"{db}.t") == 0
    assert "undecided" not in ledger._Files(spark, root).names(f"{root}/_ledger")
    assert rows(spark, db) == [(1, "a")]


def test_names_that_look_like_globs_and_dates_from_paths(spark, scratch, db):
    write(f"{scratch}/in/f_20240101.csv/part [1] {{x}}.csv", [(1, "a")])
    spec = spec_of(scratch, db, effective_dates=("2024-01-01",), date_from_path=True)
    for _ in range(2):
        load_to_table(spark, spec)
    assert [tuple(r) for r in spark.table(f"{db}.t").collect()] == [(1, "a", "2024-01-01")]


def test_refusals(spark, scratch, db):
    write(f"{scratch}/in/f_20240101.csv", [(1, "a")])
    with pytest.raises(ValueError):
        load(spark, scratch, db, "2024-01-01", load_type="full")
    with pytest.raises(RuntimeError):
        load(spark, scratch, db, "2024-02-02")
    spark.createDataFrame([(1, "a")], "id int, v string").write.saveAsTable(f"{db}.narrow", format="parquet")
    files = source_files(spark, [f"{scratch}/in/f_20240101.csv"])
    with pytest.raises(ValueError):  # a bigint does not go into an int
        append_once(spark, f"{db}.narrow", files, lambda p: spark.range(1).select("id", F.lit("x").alias("v")))
    spark.range(1).withColumn("k", F.lit("d")).write.saveAsTable(f"{db}.keyed", format="parquet", partitionBy=["k"])
    with pytest.raises(ValueError):
        append_once(spark, f"{db}.keyed", files, lambda p: spark.range(1))


def test_full_replacement_forgets_the_ledger(spark, scratch, db):
    from quayside.sinks.table import write_table

    write(f"{scratch}/in/f_20240101.csv", [(1, "a")])
    load(spark, scratch, db, "2024-01-01")
    write_table(spark, spark.createDataFrame([(9, "z")], "id long, v string"), f"{db}.t", (), "full")
    load(spark, scratch, db, "2024-01-01")
    assert rows(spark, db) == [(1, "a"), (9, "z")]
