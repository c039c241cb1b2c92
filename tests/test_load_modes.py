"""Every load mode, each run twice (idempotence), plus the overwrite-safety edge cases."""

import pytest
from pyspark.sql import functions as F

from quayside.plans.load import load_to_table
from quayside.sinks.table import write_table
from quayside.sources.catalog import partition_columns, table_columns
from quayside.spec import DatasetSpec, LoadSpec, TableSpec

SCHEMA = "id long, v double, effective_date string"


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(spark, t):
    return sorted(tuple(r) for r in spark.table(t).collect())


def test_create_partitioned_moves_keys_last(spark, db):
    t = f"{db}.p"
    out = write_table(spark, batch(spark, [(1, 1.0, "2024-01-01")]).select("effective_date", "id", "v"), t, ["effective_date"], "incremental")
    assert out.action == "create_partitioned"
    assert table_columns(spark, t) == ["id", "v", "effective_date"]
    assert partition_columns(spark, t) == ["effective_date"]


def test_partition_overwrite_twice_is_idempotent_and_keeps_other_dates(spark, db):
    t = f"{db}.p"
    write_table(spark, batch(spark, [(1, 1.0, "d1"), (2, 2.0, "d2")]), t, ["effective_date"])
    b2 = batch(spark, [(3, 3.0, "d2"), (4, 4.0, "d3")])
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for _ in range(2):
        out = write_table(spark, b2, t, ["effective_date"], "incremental")
    assert out.action == "partition_overwrite"
    assert rows(spark, t) == [(1, 1.0, "d1"), (3, 3.0, "d2"), (4, 4.0, "d3")]
    # The session setting is restored after the write
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_partition_overwrite_is_dynamic_even_under_a_static_session(spark, db):
    t = f"{db}.p"
    write_table(spark, batch(spark, [(1, 1.0, "d1"), (2, 2.0, "d2")]), t, ["effective_date"])
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, "STATIC")
    try:
        # a plain Spark overwrite of one partition, not through write_table
        batch(spark, [(3, 3.0, "d2")]).write.insertInto(t, overwrite=True)
    finally:
        spark.conf.set(key, old)
    assert rows(spark, t) == [(1, 1.0, "d1"), (3, 3.0, "d2")]


def test_partition_overwrite_into_a_table_created_elsewhere(spark, db):
    t = f"{db}.ext"
    batch(spark, [(1, 1.0, "d1"), (2, 2.0, "d2")]).write.saveAsTable(t, format="parquet", partitionBy=["effective_date"])
    write_table(spark, batch(spark, [(3, 3.0, "d2")]), t, ["effective_date"], "incremental")
    assert rows(spark, t) == [(1, 1.0, "d1"), (3, 3.0, "d2")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_append_twice_duplicates(spark, db):
    t = f"{db}.u"
    write_table(spark, batch(spark, [(1, 1.0, "d1")]), t, [], "incremental")
    out = write_table(spark, batch(spark, [(1, 1.0, "d1")]).select("v", "effective_date", "id"), t, [], "incremental")
    assert out.action == "append" and not out.idempotent
    assert rows(spark, t) == [(1, 1.0, "d1"), (1, 1.0, "d1")]


@pytest.mark.parametrize("keys", [[], ["effective_date"]])
def test_full_overwrite_twice_replaces_schema(spark, db, keys):
    t = f"{db}.f{len(keys)}"
    write_table(spark, batch(spark, [(1, 1.0, "d1"), (2, 2.0, "d2")]), t, [], "full")
    new = spark.createDataFrame([(9, "x", "d9")], "id long, tag string, effective_date string")
    for _ in range(2):
        out = write_table(spark, new, t, keys, "full")
    assert out.action == ("full_overwrite_partitioned" if keys else "full_overwrite")
    assert rows(spark, t) == [(9, "x", "d9")]
    assert partition_columns(spark, t) == keys
    assert not [x for x in spark.catalog.listTables(db) if "__" in x.name]  # no staging left over


def test_failed_full_overwrite_keeps_old_table(spark, db):
    # The new data is written under a staging name; a failing job leaves the old table
    t = f"{db}.safe"
    write_table(spark, batch(spark, [(1, 1.0, "d1")]), t, [], "full")
    bad = batch(spark, [(2, 2.0, "d2")]).withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        write_table(spark, bad, t, [], "full")
    assert rows(spark, t) == [(1, 1.0, "d1")]


def test_unsupported_load_type_is_refused_before_any_write(spark, db):
    # K8 and E5: also when the table does not exist yet
    with pytest.raises(ValueError, match="is none of"):
        write_table(spark, batch(spark, [(1, 1.0, "d1")]), f"{db}.never", [], "upsert")
    assert not spark.catalog.tableExists(f"{db}.never")


def test_missing_column_in_incremental_batch_raises(spark, db):
    t = f"{db}.m"
    write_table(spark, batch(spark, [(1, 1.0, "d1")]), t, ["effective_date"])
    with pytest.raises(Exception, match="(?i)unresolved|cannot be resolved|v"):
        write_table(spark, batch(spark, [(1, 1.0, "d1")]).drop("v"), t, ["effective_date"])


def _load(spark, db, df, dates, table="ev", load_type="incremental"):
    spec = LoadSpec(
        source=DatasetSpec("in"), target=TableSpec(db, table, ("effective_date",)), columns=[],
        load_type=load_type, effective_dates=tuple(dates),
    )
    return load_to_table(spark, spec, source=df)


def test_observed_counts_per_date_and_null_partition(spark, db):
    # Rows with a null date land in the default partition and are still counted
    df = batch(spark, [(1, 1.0, "d1"), (2, 2.0, "d1"), (3, 3.0, None)])
    res = _load(spark, db, df, ["d1"])
    got = {r.effective_date: (r.source_count, r.target_count, r.is_match) for r in res.report_rows}
    assert got == {"d1": (2, 2, True), None: (1, 1, True)}
    assert res.status == 0 and res.source_count == 3


def test_older_null_dates_do_not_fail_a_later_batch(spark, db):
    _load(spark, db, batch(spark, [(1, 1.0, "d1"), (3, 3.0, None)]), ["d1"])
    res = _load(spark, db, batch(spark, [(2, 2.0, "d2")]), ["d2"])
    assert res.status == 0 and [tuple(r) for r in res.report_rows] == [("d2", 1, 1, True)]


def test_batch_with_unexpected_dates_is_reported(spark, db):
    # A file holding several dates is compared per date, not file total vs one date
    df = batch(spark, [(1, 1.0, "d1"), (2, 2.0, "d2")])
    res = _load(spark, db, df, ["d1"])
    got = {r.effective_date: (r.source_count, r.target_count) for r in res.report_rows}
    assert got == {"d1": (1, 1), "d2": (1, 1)} and res.status == 0


def test_mismatch_is_reported_and_strict_raises(spark, db):
    from quayside.plans.load import LoadMismatchError

    _load(spark, db, batch(spark, [(1, 1.0, "d1")]), ["d1"], table="a", load_type="incremental")
    # Appending into an unpartitioned copy with old rows of the same date: target > source
    t = f"{db}.flat"
    write_table(spark, batch(spark, [(0, 0.0, "d1")]), t, [], "full")
    spec = LoadSpec(source=DatasetSpec("in"), target=TableSpec(db, "flat"), columns=[], load_type="incremental",
                    effective_dates=("d1",), strict=False)
    res = load_to_table(spark, spec, source=batch(spark, [(1, 1.0, "d1")]))
    assert res.status == 1 and [(r.source_count, r.target_count) for r in res.report_rows] == [(1, 2)]
    strict = LoadSpec(**{**spec.__dict__, "strict": True})
    with pytest.raises(LoadMismatchError):
        load_to_table(spark, strict, source=batch(spark, [(1, 1.0, "d1")]))


def test_empty_batch_changes_nothing(spark, db):
    # An empty batch under partition overwrite keeps the partition; reported, not hidden
    _load(spark, db, batch(spark, [(1, 1.0, "d1")]), ["d1"])
    res = _load(spark, db, batch(spark, []), ["d1"])
    assert [(r.source_count, r.target_count, r.is_match) for r in res.report_rows] == [(0, 1, False)]
    assert rows(spark, f"{db}.ev") == [(1, 1.0, "d1")]


def test_rebalanced_write_splits_a_hot_date(spark, db):
    df = spark.range(0, 20000).select(F.col("id"), (F.col("id") * 0.5).alias("v"), F.lit("d1").alias("effective_date"))
    spec = LoadSpec(source=DatasetSpec("in"), target=TableSpec(db, "hot", ("effective_date",)), columns=[],
                    effective_dates=("d1",), rebalance=True)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "16k")  # tiny pieces so the split is visible at test size
    try:
        res = load_to_table(spark, spec, source=df)
    finally:
        spark.conf.set(key, old)
    assert res.status == 0 and res.target_count == 20000
    files = spark.table(f"{db}.hot").select(F.input_file_name()).distinct().count()
    assert files > 1


def test_unpartitioned_target_counted_whole(spark, db):
    # No date column in the table: the whole table is counted
    t = f"{db}.nodate"
    df = spark.createDataFrame([(1,), (2,)], "id long")
    spec = LoadSpec(source=DatasetSpec("in"), target=TableSpec(db, "nodate"), columns=[], load_type="full")
    res = load_to_table(spark, spec, source=df)
    assert [(r.effective_date, r.source_count, r.target_count) for r in res.report_rows] == [(None, 2, 2)]


def test_corrupt_rows_are_counted_during_the_load_and_not_written(spark, scratch, db):
    # E17 routed into the load: bad fields load as null, the rows are counted in the same pass
    import os

    os.makedirs(f"{scratch}/in", exist_ok=True)
    with open(f"{scratch}/in/amt_20240101.csv", "w") as f:
        f.write("id,amt,effective_date\n1,10.50,2024-01-01\n2,abc,2024-01-01\n3,7.25,2024-01-01\n")
    spec = LoadSpec(
        source=DatasetSpec("amt", path_template=f"{scratch}/in/amt_yyyymmdd.csv"),
        target=TableSpec(db, "amt", ("effective_date",)),
        columns=[{"column_name": "id", "data_type": "int"}, {"column_name": "amt", "data_type": "decimal(10,2)"},
                 {"column_name": "effective_date", "data_type": "string"}],
        effective_dates=("2024-01-01",), corrupt_column="_corrupt_record",
    )
    for _ in range(2):  # create, then partition overwrite
        res = load_to_table(spark, spec)
        assert (res.status, res.source_count, res.target_count, res.corrupt_count) == (0, 3, 3, 1)
    assert table_columns(spark, f"{db}.amt") == ["id", "amt", "effective_date"]
    assert sorted((r.id, r.amt is None) for r in spark.table(f"{db}.amt").collect()) == [(1, False), (2, True), (3, False)]


def test_long_backfill_is_counted_by_a_second_pass_with_the_same_report(spark, db):
    from quayside.operators.validate import MAX_OBSERVED_DATES

    for n_dates, table in ((MAX_OBSERVED_DATES + 8, "long"), (5, "short")):
        dates = [f"d{i:03d}" for i in range(n_dates)]
        df = batch(spark, [(i, float(i), dates[i % n_dates]) for i in range(3 * n_dates + 2)])
        res = _load(spark, db, df, dates, table=table)
        want = {d: (3 + (i < 2), 3 + (i < 2), True) for i, d in enumerate(dates)}
        assert {r.effective_date: (r.source_count, r.target_count, r.is_match) for r in res.report_rows} == want
        assert res.status == 0 and res.source_count == 3 * n_dates + 2


@pytest.mark.parametrize("n_dates", [32, 33, 60])
def test_expected_dates_without_rows_are_reported(spark, db, n_dates):
    dates = [f"d{i:03d}" for i in range(n_dates)]
    df = batch(spark, [(i, float(i), d) for i, d in enumerate(dates) if d != "d007"] + [(999, 1.0, "other")])
    res = _load(spark, db, df, dates, table="gaps")
    want = {d: (int(d != "d007"),) * 2 + (True,) for d in dates} | {"other": (1, 1, True)}
    assert {r.effective_date: (r.source_count, r.target_count, r.is_match) for r in res.report_rows} == want
    assert sorted(map(tuple, res.report.collect())) == sorted(map(tuple, res.report_rows))


@pytest.mark.parametrize("keys", [(), ("effective_date",)])
def test_a_replacement_that_stopped_before_the_rename_is_finished(spark, db, monkeypatch, keys):
    import quayside.sinks.table as T

    t = f"{db}.snap"
    write_table(spark, batch(spark, [(1, 1.0, "2024-01-01")]), t, keys, "full")
    real = T._rename

    def stop(*args):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(T, "_rename", stop)
    with pytest.raises(RuntimeError, match="lost the driver"):
        write_table(spark, batch(spark, [(2, 2.0, "2024-01-02"), (3, 3.0, "2024-01-03")]), t, keys, "full")
    assert not spark.catalog.tableExists(t)
    monkeypatch.setattr(T, "_rename", real)
    write_table(spark, batch(spark, [(4, 4.0, "2024-01-04")]), t, keys, "incremental")
    first = spark.table(t).columns[0]
    assert len(spark.table(t).select(first).collect()) == 3
    assert [x.name for x in spark.catalog.listTables(db)] == ["snap"]


def test_a_failed_replacement_keeps_the_table_and_leaves_no_staging_table(spark, db):
    t = f"{db}.snap"
    write_table(spark, batch(spark, [(1, 1.0, "2024-01-01")]), t, (), "full")
    bad = batch(spark, [(2, 2.0, "2024-01-02")]).withColumn("x", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        write_table(spark, bad, t, (), "full")
    assert spark.table(t).count() == 1 and [x.name for x in spark.catalog.listTables(db)] == ["snap"]
