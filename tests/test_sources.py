import os

import pytest
from pyspark.sql import functions as F

from quayside.functions.schema import column_spec_to_schema
from quayside.plans.load import load_to_table
from quayside.operators.validate import sample_loaded
from quayside.sources.delimited import (
    SourceMissingError, read_dated_files, read_delimited, resolve_dated_path, to_spark_uri,
)
from quayside.spec import DatasetSpec, LoadSpec, TableSpec

# Fixed value: the nine-row golden sample input of the reference's README.
ACCT_POSITIONS = """effective_date,account_id,asset_id,asset_value
2024-12-26,ACC1,1,-35000
2024-12-26,ACC1,2,-15000
2024-12-26,ACC2,2,10000
2024-12-26,ACC4,1,-5000
2024-12-26,ACC5,1,-5000
2024-12-26,ACC6,1,-5000
2024-12-26,ACC7,1,-5000
2024-12-26,ACC8,1,-5000
2024-12-26,ACC9,1,-5000
"""
ACCT_SPEC = [
    {"column_name": "effective_date", "data_type": "string"},
    {"column_name": "account_id", "data_type": "string"},
    {"column_name": "asset_id", "data_type": "string"},
    {"column_name": "asset_value", "data_type": "string"},
]


def _write(path, text):
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_readme_golden_sample(spark, scratch, db):
    _write(f"{scratch}/in/acct_positions_20241226.csv", ACCT_POSITIONS)
    spec = LoadSpec(
        source=DatasetSpec("dataset_2", path_template=f"{scratch}/in/acct_positions_yyyymmdd.csv"),
        target=TableSpec(db, "tacct_pos", ("effective_date",)),
        columns=ACCT_SPEC, load_type="incremental", effective_dates=("2024-12-26",), parity=True,
    )
    res = load_to_table(spark, spec)
    t = spark.table(res.table)
    # Schema: four string columns, partition key last.
    assert [(f.name, f.dataType.simpleString()) for f in t.schema.fields] == [
        ("account_id", "string"), ("asset_id", "string"), ("asset_value", "string"), ("effective_date", "string"),
    ]
    assert (res.status, res.source_count, res.target_count) == (0, 9, 9)
    assert [tuple(r) for r in res.report_rows] == [("2024-12-26", 9, 9, True)]
    top2 = sample_loaded(spark, res.table, "2024-12-26", order_by=["account_id", "asset_id"]).collect()
    assert [tuple(r) for r in top2] == [("ACC1", "1", "-35000", "2024-12-26"), ("ACC1", "2", "-15000", "2024-12-26")]


def test_uri_rewrite_and_template():
    assert to_spark_uri("s3://bucket/a/b.csv") == "s3a://bucket/a/b.csv"
    assert resolve_dated_path("s3://b/x_yyyymmdd.csv", "2024-12-26") == "s3a://b/x_20241226.csv"
    assert resolve_dated_path("/in/{data_source_user}/x_yyyymmdd.csv", "2024-01-02", "u1") == "/in/u1/x_20240102.csv"
    with pytest.raises(ValueError):
        resolve_dated_path("/in/x.csv", "2024-01-02")


def test_missing_source_raises(spark, scratch):
    schema = column_spec_to_schema(ACCT_SPEC)
    with pytest.raises(SourceMissingError, match="no source at"):
        read_delimited(spark, f"{scratch}/nope.csv", schema, dataset_id="dataset_2")


def test_reordered_header_is_refused(spark, scratch):
    # A spec in a different order than the file header must fail, not shift columns
    p = _write(f"{scratch}/in/a.csv", "b,a\n1,2\n")
    spec = [{"column_name": "a", "data_type": "int"}, {"column_name": "b", "data_type": "int"}]
    with pytest.raises(Exception, match="(?i)header|CSV"):
        read_delimited(spark, p, column_spec_to_schema(spec)).collect()


def test_corrupt_rows_are_kept_and_visible(spark, scratch):
    # An unparseable decimal gives null plus the raw line in the corrupt column
    p = _write(f"{scratch}/in/c.csv", "id,amt\n1,10.50\n2,abc\n")
    spec = [{"column_name": "id", "data_type": "int"}, {"column_name": "amt", "data_type": "decimal(10,2)"}]
    df = read_delimited(spark, p, column_spec_to_schema(spec), corrupt_column="_corrupt_record")
    rows = sorted(df.select("id", "amt", "_corrupt_record").collect())
    assert rows[0]["amt"] is not None and rows[0]["_corrupt_record"] is None
    assert rows[1]["amt"] is None and rows[1]["_corrupt_record"] == "2,abc"


def test_dated_files_one_scan_with_date_from_path(spark, scratch):
    for d, n in (("20240101", 2), ("20240102", 3)):
        _write(f"{scratch}/land/ev_{d}.csv", "id,v\n" + "".join(f"{i},{i}.5\n" for i in range(n)))
    spec = [{"column_name": "id", "data_type": "bigint"}, {"column_name": "v", "data_type": "double"}]
    df = read_dated_files(spark, f"{scratch}/land/ev_yyyymmdd.csv", ["2024-01-01", "2024-01-02"], column_spec_to_schema(spec))
    got = {r[0]: r[1] for r in df.groupBy("effective_date").count().collect()}
    assert got == {"2024-01-01": 2, "2024-01-02": 3}
    assert df.columns == ["id", "v", "effective_date"]


def test_sql_file_source(spark, scratch):
    from quayside.sources.sqlfile import read_sql_file

    p = _write(f"{scratch}/q.sql", "SELECT :x AS a, 2 AS b;\n")
    assert read_sql_file(spark, p, {"x": 1}).collect()[0].asDict() == {"a": 1, "b": 2}


def test_schema_as_option_is_ignored_so_it_is_passed_to_the_reader(spark, scratch):
    # The older form set the schema as a reader option, which Spark ignores (all
    # columns come back as strings); read_delimited passes it with .schema().
    p = _write(f"{scratch}/in/s7.csv", "id,amt\n1,2.50\n")
    spec = [{"column_name": "id", "data_type": "int"}, {"column_name": "amt", "data_type": "decimal(10,2)"}]
    schema = column_spec_to_schema(spec)
    ignored = spark.read.format("csv").option("header", "true").option("schema", schema.json()).load(p)
    assert [f.dataType.simpleString() for f in ignored.schema.fields] == ["string", "string"]
    typed = read_delimited(spark, p, schema)
    assert [f.dataType.simpleString() for f in typed.schema.fields] == ["int", "decimal(10,2)"]


def test_source_dates_differ_from_effective_date(spark, scratch, db):
    # The file is named by the source schedule's date, the load is for the target's date
    from quayside.plans.load import run_ingestion_task

    _write(f"{scratch}/in/acct_positions_20241227.csv", ACCT_POSITIONS)
    spec = LoadSpec(
        source=DatasetSpec("dataset_2", path_template=f"{scratch}/in/acct_positions_yyyymmdd.csv"),
        target=TableSpec(db, "tacct_pos", ("effective_date",), "dataset_12"),
        columns=ACCT_SPEC, effective_dates=("2024-12-26",), source_dates=("2024-12-27",), parity=True,
    )
    status, result = run_ingestion_task(spark, spec)
    assert status == 0
    assert (result["source record count"], result["target record count"]) == (9, 9)
    assert result["source dataset name"].endswith("acct_positions_20241227.csv")


def test_text_into_decimal_column_is_refused_but_typed_scan_loads(spark, scratch, db):
    # Spark 4 refuses to insert text into an existing decimal column; the declared
    # schema types the scan, so the load works.
    from quayside.sinks.table import write_table

    t = f"{db}.dec"
    write_table(spark, spark.createDataFrame([("1.50",)], "x string").selectExpr("CAST(x AS DECIMAL(10,2)) x"), t, (), "full")
    with pytest.raises(Exception, match="(?i)cast|CANNOT_SAFELY|safely"):
        write_table(spark, spark.createDataFrame([("2.50",)], "x string"), t, (), "incremental")
    p = _write(f"{scratch}/in/dec.csv", "x\n2.50\n")
    typed = read_delimited(spark, p, column_spec_to_schema([{"column_name": "x", "data_type": "decimal(10,2)"}]))
    write_table(spark, typed, t, (), "incremental")
    assert sorted(float(r.x) for r in spark.table(t).collect()) == [1.5, 2.5]


def test_reader_options_reach_the_scan(spark, scratch, db):
    # quoted field with an embedded newline needs multiLine; NA marks a null
    _write(f"{scratch}/in/notes_20240101.csv", 'id,note\n1,"line one\nline two"\n2,NA\n')
    spec = LoadSpec(
        source=DatasetSpec("notes", path_template=f"{scratch}/in/notes_yyyymmdd.csv",
                           options={"multiLine": "true", "nullValue": "NA"}),
        target=TableSpec(db, "notes"), columns=[{"column_name": "id", "data_type": "int"}, {"column_name": "note", "data_type": "string"}],
        load_type="full", effective_dates=("2024-01-01",),
    )
    res = load_to_table(spark, spec)
    assert res.status == 0 and res.source_count == 2
    assert sorted(tuple(r) for r in spark.table(f"{db}.notes").collect()) == [(1, "line one\nline two"), (2, None)]


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from quayside.session import checkpoint_root

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:  # a cluster session without spark.checkpoint.dir (no JVM needed)
        conf = Conf({"spark.master": "yarn"})

        @property
        def sparkContext(self):
            raise RuntimeError("no context")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir is not set"):
        checkpoint_root(Session())
    Session.conf = Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://nn/ckpt/"})
    assert checkpoint_root(Session()) == "hdfs://nn/ckpt"


@pytest.mark.parametrize("days", [1, 8, 9, 40])
@pytest.mark.parametrize("template", ["ev_yyyymmdd_*.csv", "my ev+yyyymmdd.csv", "store12345678/l3/yyyymmdd/ev.csv", "d_yyyymmdd/e?_yyyymmdd.{csv,txt}", "é%/[ab]_yyyymmdd"])
def test_dates_come_from_the_whole_path_for_any_number_of_dates(spark, scratch, template, days):
    from datetime import date, timedelta

    from quayside.functions.schema import column_spec_to_schema
    from quayside.sources.delimited import read_dated_files

    schema = column_spec_to_schema([{"column_name": "id", "data_type": "bigint"}])
    dates = [date(2024, 1, 1) + timedelta(days=i) for i in range(days)]
    for i, d in enumerate(dates):
        path = f"{scratch}/{template}".replace("yyyymmdd", f"{d:%Y%m%d}").replace("_*", "_99999999").replace("e?", "ex").replace("{csv,txt}", "txt").replace("[ab]", "b")
        if template.endswith("[ab]_yyyymmdd"):
            path += "/part 1.csv"  # a folder of that name
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(f"id\n{i}\n{i}\n")
    got = sorted(tuple(r) for r in read_dated_files(spark, f"{scratch}/{template}", dates, schema).collect())
    assert got == sorted((i, d.isoformat()) for i, d in enumerate(dates) for _ in range(2))


def test_a_path_without_its_date_is_an_error(spark):
    from quayside.sources.delimited import date_from_path_column

    paths = spark.createDataFrame([("file:/x/ev_2024011.csv",)], "p string")
    with pytest.raises(Exception, match="no effective date"):
        paths.select(date_from_path_column("/x/ev_yyyymmdd.csv", F.col("p"))).collect()
    two = spark.createDataFrame([("file:/x/20240101/ev_20240102.csv",)], "p string")
    with pytest.raises(Exception, match="no effective date"):
        two.select(date_from_path_column("/x/yyyymmdd/ev_yyyymmdd.csv", F.col("p"))).collect()
