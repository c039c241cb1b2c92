import os

import pytest

from quayside.spec import DatasetSpec, LoadSpec, TableSpec
from quayside.streaming.landing import ingest_landing

SPEC = [{"column_name": "id", "data_type": "bigint"}, {"column_name": "v", "data_type": "double"}]


def _land(root, day, n):
    d = f"{root}/ev_{day}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/part-00000.csv", "w") as f:
        f.write("id,v\n" + "".join(f"{i},{i}.25\n" for i in range(n)))


def test_landing_stream_loads_each_file_once(spark, scratch, db):
    root = f"{scratch}/landing"
    _land(root, "20240101", 3)
    _land(root, "20240102", 2)
    spec = LoadSpec(source=DatasetSpec("ev", path_template=f"{root}/ev_yyyymmdd"),
                    target=TableSpec(db, "ev", ("effective_date",)), columns=SPEC, date_from_path=True)
    ckpt = f"{scratch}/ckpt"
    _, res = ingest_landing(spark, spec, ckpt)
    assert [(r.status, r.source_count) for r in res] == [(0, 5)]
    _land(root, "20240103", 4)  # a new day lands
    _, res2 = ingest_landing(spark, spec, ckpt)
    assert [(r.status, r.source_count, r.target_count) for r in res2] == [(0, 4, 4)]
    _, res3 = ingest_landing(spark, spec, ckpt)  # nothing new: nothing loaded
    assert res3 == []
    counts = {r[0]: r[1] for r in spark.table(f"{db}.ev").groupBy("effective_date").count().collect()}
    assert counts == {"2024-01-01": 3, "2024-01-02": 2, "2024-01-03": 4}


def _spec(db, root, name="ev", keys=("effective_date",), **more):
    source = DatasetSpec(name, path_template=f"{root}/ev_yyyymmdd", options=more.pop("options", {}))
    return LoadSpec(source=source, target=TableSpec(db, name, keys), columns=SPEC, date_from_path=True, **more)


def test_split_dates_and_late_files_keep_every_row(spark, scratch, db):
    root = f"{scratch}/landing"
    _land(root, "20240101", 2)
    for part, text in (("part-00001.csv", "id,v\n10,1.0\n11,1.0\n"), ("part-00002.csv", "id,v\n20,1.0\n21,1.0\n")):
        with open(f"{root}/ev_20240101/{part}", "w") as f:
            f.write(text)
    ckpt = f"{scratch}/ckpt"
    _, res = ingest_landing(spark, _spec(db, root), ckpt, max_files_per_trigger=1)
    assert {r.status for r in res} == {0} and len(res) == 3
    assert sorted(r.id for r in spark.table(f"{db}.ev").collect()) == [0, 1, 10, 11, 20, 21]
    with open(f"{root}/ev_20240101/late.csv", "w") as f:
        f.write("id,v\n30,1.0\n")
    ingest_landing(spark, _spec(db, root), ckpt)
    assert sorted(r.id for r in spark.table(f"{db}.ev").collect()) == [0, 1, 10, 11, 20, 21, 30]


def test_stream_uses_the_reader_options_and_refuses_appends(spark, scratch, db):
    root = f"{scratch}/landing"
    _land(root, "20240101", 3)
    _, res = ingest_landing(spark, _spec(db, root, options={"comment": "1"}), f"{scratch}/ckpt")
    assert [r.source_count for r in res] == [2]  # the line that begins with 1 is a comment
    with pytest.raises(ValueError, match="replayed"):
        ingest_landing(spark, _spec(db, root, "plain", keys=()), f"{scratch}/ckpt2")


def test_dates_in_the_data(spark, scratch, db):
    root = f"{scratch}/landing"
    spec = LoadSpec(source=DatasetSpec("d", path_template=f"{root}/ev_yyyymmdd.csv"), target=TableSpec(db, "d", ("effective_date",)),
                    columns=[SPEC[0], {"column_name": "effective_date", "data_type": "string"}])
    os.makedirs(root)
    for day, rows in (("20240101", "1,2024-01-01\n2,2024-01-02\n"), ("20240102", "3,2024-01-02\n")):
        with open(f"{root}/ev_{day}.csv", "w") as f:
            f.write("id,effective_date\n" + rows)
    _, res = ingest_landing(spark, spec, f"{scratch}/ckpt", max_files_per_trigger=1)
    assert {r.status for r in res} == {0}
    assert sorted((r.id, r.effective_date) for r in spark.table(f"{db}.d").collect()) == [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02")]
