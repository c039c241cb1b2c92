"""Full replacement by version folders: the table exists and is whole after every step."""

import pytest
from pyspark.sql import functions as F

import quayside.sinks.versions as V
from quayside.sinks.versions import replace_version, roll_back, versions

SCHEMA = "id long, v double"


def batch(spark, *ids):
    return spark.createDataFrame([(i, float(i)) for i in ids], SCHEMA)


def ids(spark, t):
    return sorted(r.id for r in spark.table(t).collect())


def test_replacements_switch_the_location_and_old_versions_expire(spark, db):
    t = f"{db}.snap"
    assert replace_version(spark, batch(spark, 1, 2), t).action == "version_created"
    for i in range(3, 7):
        assert replace_version(spark, batch(spark, i).select("v", "id"), t).action == "version_replaced"
        assert ids(spark, t) == [i] and len(versions(spark, t)) == 2
    assert roll_back(spark, t) == versions(spark, t)[0] and ids(spark, t) == [5]
    with pytest.raises(ValueError, match="no earlier"):
        roll_back(spark, t)
    replace_version(spark, batch(spark), t)  # an empty batch is an empty version
    assert ids(spark, t) == []


@pytest.mark.parametrize("step", ["_switch", "_expire"])
def test_a_run_that_stops_after_any_step_leaves_a_whole_table(spark, db, monkeypatch, step):
    t = f"{db}.snap"
    replace_version(spark, batch(spark, 1, 2), t)

    def stop(*args):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(V, step, stop)
        with pytest.raises(RuntimeError, match="lost the driver"):
            replace_version(spark, batch(spark, 3), t)
    assert ids(spark, t) == ([1, 2] if step == "_switch" else [3])
    replace_version(spark, batch(spark, 4), t)
    assert ids(spark, t) == [4] and len(versions(spark, t)) == 2
    roll_back(spark, t)  # to a version that was shown
    assert ids(spark, t) == ([1, 2] if step == "_switch" else [3])


def test_a_table_made_again_goes_on_from_its_folders(spark, db):
    t = f"{db}.snap"
    replace_version(spark, batch(spark, 1), t)
    spark.sql(f"DROP TABLE {t}")
    replace_version(spark, batch(spark, 2), t)
    assert ids(spark, t) == [2] and len(versions(spark, t)) == 2


def test_a_failed_write_keeps_the_version_and_its_folder_goes_later(spark, db):
    t = f"{db}.snap"
    replace_version(spark, batch(spark, 1), t)
    bad = spark.range(2, 4).select("id", F.when(F.col("id") == 3, F.raise_error(F.lit("boom")).cast("double")).otherwise(1.0).alias("v"))
    with pytest.raises(Exception, match="boom"):
        replace_version(spark, bad, t)
    assert ids(spark, t) == [1]
    replace_version(spark, batch(spark, 5), t, keep=1)
    root = V.table_location(spark, t).rpartition("/")[0]
    assert ids(spark, t) == [5] and len(V._Files(spark, root).names(root)) == 1


def test_a_frame_on_the_old_version_can_replace_it(spark, db):
    t = f"{db}.snap"
    replace_version(spark, batch(spark, 1, 2, 3), t)
    replace_version(spark, spark.table(t).where("id > 1"), t)
    assert ids(spark, t) == [2, 3]


def test_other_columns_and_other_tables_are_refused(spark, db):
    t = f"{db}.snap"
    replace_version(spark, batch(spark, 1), t)
    for other in (batch(spark, 2).drop("v"), batch(spark, 2).withColumn("x", F.lit(1)), batch(spark, 2).withColumn("v", F.lit("a"))):
        with pytest.raises(ValueError, match="columns of the batch differ"):
            replace_version(spark, other, t)
    batch(spark, 1).write.saveAsTable(f"{db}.plain", format="parquet")
    with pytest.raises(ValueError, match="no versioned table"):
        replace_version(spark, batch(spark, 2), f"{db}.plain")
    assert ids(spark, t) == [1] and ids(spark, f"{db}.plain") == [1]
