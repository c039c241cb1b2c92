import contextlib
import io
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators.anomaly import daily_counts, volume_against_history, volume_anomalies
from quayside.operators.state import complete_state, daily_state, daily_volumes, merged_profile, stored_dates, update_state
from quayside.sinks.ledger import _Files, table_location
from quayside.sinks.table import write_table


@pytest.fixture
def sales(spark, db):
    """Ten days of sales, the last one many times larger."""
    r = np.random.default_rng(3)
    rows = [(f"2024-01-{d:02d}", int(r.integers(0, 50)), float(x), None if i % 9 == 0 else "s" * (i % 5)) for d in range(1, 11) for i, x in enumerate(r.normal(10, 4, 900 if d == 10 else 100 + d))]
    df = spark.createDataFrame(rows, "effective_date string, item long, price double, note string")
    return df, rows


def state_rows(spark, t):
    return sorted(tuple(str(v) for k, v in r.asDict().items() if not k.endswith("sketch")) for r in spark.table(t).collect())


def test_profile_of_any_range_equals_the_rows(spark, db, sales):
    df, rows = sales
    t, st = f"{db}.sales", f"{db}.sales_state"
    for days in (["2024-01-01", "2024-01-02"], [f"2024-01-{d:02d}" for d in range(3, 11)]):
        write_table(spark, df.where(F.col("effective_date").isin(days)), t, ["effective_date"])
        update_state(spark, t, st, days)
    for since, until in ((None, None), ("2024-01-02", "2024-01-07"), ("2024-01-10", "2024-01-10")):
        some = [r for r in rows if (since or "") <= r[0] <= (until or "9")]
        got = {r.column_name: r for r in merged_profile(spark.table(st), since, until, quantiles=(0.1, 0.5)).collect()}
        price = np.array([r[2] for r in some])
        p = got["price"]
        assert (p.row_count, p.null_count, p.min_value, p.max_value) == (len(some), 0, price.min(), price.max())
        assert p.mean_value == pytest.approx(price.mean(), abs=1e-4) and p.stddev_value == pytest.approx(price.std(ddof=1), abs=1e-4)
        assert abs((price <= p.quantiles[1]).mean() - 0.5) < 0.03 and abs((price <= p.quantiles[0]).mean() - 0.1) < 0.03
        assert float(got["item"].total) == sum(r[1] for r in some)
        note = [r[3] for r in some if r[3] is not None]
        n = got["note"]
        assert (n.null_count, n.distinct_count, n.min_length, n.max_length, n.quantiles) == (len(some) - len(note), len(set(note)), 0, 4, None)
        assert abs(got["price"].distinct_count - len(set(price))) <= 0.05 * len(set(price))


def test_a_rerun_leaves_the_same_state_and_a_reload_replaces_its_dates(spark, db, sales):
    df, _ = sales
    t, st = f"{db}.sales", f"{db}.sales_state"
    write_table(spark, df, t, ["effective_date"])
    assert complete_state(spark, t, st) == sorted(stored_dates(spark, t))
    before = state_rows(spark, st)
    update_state(spark, t, st, ["2024-01-03", "2024-01-04"])
    assert state_rows(spark, st) == before and complete_state(spark, t, st) == []
    write_table(spark, df.where("effective_date = '2024-01-03'").limit(7), t, ["effective_date"])
    update_state(spark, t, st, ["2024-01-03"])
    volumes = {r.dt: r.n for r in daily_volumes(spark.table(st)).collect()}
    assert volumes == {r.dt: r.n for r in daily_counts(spark.table(t), "effective_date").collect()} and volumes["2024-01-03"] == 7


def test_scoring_a_day_reads_no_older_partition(spark, db, sales):
    df, _ = sales
    t, st = f"{db}.sales", f"{db}.sales_state"
    write_table(spark, df, t, ["effective_date"])
    complete_state(spark, t, st)
    batch = daily_counts(df.where("effective_date = '2024-01-10'"), "effective_date")
    want = volume_against_history(batch, spark, t, "effective_date", ["2024-01-10"]).collect()
    # the older partitions' files are gone: only their state is left to score by
    root = table_location(spark, t)
    for d in range(1, 10):
        files = _Files(spark, root)
        for n in files.names(f"{root}/effective_date=2024-01-{d:02d}"):
            files.delete(f"{root}/effective_date=2024-01-{d:02d}/{n}")
    scored = volume_against_history(batch, spark, t, "effective_date", ["2024-01-10"], state_table=st)
    assert scored.collect() == want and want[0].is_anomaly
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        daily_volumes(spark.table(st)).explain("formatted")
    assert "distinct_sketch" not in out.getvalue().split("ReadSchema")[1].splitlines()[0]


def test_without_other_days_a_batch_is_scored_by_itself(spark, db, sales):
    df, _ = sales
    got = volume_against_history(daily_counts(df, "effective_date"), spark, f"{db}.none", "effective_date", [], state_table=f"{db}.none_state")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, volume_anomalies(df, "effective_date").collect()))


def test_nan_nulls_constant_columns_and_null_dates(spark):
    nan = float("nan")
    df = spark.createDataFrame([("d1", nan, 5, None), ("d1", 1.0, 5, None), ("d2", None, 5, None), (None, 9.0, 5, "x")], "effective_date string, x double, c int, z string")
    got = {r.column_name: r for r in merged_profile(daily_state(df)).collect()}
    x = got["x"]
    assert (x.row_count, x.null_count, x.min_value, x.mean_value, x.stddev_value) == (3, 1, 1.0, 1.0, None)
    assert got["c"].stddev_value == 0.0 and got["z"].null_count == 3 and got["z"].distinct_count == 0
    only_nulls = {r.column_name: r for r in merged_profile(daily_state(df.where("effective_date = 'd2'"))).collect()}["x"]
    assert only_nulls.mean_value is None and only_nulls.quantiles is None and not (only_nulls.stddev_value or 0) > 0
    assert math.isclose(got["c"].mean_value, 5.0)
