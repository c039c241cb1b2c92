import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators import broadcasts
from quayside.operators.quantiles import exact_quantiles, ranked_weights


def test_a_value_with_a_third_of_all_rows_is_one_row_and_partitions_stay_even(spark):
    df = spark.range(90_000).select(F.lit("g").alias("g"), F.when(F.col("id") % 3 == 0, 500.0).otherwise((F.col("id") % 4_001).cast("double")).alias("v"))
    ranked = ranked_weights(df, ["g"], "v", partitions=8)
    hot = ranked.where("_v = 500.0").collect()
    assert len(hot) == 1 and hot[0]._n >= 30_000
    sizes = [r[0] for r in ranked.groupBy("_pid").agg(F.count(F.lit(1))).select("count(1)").collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    got = exact_quantiles(df, ["g"], "v", [0.1, 0.5, 0.99], partitions=8).first()
    values = [500.0 if i % 3 == 0 else float(i % 4_001) for i in range(90_000)]
    np.testing.assert_allclose([got.q0, got.q1, got.q2], np.quantile(values, [0.1, 0.5, 0.99]), atol=1e-9)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-3, 3).map(float))), min_size=1, max_size=40))
def test_any_groups_with_nulls_and_ties(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.q0, r.q1) for r in exact_quantiles(df, ["g"], "v", [0.25, 0.6], partitions=3).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"]).dropna(subset=["v"])
    want = {(None if pd.isna(g) else g): tuple(np.quantile(x.v.astype(float), [0.25, 0.6])) for g, x in pdf.groupby("g", dropna=False)}
    assert set(got) == set(want)
    for g, w in want.items():
        np.testing.assert_allclose(got[g], w, atol=1e-12)


def test_group_names_that_clash_and_an_empty_frame(spark):
    df = spark.createDataFrame([(1, "x", 5.0), (1, "y", 7.0)], "n int, `a b` string, value double")
    got = {(r.n, r["a b"]): r.q0 for r in exact_quantiles(df, ["n", "a b"], "value", [0.5]).collect()}
    assert got == {(1, "x"): 5.0, (1, "y"): 7.0}
    assert exact_quantiles(df.limit(0), ["n"], "value", [0.5]).collect() == []


def test_a_side_is_broadcast_by_its_bytes_not_its_rows(spark, monkeypatch):
    small = spark.createDataFrame([(1, "x" * 10)], "k int, s string")
    wide = spark.createDataFrame([(1, "x" * 5000)], "k int, s string")
    assert broadcasts.measured_bytes(small) == 42 and broadcasts.measured_bytes(wide) == 5032
    monkeypatch.setattr(broadcasts, "MAX_BROADCAST_BYTES", 1000)
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcasts.small_side(small)) and not hinted(broadcasts.small_side(wide))
    assert broadcasts.measured_bytes(spark.createDataFrame([], "k int, s string")) == 0
