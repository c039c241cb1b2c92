import contextlib
import io
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators import hashtree
from quayside.operators.hashtree import differing_buckets, hash_tree, levels_for, reconcile_tree, rows_of
from quayside.operators.reconcile import Pair, reconcile_rows


def brute(src, tgt):
    out = {}
    for k in {r[0] for r in src} | {r[0] for r in tgt}:
        a, b = sorted((r[1:] for r in src if r[0] == k), key=repr), sorted((r[1:] for r in tgt if r[0] == k), key=repr)
        if a != b:
            out[k] = "missing" if not b else "extra" if not a else "changed"
    return out


def got(df):
    return {r[0]: r[1] for r in df.collect()}


def test_equals_brute_force_with_repeated_null_and_hot_keys(spark):
    r = random.Random(1)
    src = [(i, f"v{i % 7}", float(i)) for i in range(400)] + [(5, "hot", float(i)) for i in range(300)] + [(None, "n", 1.0), (8, None, None), (9, "a", 1.0), (9, "a", 1.0)]
    tgt = [x for x in src if r.random() > 0.02] + [(1000 + i, "new", 0.0) for i in range(5)] + [(9, "a", 1.0)]
    tgt = [(k, v, w + 1 if k == 77 else w) for k, v, w in tgt]
    a, b = (spark.createDataFrame(x, "k long, v string, w double") for x in (src, tgt))
    for levels in (None, 1, 2):
        assert got(reconcile_tree(a, b, ["k"], levels=levels)) == brute(src, tgt)
    assert got(reconcile_rows(a, b, ["k"])) == brute(src, tgt)


def test_only_rows_of_differing_buckets_reach_the_join(spark):
    src = spark.range(20_000).select("id", (F.col("id") * 3).alias("v"))
    tgt = src.withColumn("v", F.when(F.col("id").isin(5, 6000), -1).otherwise(F.col("v")))
    pair = Pair(src, tgt, ["id"])
    buckets = differing_buckets(spark, hash_tree(pair.source, pair, 2), hash_tree(pair.target, pair, 2))
    assert buckets.count() == 2  # of 4,096
    kept = rows_of(pair.source, pair, 2, buckets, True)
    assert kept.count() < 60
    assert got(reconcile_tree(src, tgt, ["id"], levels=2)) == {5: "changed", 6000: "changed"}
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        reconcile_tree(src, tgt, ["id"], levels=2).explain("simple")
    plan = out.getvalue()  # from the top down: the keys' join and shuffles, and below them the semi-joins
    assert plan.count("LeftSemi") == 2 and "FullOuter" in plan
    for part in plan.split("Exchange hashpartitioning")[1:]:
        assert "LeftSemi" in part


def test_equal_tables_stop_at_the_root_and_kept_trees_can_be_compared(spark, scratch):
    df = spark.range(1000).select("id", F.lit("x").alias("v"))
    pair = Pair(df, df, ["id"])
    kept = hash_tree(pair.source, pair, 2, f"{scratch}/tree")
    again = hash_tree(pair.target.repartition(7), pair, 2)
    assert differing_buckets(spark, kept, again).count() == 0
    assert kept.level(spark, 0).count() == 1 and kept.level(spark, 0).first().n == 1000
    with pytest.raises(ValueError):
        differing_buckets(spark, kept, hash_tree(pair.source, pair, 1))


def test_empty_sides(spark):
    some, none = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([], "k int, v string")
    assert got(reconcile_tree(none, none, ["k"])) == {}
    assert got(reconcile_tree(some, none, ["k"])) == {1: "missing"}
    assert got(reconcile_tree(none, some, ["k"])) == {1: "extra"}


def test_levels_follow_the_rows():
    assert [levels_for(n) for n in (0, 10**5, 10**7, 10**9, 10**11, 10**15)] == [1, 1, 2, 3, 5, 5]


def test_values_are_never_rounded_to_the_other_sides_type(spark):
    src = spark.createDataFrame([(1, 1.2345, "5"), (2, 2.5, "n/a"), (3, 3.0, "7.0"), (4, 4.0, None)], "k int, v double, w string")
    tgt = src.select("k", F.col("v").cast("decimal(12,2)").alias("v"), F.col("w").try_cast("int").alias("w"))
    for compare in (reconcile_rows, reconcile_tree):
        assert got(compare(src, tgt, ["k"])) == {1: "changed", 2: "changed", 3: "changed"}  # '7.0' is no int: null in the target
    tgt = tgt.withColumn("w", F.when(F.col("k") == 3, 7).otherwise(F.col("w")))
    assert got(reconcile_rows(src, tgt, ["k"])) == {1: "changed", 2: "changed"}


def test_keys_that_are_text_on_one_side(spark):
    src = spark.createDataFrame([("1", "a"), ("2", "b"), ("n/a", "c"), ("10", "d"), (None, "e")], "k string, v string")
    tgt = spark.createDataFrame([(1, "a"), (2, "x"), (30, "y"), (None, "e")], "k int, v string")
    want = {"2": "changed", "n/a": "missing", "10": "missing", "30": "extra"}
    assert got(reconcile_rows(src, tgt, ["k"])) == want and got(reconcile_tree(src, tgt, ["k"])) == want


def test_dates_times_and_wide_decimals(spark):
    src = spark.sql("SELECT 1 k, '2024-01-02 10:00:00' d, CAST('12345678901234567890.5' AS decimal(38,1)) n UNION ALL SELECT 2, '2024-01-02', 1")
    tgt = spark.sql("SELECT 1 k, DATE'2024-01-02' d, CAST('12345678901234567890.5' AS decimal(30,2)) n UNION ALL SELECT 2, DATE'2024-01-02', 1")
    assert got(reconcile_rows(src, tgt, ["k"])) == {1: "changed"}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", None])), max_size=12), st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", None])), max_size=12))
def test_any_small_tables(spark, src, tgt):
    a, b = (spark.createDataFrame(x, "k int, v string") for x in (src, tgt))
    assert got(reconcile_tree(a, b, ["k"])) == brute(src, tgt) == got(reconcile_rows(a, b, ["k"]))
