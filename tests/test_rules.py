from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators.quality import Rule, check_key_rules, check_rules
from quayside.plans.job import exit_status


def report(df):
    return [(r.rule_name, r.rule_type, r.column_name, r.checked_rows, r.failed_rows, r.passed) for r in df.collect()]


def test_all_kinds_in_one_report(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (2, "b", 99), (None, "c", None), (3, None, 20)], "id int, s string, fk int")
    parents = {"p": spark.createDataFrame([(10, "x"), (20, "y"), (20, "y"), (None, "z")], "k long, t string")}
    rules = [
        Rule("u_id", "unique", "id"), Rule("s_there", "not_null", "s"), Rule("u_both", "unique", columns=("id", "s")),
        Rule("fk_p", "foreign_key", "fk", parent="p", parent_columns=("k",)), Rule("id_small", "range", "id", max=2),
        Rule("s_ab", "allowed", "s", allowed=("a", "b")), Rule("s_re", "regex", "s", pattern="^[ab]$"),
    ]
    assert sorted(report(check_rules(df, rules, parents.get))) == sorted([
        ("u_id", "unique", "id", 5, 2, False), ("s_there", "not_null", "s", 5, 1, False), ("u_both", "unique", "id,s", 5, 2, False),
        ("fk_p", "foreign_key", "fk", 5, 1, False), ("id_small", "range", "id", 5, 1, False), ("s_ab", "allowed", "s", 5, 1, False), ("s_re", "regex", "s", 5, 1, False),
    ])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from(["x", "y", None])), max_size=15), st.lists(st.integers(0, 3), max_size=4))
def test_any_rows(spark, rows, known):
    df = spark.createDataFrame(rows, "a int, b string")
    parent = spark.createDataFrame([(str(k),) for k in known], "k string")  # text against numbers
    got = {r[0]: r[4] for r in report(check_key_rules(df, [Rule("u", "unique", columns=("a", "b")), Rule("f", "foreign_key", "a", parent=parent, parent_columns=("k",))]))}
    full = [r for r in rows if None not in r]
    assert got == {"u": sum(full.count(r) > 1 for r in full), "f": sum(a is not None and a not in known for a, _ in rows)}


def test_empty_frames_and_hot_keys(spark):
    rules = [Rule("u", "unique", "id"), Rule("f", "foreign_key", "id", parent=spark.range(5).toDF("id"))]
    assert [r[3:] for r in report(check_key_rules(spark.range(0), rules))] == [(0, 0, True), (0, 0, True)]
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("id"))
    assert [r[4] for r in report(check_key_rules(hot, rules))] == [1000, 3000]


def test_unique_and_foreign_keys_share_one_pass(spark, scratch):
    import contextlib
    import io
    import re

    spark.range(100).withColumn("b", F.col("id") % 3).write.parquet(f"{scratch}/t")
    df = spark.read.parquet(f"{scratch}/t")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        check_key_rules(df, [Rule("u", "unique", "id"), Rule("v", "unique", columns=("id", "b")), Rule("f", "foreign_key", "b", parent=spark.range(3).toDF("b"))]).explain("formatted")
    assert len(re.findall(r"^\(\d+\) Scan parquet", out.getvalue(), re.M)) == 1


def test_the_job_fails_when_a_check_fails():
    rows = [{"step": "pre", "status": "ok"}, {"step": "main", "status": "ok"}, {"step": "post", "status": "failed"}, {"step": "lineage", "status": "ok"}]
    assert exit_status(rows) == 1 and exit_status(rows, main_step_only=True) == 0
    for status in ("error", "failed"):
        assert exit_status([{"step": "main", "status": status}], main_step_only=True) == 1
        assert exit_status([{"step": "main", "status": "ok"}, {"step": "lineage", "status": status}]) == 1
    assert exit_status([{"step": "main", "status": "skipped"}]) == 0
