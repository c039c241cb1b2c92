import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quayside.operators import profile
from quayside.operators.anomaly import value_outliers, volume_anomalies
from quayside.operators.lineage import edges_from_counts, record_lineage, traverse
from quayside.operators.profile import profile_columns, top_values
from quayside.operators.quality import Rule, check_foreign_key, check_row_rules, check_unique, failing_rows
from quayside.operators.quantiles import approx_quantiles, exact_quantiles
from quayside.operators.reconcile import reconcile_rows, reconcile_totals


@pytest.fixture(scope="module")
def skewed(spark):
    """One hot group holding about two thirds of the rows, plus many small groups, with
    repeated values and a null."""
    rng = np.random.default_rng(7)
    hot = pd.DataFrame({"g": "hot", "v": rng.integers(0, 500, 6000).astype(float)})
    cold = pd.DataFrame({"g": [f"g{i % 40}" for i in range(3000)], "v": rng.normal(10, 3, 3000).round(2)})
    pdf = pd.concat([hot, cold], ignore_index=True)
    df = spark.createDataFrame(pdf, "g string, v double").unionByName(spark.createDataFrame([("g1", None)], "g string, v double"))
    return pdf, df


def test_exact_quantiles_match_brute_force_on_skewed_groups(spark, skewed):
    pdf, df = skewed
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["g"], "v", probs, partitions=8).toPandas().set_index("g").sort_index()
    want = pdf.dropna().groupby("g")["v"].quantile(probs).unstack().sort_index()  # linear interpolation
    assert list(got.index) == list(want.index)
    np.testing.assert_allclose(got[[f"q{i}" for i in range(len(probs))]].to_numpy(), want.to_numpy(), rtol=0, atol=1e-9)


def test_exact_quantiles_global(spark, skewed):
    pdf, df = skewed
    got = exact_quantiles(df, [], "v", [0.25, 0.75], partitions=5).first()
    assert got.q0 == pytest.approx(pdf["v"].dropna().quantile(0.25), abs=1e-9)
    assert got.q1 == pytest.approx(pdf["v"].dropna().quantile(0.75), abs=1e-9)


def test_approx_quantiles_close(spark, skewed):
    pdf, df = skewed
    got = approx_quantiles(df, ["g"], "v", [0.5]).where("g = 'hot'").first().q0
    assert abs(got - pdf[pdf.g == "hot"]["v"].median()) <= 5


def test_value_outliers_and_volume(spark, skewed):
    pdf, df = skewed
    out = {(r.g, r.v) for r in value_outliers(df, ["g"], "v").collect()}
    want = set()
    for g, grp in pdf.dropna().groupby("g"):
        q1, q3 = grp.v.quantile(0.25), grp.v.quantile(0.75)
        want |= {(g, v) for v in grp.v if v > q3 + 1.5 * (q3 - q1) or v < q1 - 1.5 * (q3 - q1)}
    assert out == want
    days = spark.createDataFrame([(f"d{i}",) for i in range(10) for _ in range(100)] + [("d9",)] * 400, "dt string")
    va = {r.dt: r for r in volume_anomalies(days, "dt").collect()}
    assert va["d9"].is_anomaly and va["d9"].n == 500 and not va["d0"].is_anomaly


def test_row_rules_null_semantics_and_failing_rows(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, None, -1.0), (3, "zz", None)], "id int, s string, x double")
    rules = [
        Rule("s_not_null", "not_null", "s"), Rule("x_pos", "range", "x", min=0),
        Rule("s_set", "allowed", "s", allowed=("a",)), Rule("s_re", "regex", "s", pattern="^[a-z]$"),
        Rule("expr", "expression", expression="id < 3"),
    ]
    got = {r.rule_name: (r.checked_rows, r.failed_rows, r.passed) for r in check_row_rules(df, rules).collect()}
    assert got == {
        "s_not_null": (3, 1, False), "x_pos": (3, 1, False), "s_set": (3, 1, False),
        "s_re": (3, 1, False), "expr": (3, 1, False),
    }
    bad = {r.id: sorted(r.failed_rules) for r in failing_rows(df, rules).collect()}
    assert bad == {2: ["s_not_null", "x_pos"], 3: ["expr", "s_re", "s_set"]}


def test_unique_and_foreign_key(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (3, None), (4, 99), (5, 99)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (10,), (11,)], "k int")
    assert sorted(tuple(r) for r in check_unique(child, ["fk"]).collect()) == [(10, 2), (99, 2)]
    orphans = sorted(r.id for r in check_foreign_key(child, ["fk"], parent, ["k"]).collect())
    assert orphans == [4, 5]  # null key is not an orphan


def test_reconcile_rows_with_duplicate_keys(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (5, None)], "k int, v string")
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "x"), (4, "d"), (5, None)], "k int, v string")
    got = sorted(tuple(r) for r in reconcile_rows(src, tgt, ["k"]).collect())
    assert got == [(2, "changed"), (3, "changed"), (4, "extra")]
    got2 = sorted(tuple(r) for r in reconcile_rows(tgt, src.where("k <> 5"), ["k"]).collect())
    assert got2 == [(2, "changed"), (3, "changed"), (4, "missing"), (5, "missing")]


def test_reconcile_totals_mismatch(spark):
    control = spark.createDataFrame(
        [("d1", 2, "3.00"), ("d2", 1, "1.00")], "effective_date string, row_count long, amount_total string"
    ).withColumn("amount_total", F.col("amount_total").cast("decimal(18,2)"))
    table = spark.createDataFrame([("d1", 1.0), ("d1", 2.0), ("d2", 5.0), ("d3", 1.0)], "effective_date string, value double")
    got = {r.effective_date: (r.control_count, r.target_count, r.is_match) for r in reconcile_totals(control, table, "effective_date", "value").collect()}
    assert got == {"d1": (2, 2, True), "d2": (1, 1, False)}


def test_profile_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1, 2, 2, None], "s": ["x", "yy", None, "yy"]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, s string")
    got = {r.column_name: r for r in profile_columns(df).collect()}
    assert (got["a"].row_count, got["a"].null_count, got["a"].distinct_count) == (4, 1, 2)
    assert got["a"].mean_value == pytest.approx(pdf.a.mean(), abs=1e-4)
    assert got["a"].stddev_value == pytest.approx(pdf.a.std(), abs=1e-4)
    assert (got["s"].min_length, got["s"].max_length, got["s"].distinct_count) == (1, 2, 2)
    approx = {r.column_name: r.distinct_count for r in profile_columns(df, exact=False).collect()}
    assert approx == {"a": 2, "s": 2}
    tv = [tuple(r) for r in top_values(df, ["s"], k=1).collect()]
    assert tv == [("s", "yy", 2, 1)]


def test_exact_profile_deals_many_values_to_tasks_by_size(spark, monkeypatch):
    df = spark.range(0, 3000, 1, 2).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN 'even' END s", "CASE WHEN id % 3 = 0 THEN -0.0D WHEN id % 3 = 1 THEN 0.0D ELSE double('NaN') END z",
        "float(id % 7) f", "array(double(id % 5), double('NaN')) a", "encode(cast(id % 4 AS string), 'utf-8') b", "cast(NULL AS int) n", "id % 100 `d.t`", "cast(id % 13 AS string) t")
    want = {r.column_name: r.distinct_count for r in profile_columns(df, exact=True).collect()}
    assert want == {"id": 3000, "s": 1, "z": 2, "f": 7, "a": 5, "b": 4, "n": 0, "d.t": 100, "t": 13}
    monkeypatch.setattr(profile, "KEPT_VALUES", 1000)
    monkeypatch.setattr(profile, "TASK_BYTES", 500_000)
    dealt = profile_columns(df, exact=True)
    assert {r.column_name: r.distinct_count for r in dealt.collect()} == want
    # rows meet a table of values only in tasks whose number follows their size, here and after
    plan = dealt._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("REPARTITION_BY_NUM") == 2 and "Expand" not in plan
    below = plan[plan.rindex("REPARTITION_BY_NUM"):]
    assert "Aggregate" not in below


def test_lineage_traversal(spark, db):
    t = f"{db}.lineage"
    counts = spark.createDataFrame([("d1", 5)], "effective_date string, n long")
    for s, d in (("file_a", "table_a"), ("table_a", "extract_a"), ("table_a", "table_b"), ("table_b", "table_a")):
        record_lineage(spark, edges_from_counts(counts, "wf", "t", s, d, "run1"), t)
    down = {r.dataset: r.depth for r in traverse(spark, t, "file_a").collect()}
    assert down == {"table_a": 1, "extract_a": 2, "table_b": 2}  # the cycle stops
    up = {r.dataset: r.depth for r in traverse(spark, t, "extract_a", "upstream").collect()}
    assert up == {"table_a": 1, "file_a": 2, "table_b": 2}


def test_foreign_key_composite_with_hot_orphan_matches_brute_force(spark):
    rows = [(i, i % 5, None if i % 11 == 0 else i % 7) for i in range(600)]
    rows += [(1000 + i, 9, 9) for i in range(300)]  # one orphan key with a third of all rows
    child = spark.createDataFrame(rows, "id int, a int, b int")
    parent = spark.createDataFrame([(a, b) for a in range(5) for b in range(0, 7, 2)], "pa int, pb int")
    parent_keys = {(a, b) for a in range(5) for b in range(0, 7, 2)}
    want = sorted(i for i, a, b in rows if b is not None and (a, b) not in parent_keys)
    got = sorted(r.id for r in check_foreign_key(child, ["a", "b"], parent, ["pa", "pb"]).collect())
    assert got == want


def test_amount_anomalies_match_brute_force(spark):
    from quayside.operators.anomaly import amount_anomalies

    days = [f"2024-01-{d:02d}" for d in range(1, 16)]
    rows = [(d, 10.0 + (i % 3)) for i, d in enumerate(days) for _ in range(4)]
    rows += [("2024-01-09", 500.0), ("2024-01-12", None)]  # one day far off; a null amount is skipped
    df = spark.createDataFrame(rows, "effective_date string, amount double")
    sums = pd.Series({d: sum(a for x, a in rows if x == d and a is not None) for d in days})
    med = sums.median()
    mad = (sums - med).abs().median()
    want = {d: (round(0.6745 * (s - med) / mad, 4), abs(round(0.6745 * (s - med) / mad, 4)) > 3.5) for d, s in sums.items()}
    got = {r.dt: (r.score, r.is_anomaly) for r in amount_anomalies(df, "effective_date", "amount").collect()}
    assert got == want and [d for d, (_, bad) in got.items() if bad] == ["2024-01-09"]


def test_lineage_of_long_chains_cycles_and_failed_runs(spark, db):
    t = f"{db}.chain"
    counts = spark.createDataFrame([("2024-01-01", 1)], "effective_date string, n long")
    pairs = [(f"d{i}", f"d{i + 1}") for i in range(40)] + [("d40", "d38")]
    edges = None
    for a, b in pairs:
        e = edges_from_counts(counts, "wf", "t", a, b, "r")
        edges = e if edges is None else edges.union(e)
    record_lineage(spark, edges.union(edges_from_counts(counts, "wf", "t", "d40", "never", "r", "failed")), t)
    got = {r.dataset: r.depth for r in traverse(spark, t, "d0").collect()}
    assert got == {f"d{i}": i for i in range(1, 41)}


def test_row_compare_takes_the_targets_types(spark):
    from quayside.operators.reconcile import reconcile_rows

    a = spark.createDataFrame([(1, 5, "2.5"), (2, 6, "x")], "k int, v int, w string")
    b = spark.createDataFrame([(1, 5, "2.5"), (2, 7, "x")], "k bigint, v bigint, w string")
    assert [tuple(r) for r in reconcile_rows(a, b, ["k"]).collect()] == [(2, "changed")]


def test_dates_without_a_control_are_reported(spark):
    from quayside.operators.reconcile import control_schema, reconcile_totals

    control = spark.createDataFrame([("2024-01-01", 1, None)], control_schema())
    target = spark.createDataFrame([("2024-01-01", 1.0), ("2024-01-02", 2.0), ("2024-01-03", 3.0)], "effective_date string, v double")
    rows = lambda dates: {r.effective_date: (r.control_count, r.target_count, r.is_match) for r in reconcile_totals(control, target, dates=dates).collect()}
    assert rows(["2024-01-01", "2024-01-02"]) == {"2024-01-01": (1, 1, True), "2024-01-02": (0, 1, False)}
    assert rows("all") == {"2024-01-01": (1, 1, True), "2024-01-02": (0, 1, False), "2024-01-03": (0, 1, False)}
    fine = spark.createDataFrame([("2024-01-01", 1, "1.2345")], "effective_date string, row_count long, amount_total string").select("effective_date", "row_count", F.col("amount_total").cast("decimal(20,4)").alias("amount_total"))
    one = spark.createDataFrame([("2024-01-01", "1.2346")], "effective_date string, v string")
    assert [r.is_match for r in reconcile_totals(fine, one, amount_column="v", scale=4).collect()] == [False]
    assert [r.is_match for r in reconcile_totals(fine, one, amount_column="v", scale=2).collect()] == [True]
