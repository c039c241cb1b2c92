import pytest
from pyspark.sql import functions as F

from quayside.operators.anomaly import volume_anomalies
from quayside.operators.onepass import source_checks
from quayside.operators.profile import profile_columns
from quayside.operators.quality import Rule, check_row_rules
from tests.conftest import SF_SMALL

RULES = [Rule("value_non_negative", "range", "value", min=0), Rule("type_set", "allowed", "event_type", allowed=("click", "view"))]


def test_one_pass_matches_the_separate_tasks(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("effective_date", F.date_format("ts", "yyyy-MM-dd"))
    ev = ev.withColumn("value", F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("value")))  # some nulls
    checks = source_checks(ev, "effective_date", RULES)
    assert sorted(map(tuple, checks.quality.collect())) == sorted(map(tuple, check_row_rules(ev, RULES).collect()))
    assert sorted(map(tuple, checks.daily.collect())) == sorted(map(tuple, volume_anomalies(ev, "effective_date").collect()))
    got = {r.column_name: r for r in checks.profile.collect()}
    want = {r.column_name: r for r in profile_columns(ev.drop("effective_date"), exact=True).collect()}
    assert set(got) == set(want)
    for name, w in want.items():
        g = got[name]
        assert (g.row_count, g.null_count, g.min_length, g.max_length, g.min_value, g.max_value) == (
            w.row_count, w.null_count, w.min_length, w.max_length, w.min_value, w.max_value)
        assert g.mean_value == pytest.approx(w.mean_value, abs=2e-4) if w.mean_value is not None else g.mean_value is None
        assert g.stddev_value == pytest.approx(w.stddev_value, abs=2e-4) if w.stddev_value is not None else g.stddev_value is None
        assert abs(g.distinct_count - w.distinct_count) <= max(2, 0.05 * w.distinct_count)  # sketch estimate


def test_checks_observed_during_a_write_match_the_grouped_pass(spark):
    from pyspark.sql import Observation

    from quayside.operators.onepass import DISTINCT_RSD, ObservedChecks

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("effective_date", F.date_format("ts", "yyyy-MM-dd"))
    ev = ev.withColumn("value", F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("value")))
    grouped = source_checks(ev, "effective_date", RULES)
    oc = ObservedChecks([f for f in ev.schema.fields if f.name != "effective_date"], RULES)
    obs = Observation("checks")
    ev.observe(obs, *oc.exprs()).write.format("noop").mode("overwrite").save()
    per_date = {r[0]: r[1] for r in ev.groupBy("effective_date").count().collect()}
    seen = oc.results(spark, obs.get, per_date)
    assert sorted(map(tuple, seen.quality.collect())) == sorted(map(tuple, grouped.quality.collect()))
    assert sorted(map(tuple, seen.daily.collect())) == sorted(map(tuple, grouped.daily.collect()))
    got = {r.column_name: r for r in seen.profile.collect()}
    for w in grouped.profile.collect():
        g = got[w.column_name]
        assert (g.data_type, g.row_count, g.null_count, g.min_length, g.max_length, g.min_value, g.max_value) == (
            w.data_type, w.row_count, w.null_count, w.min_length, w.max_length, w.min_value, w.max_value)
        assert g.mean_value == pytest.approx(w.mean_value, abs=2e-4) if w.mean_value is not None else g.mean_value is None
        assert g.stddev_value == pytest.approx(w.stddev_value, abs=2e-4) if w.stddev_value is not None else g.stddev_value is None
        assert abs(g.distinct_count - w.distinct_count) <= max(2, 4 * DISTINCT_RSD * w.distinct_count)
