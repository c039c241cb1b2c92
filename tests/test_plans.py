"""Plan guards: the physical plans keep the properties the design relies on at scale."""

import contextlib
import io

from pyspark.sql import functions as F

from quayside.operators.anomaly import volume_anomalies
from quayside.operators.profile import top_values
from quayside.operators.quality import check_foreign_key, check_row_rules, Rule
from quayside.operators.reconcile import reconcile_rows
from quayside.operators.validate import target_counts
from quayside.sinks.table import write_table
from tests.conftest import SF_SMALL


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def nodes(p: str, name: str) -> int:
    """Number of physical operators called ``name`` (detail headers ``(n) name``)."""
    import re

    return len(re.findall(rf"^\(\d+\) {re.escape(name)}\b", p, flags=re.M))


def tbl(spark, name):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


def test_target_counts_prune_partitions_and_read_no_columns(spark, db):
    ev = tbl(spark, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("effective_date"))
    write_table(spark, ev, f"{db}.ev", ["effective_date"], "full")
    p = plan(target_counts(spark, f"{db}.ev", "effective_date", ["2024-01-02"], include_null=False))
    assert "PartitionFilters: [" in p and "2024-01-02" in p
    assert "ReadSchema: struct<>" in p


def test_foreign_key_reads_only_the_key_and_never_shuffles_the_child(spark):
    p = plan(check_foreign_key(tbl(spark, "documents").select("doc_id"), ["doc_id"], tbl(spark, "labels")))
    assert "ReadSchema: struct<doc_id:bigint>" in p and "text" not in p.split("ReadSchema")[1]
    # The anti-join ran on distinct keys (materialised); the child's rows are fetched by a
    # semi-join against the broadcast orphan keys, with no shuffle of the child.
    assert "LeftSemi" in p and nodes(p, "BroadcastHashJoin") == 1 and nodes(p, "Exchange") == 0


def test_row_rules_are_one_aggregation(spark):
    rules = [Rule("a", "range", "c_acctbal", min=0), Rule("b", "not_null", "c_name")]
    p = plan(check_row_rules(tbl(spark, "customer"), rules))
    assert nodes(p, "Scan parquet") == 1 and nodes(p, "Exchange") == 1


def test_key_reconciliation_does_not_reshuffle_after_aggregating(spark):
    o = tbl(spark, "orders")
    p = plan(reconcile_rows(o, o.where("o_orderstatus <> 'P'"), ["o_orderkey"]))
    # one exchange per side (the partial-to-final aggregate); the join reuses it
    assert nodes(p, "Scan parquet") == 2 and nodes(p, "Exchange") == 2
    assert "Join type: FullOuter" in p


def test_top_values_is_a_bounded_top_k(spark):
    p = plan(top_values(tbl(spark, "events"), ["event_type"], k=3))
    assert "TakeOrderedAndProject" in p


def test_volume_anomalies_scan_the_fact_table_once(spark):
    ev = tbl(spark, "events").withColumn("effective_date", F.date_format("ts", "yyyy-MM-dd"))
    # the daily aggregate is checkpointed once; the median/MAD subqueries read that
    p = plan(volume_anomalies(ev, "effective_date"))
    assert nodes(p, "Scan parquet") == 0 and nodes(p, "Scan ExistingRDD") >= 1


def test_nothing_overrides_what_spark_submit_decided(tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "from quayside.session import build_session\n"
        "s = build_session('local[1]', shuffle_partitions=8, extra={'spark.sql.session.timeZone': 'UTC'})\n"
        "print('GOT', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.sql.adaptive.enabled'), s.sparkContext.master)\n"
        "t = build_session(None, shuffle_partitions=3)\n"
        "print('AGAIN', t.conf.get('spark.sql.shuffle.partitions'), t is s)\n"
    )
    submit = "--master local[2] --conf spark.sql.shuffle.partitions=4000 --conf spark.sql.adaptive.enabled=false --conf spark.sql.session.timeZone=CET pyspark-shell"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": submit, "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=tmp_path).stdout
    assert "GOT 4000 CET false local[2]" in out and "AGAIN 4000 True" in out
