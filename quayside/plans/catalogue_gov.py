"""Query catalogue, part 2: governance tasks (G1-G5), SQL-file extract (S10, K11) and the
workflow (F1, F2). Importing this module registers the queries."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.schema import column_spec_to_schema
from quayside.operators.anomaly import MAD_SCALE, Z_THRESHOLD, amount_anomalies, value_outliers, volume_anomalies
from quayside.operators.lineage import EDGE_COLUMNS
from quayside.operators.profile import profile_columns, top_values
from quayside.operators.quality import Rule, check_foreign_key, check_row_rules, check_unique, failing_rows
from quayside.operators.reconcile import control_schema, control_totals, reconcile_rows, reconcile_totals
from quayside.plans.catalogue import ED, EVENT_FULL_SPEC, Ctx, land_dated, register
from quayside.plans.workflow import ExtractSpec, ManagementTask, Workflow, run_workflow
from quayside.sinks.delimited import write_delimited
from quayside.sinks.table import write_table
from quayside.sources.delimited import read_dated_files, read_delimited, resolve_dated_path
from quayside.sources.sqlfile import read_sql_file
from quayside.spec import DatasetSpec, LoadSpec, TableSpec

SQL_DIR = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "sql")

# --------------------------------------------------------------------------- G1

CUSTOMER_RULES = [
    Rule("acctbal_non_negative", "range", "c_acctbal", min=0),
    Rule("nationkey_in_range", "range", "c_nationkey", min=0, max=24),
    Rule("mktsegment_allowed", "allowed", "c_mktsegment", allowed=("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")),
    Rule("name_format", "regex", "c_name", pattern=r"^Customer#[0-9]{9}$"),
    Rule("name_not_null", "not_null", "c_name"),
    Rule("name_length", "expression", expression="length(c_name) = 18"),
]


def _rule_sql(r: Rule) -> str:
    """DuckDB text of a rule's failing condition (oracle side only)."""
    lit = lambda v: f"'{v}'" if isinstance(v, str) else repr(v)
    if r.kind == "not_null":
        return f"{r.column} IS NULL"
    if r.kind == "range":
        ok = " AND ".join(
            ([f"{r.column} >= {lit(r.min)}"] if r.min is not None else [])
            + ([f"{r.column} <= {lit(r.max)}"] if r.max is not None else [])
        )
        return f"{r.column} IS NOT NULL AND NOT ({ok})"
    if r.kind == "allowed":
        return f"{r.column} IS NOT NULL AND {r.column} NOT IN ({', '.join(lit(v) for v in r.allowed)})"
    if r.kind == "regex":
        return f"{r.column} IS NOT NULL AND NOT regexp_matches({r.column}, {lit(r.pattern)})"
    return f"NOT coalesce({r.expression}, true)"


def _rules_oracle(rules, table: str) -> str:
    parts = []
    for r in rules:
        col = f"'{r.column}'" if r.column else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT '{r.name}' rule_name, '{r.kind}' rule_type, {col} column_name, count(*) checked_rows, "
            f"count(*) FILTER (WHERE {_rule_sql(r)}) failed_rows, "
            f"count(*) FILTER (WHERE {_rule_sql(r)}) = 0 passed FROM {table}"
        )
    return "\nUNION ALL\n".join(parts)


@register("dq_row_rules", _rules_oracle(CUSTOMER_RULES, "customer"))
def q_dq_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_row_rules(Ctx(spark, sf_dir).table("customer"), CUSTOMER_RULES)


def _failing_oracle(rules, table: str, key: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT {key}, '{r.name}' rule_name FROM {table} WHERE {_rule_sql(r)}" for r in rules)


@register("dq_failing_rows", _failing_oracle(CUSTOMER_RULES, "customer", "c_custkey"))
def q_dq_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing rows themselves: one row per (customer, broken rule)."""
    bad = failing_rows(Ctx(spark, sf_dir).table("customer"), CUSTOMER_RULES)
    return bad.select("c_custkey", F.explode("failed_rules").alias("rule_name"))


@register(
    "dq_unique",
    "SELECT l_orderkey, l_linenumber, count(*) n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def q_dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(Ctx(spark, sf_dir).table("lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_foreign_key", "SELECT d.doc_id FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id")
def q_dq_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    return check_foreign_key(ctx.table("documents").select("doc_id"), ["doc_id"], ctx.table("labels"))


# --------------------------------------------------------------------------- G3

# (column, Spark type name, kind) of the profiled customer projection; the last column
# is derived (null for negative balances) so null counting is exercised.
PROFILE_COLUMNS = [
    ("c_custkey", "bigint", "num"),
    ("c_name", "string", "text"),
    ("c_nationkey", "int", "num"),
    ("c_acctbal", "double", "num"),
    ("c_mktsegment", "string", "text"),
    ("c_acctbal_nonneg", "double", "num"),
]
PROFILE_SOURCE_SQL = "SELECT *, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal_nonneg FROM customer"


def _profile_oracle() -> str:
    parts = []
    for name, dtype, kind in PROFILE_COLUMNS:
        text = kind == "text"
        num = kind == "num"
        parts.append(
            f"SELECT '{name}' column_name, '{dtype}' data_type, count(*) row_count, "
            f"count(*) - count({name}) null_count, count(DISTINCT {name}) distinct_count, "
            + (f"CAST(min(length({name})) AS BIGINT) min_length, CAST(max(length({name})) AS BIGINT) max_length, "
               if text else "CAST(NULL AS BIGINT) min_length, CAST(NULL AS BIGINT) max_length, ")
            + (f"CAST(min({name}) AS DOUBLE) + 0.0 min_value, CAST(max({name}) AS DOUBLE) + 0.0 max_value, "
               f"round(avg(CAST({name} AS DOUBLE)), 4) mean_value, round(stddev_samp(CAST({name} AS DOUBLE)), 4) stddev_value "
               if num else "CAST(NULL AS DOUBLE) min_value, CAST(NULL AS DOUBLE) max_value, "
               "CAST(NULL AS DOUBLE) mean_value, CAST(NULL AS DOUBLE) stddev_value ")
            + f"FROM ({PROFILE_SOURCE_SQL}) p"
        )
    return "\nUNION ALL\n".join(parts)


@register("profile_columns", _profile_oracle())
def q_profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = Ctx(spark, sf_dir).table("customer")
    cust = cust.withColumn("c_acctbal_nonneg", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return profile_columns(cust, exact=True)


def _top_oracle(table: str, columns, k: int) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' column_name, CAST(v AS VARCHAR) value, n, rk FROM ("
        f"SELECT {c} v, count(*) n, row_number() OVER (ORDER BY count(*) DESC, {c}) rk "
        f"FROM {table} WHERE {c} IS NOT NULL GROUP BY 1) WHERE rk <= {k}"
        for c in columns
    )


@register("profile_top_values", _top_oracle("events", ["event_type", "user_id"], 3))
def q_profile_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_values(Ctx(spark, sf_dir).table("events"), ["event_type", "user_id"], k=3)


# --------------------------------------------------------------------------- G4


def _events_table(ctx: Ctx, dataset_id: str = "events_table") -> tuple[str, list[str], str]:
    """Stage the event files, load them into a partitioned table; returns (table, dates, template)."""
    from quayside.plans.load import load_to_table

    ev = ctx.events()
    dates = ctx.event_dates(ev)
    template = land_dated(ctx, ev.select("event_id", "ts", "user_id", "event_type", "value", "props", "effective_date"), "events")
    db = ctx.database()
    spec = LoadSpec(
        source=DatasetSpec("events_file", path_template=template),
        target=TableSpec(db, "events", ("effective_date",), dataset_id),
        columns=EVENT_FULL_SPEC, load_type="incremental", effective_dates=tuple(dates), date_from_path=True,
    )
    return load_to_table(ctx.spark, spec).table, dates, template


def _control_files(ctx: Ctx) -> str:
    """One ``effective_date|row_count|amount_total`` control file per date."""
    ctl = control_totals(ctx.events(), "effective_date", "value")
    ctl = ctl.withColumn("control_date", F.regexp_replace("effective_date", "-", ""))
    root = ctx.path("landing/events_control")
    write_delimited(ctl, root, sep="|", partition_by=["control_date"])
    return f"{root}/control_date=yyyymmdd"


@register(
    "recon_totals",
    f"""SELECT {ED} effective_date, count(*) control_count, count(*) target_count,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) control_amount,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) target_amount,
               true is_match
        FROM events GROUP BY 1""",
)
def q_recon_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    table, dates, _ = _events_table(ctx)
    template = _control_files(ctx)
    control = read_dated_files(spark, template, dates, control_schema(), sep="|", date_column=None)
    return reconcile_totals(control, spark.table(table), "effective_date", "value")


@register(
    "recon_rows",
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'P' THEN 'missing' WHEN o_orderpriority = '5-LOW' THEN 'extra' ELSE 'changed' END status
       FROM orders
       WHERE (o_orderpriority <> '5-LOW' AND o_orderstatus = 'P')
          OR (o_orderpriority = '5-LOW' AND o_orderstatus <> 'P')
          OR (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P')""",
)
def q_recon_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source: orders except priority 5-LOW. Target table: orders except status P, with
    the total price of 1-URGENT orders restated."""
    ctx = Ctx(spark, sf_dir)
    orders = ctx.table("orders")
    source = orders.where(F.col("o_orderpriority") != "5-LOW")
    restated = orders.where(F.col("o_orderstatus") != "P").withColumn(
        "o_totalprice",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    )
    t = f"{ctx.database()}.orders"
    write_table(spark, restated, t, (), "full")
    return reconcile_rows(source, spark.table(t), ["o_orderkey"])


# --------------------------------------------------------------------------- G2

_VOLUME_SCORE = "round(0.6745 * (n - med) / nullif(mad, 0), 4)"
_VOLUME_FLAG = f"CASE WHEN mad = 0 THEN n <> med ELSE abs({_VOLUME_SCORE}) > 3.5 END"


@register(
    "anomaly_volume",
    f"""WITH d AS (SELECT {ED} dt, count(*) n FROM events GROUP BY 1),
             m AS (SELECT median(n) med FROM d),
             a AS (SELECT median(abs(n - med)) mad FROM d, m)
        SELECT dt, n, {_VOLUME_SCORE} score, {_VOLUME_FLAG} is_anomaly FROM d, m, a""",
)
def q_anomaly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume_anomalies(Ctx(spark, sf_dir).events(), "effective_date")


@register(
    "anomaly_amount",
    f"""WITH d AS (SELECT {ED} dt, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) amount FROM events GROUP BY 1),
             m AS (SELECT median(amount) med FROM d),
             a AS (SELECT median(abs(amount - med)) mad FROM d, m)
        SELECT dt, amount, round(0.6745 * (amount - med) / nullif(mad, 0), 4) score,
               CASE WHEN mad = 0 THEN amount <> med ELSE abs(round(0.6745 * (amount - med) / nullif(mad, 0), 4)) > 3.5 END is_anomaly
        FROM d, m, a""",
)
def q_anomaly_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amount_anomalies(Ctx(spark, sf_dir).events(), "effective_date", "value")


@register(
    "anomaly_values",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3
                  FROM events GROUP BY 1)
       SELECT event_id, event_type, value FROM events JOIN q USING (event_type)
       WHERE value > q3 + 1.5 * (q3 - q1) OR value < q1 - 1.5 * (q3 - q1)""",
)
def q_anomaly_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Ctx(spark, sf_dir).table("events")
    return value_outliers(ev, ["event_type"], "value").select("event_id", "event_type", "value")


# --------------------------------------------------------------------------- S10, K11

SEGMENT_SPEC = [
    {"column_name": "c_mktsegment", "data_type": "string"},
    {"column_name": "customers", "data_type": "bigint"},
    {"column_name": "balance", "data_type": "double"},
]


@register(
    "extract_sql_file",
    "SELECT c_mktsegment, count(*) customers, round(sum(c_acctbal), 2) balance FROM customer GROUP BY 1",
)
def q_extract_sql_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    customers = f"{ctx.database()}.customer"  # a table of the query's own: no view is left in the session
    write_table(spark, ctx.table("customer"), customers, (), "full")
    result = read_sql_file(spark, os.path.join(SQL_DIR, "segment_balance.sql"), {"source_table": customers})
    path = resolve_dated_path(ctx.path("out/segment_balance_yyyymmdd.dat"), "2024-01-01")
    write_delimited(result, path, sep="|")
    return read_delimited(spark, path, column_spec_to_schema(SEGMENT_SPEC), sep="|")


# --------------------------------------------------------------------------- G5, F1, F2

TOTALS_SPEC = [
    {"column_name": "effective_date", "data_type": "string"},
    {"column_name": "event_type", "data_type": "string"},
    {"column_name": "events", "data_type": "bigint"},
    {"column_name": "value_total", "data_type": "decimal(18,2)"},
]


def _ingest_workflow(ctx: Ctx, lineage_table: str | None, with_control: bool = True) -> tuple[Workflow, list[str]]:
    ev = ctx.events()
    dates = ctx.event_dates(ev)
    template = land_dated(ctx, ev.select("event_id", "ts", "user_id", "event_type", "value", "props", "effective_date"), "events")
    control = _control_files(ctx) if with_control else None
    db = ctx.database()
    source = DatasetSpec("events_file", path_template=template, recon_path_template=control)
    load = LoadSpec(
        source=source, target=TableSpec(db, "events", ("effective_date",), "events_table"),
        columns=EVENT_FULL_SPEC, load_type="incremental", effective_dates=tuple(dates), date_from_path=True,
    )
    rules = [
        Rule("value_non_negative", "range", "value", min=0),
        Rule("event_type_allowed", "allowed", "event_type", allowed=("click", "error", "purchase", "signup", "view")),
        Rule("event_id_not_null", "not_null", "event_id"),
    ]
    wf = Workflow(
        workflow_id="wf_events_ingest",
        load=load,
        pre_tasks=(
            ManagementTask("data quality", "events_file", {"rules": rules}),
            ManagementTask("data quality ml", "events_file", {"date_column": "effective_date"}),
            ManagementTask("data profile", "events_file"),
        ),
        post_tasks=(
            ManagementTask("data reconciliation", "events_table", {"amount_column": "value", "control_path_template": control}),
        ),
        datasets={"events_file": source},
        lineage_table=lineage_table,
    )
    return wf, dates


@register(
    "workflow_results",
    f"""WITH d AS (SELECT {ED} dt, count(*) n FROM events GROUP BY 1),
             m AS (SELECT median(n) med FROM d),
             a AS (SELECT median(abs(n - med)) mad FROM d, m),
             z AS (SELECT count(*) FILTER (WHERE {_VOLUME_FLAG}) bad FROM d, m, a),
             c AS (SELECT count(*) n, count(DISTINCT {ED}) n_days,
                          count(*) FILTER (WHERE value < 0) neg FROM events)
        SELECT 'wf_events_ingest' workflow_id, 'pre' step, 'data quality' task, 'events_file' dataset_id,
               CASE WHEN neg = 0 THEN 'ok' ELSE 'failed' END status, n checked_rows, neg issue_count,
               CAST(NULL AS BIGINT) source_count, CAST(NULL AS BIGINT) target_count FROM c
        UNION ALL SELECT 'wf_events_ingest', 'pre', 'data quality ml', 'events_file',
               CASE WHEN bad = 0 THEN 'ok' ELSE 'failed' END, n, bad, NULL, NULL FROM c, z
        UNION ALL SELECT 'wf_events_ingest', 'pre', 'data profile', 'events_file', 'ok', n, 0, NULL, NULL FROM c
        UNION ALL SELECT 'wf_events_ingest', 'main', 'ingestion', 'events_table', 'ok', n, 0, n, n FROM c
        UNION ALL SELECT 'wf_events_ingest', 'post', 'data reconciliation', 'events_table', 'ok', n, 0, n, n FROM c
        UNION ALL SELECT 'wf_events_ingest', 'lineage', 'data lineage', 'events_table', 'ok', n_days, 0, NULL, NULL FROM c""",
)
def q_workflow_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    wf, _ = _ingest_workflow(ctx, None)
    return run_workflow(spark, wf)


def _lineage_runs(ctx: Ctx) -> str:
    """Ingest the event files, then distribute per-day totals from the loaded table; both
    runs append their edges to one lineage table, whose name is returned."""
    lineage = f"{ctx.database()}.lineage"
    wf, dates = _ingest_workflow(ctx, lineage, with_control=False)  # the runs below reconcile nothing
    run_workflow(ctx.spark, Workflow(wf.workflow_id, load=wf.load, lineage_table=lineage))
    extract = ExtractSpec(
        source=DatasetSpec("event_totals_sql", kind="sql_file", sql_path=os.path.join(SQL_DIR, "daily_event_totals.sql")),
        target=DatasetSpec("event_totals_file", path_template=ctx.path("out/event_totals_yyyymmdd.dat"), delimiter="|"),
        effective_date=dates[-1], columns=TOTALS_SPEC,
        args={"source_table": wf.load.target.qualified}, upstream=("events_table",),
    )
    run_workflow(ctx.spark, Workflow("wf_event_totals", extract=extract, lineage_table=lineage))
    return lineage


@register(
    "lineage_edges",
    f"""SELECT 'wf_events_ingest' workflow_id, 'main' task_id, 'events_file' source_dataset,
               'events_table' target_dataset, {ED} effective_date, count(*) row_count
        FROM events GROUP BY {ED}
        UNION ALL
        SELECT 'wf_event_totals', 'main', 'events_table', 'event_totals_file', max({ED}),
               count(DISTINCT ({ED}, event_type))
        FROM events""",
)
def q_lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineage = _lineage_runs(Ctx(spark, sf_dir))
    return spark.table(lineage).select(*[c for c in EDGE_COLUMNS if c not in ("run_id", "status")])


@register(
    "lineage_downstream",
    """SELECT 'events_table' dataset, CAST(1 AS BIGINT) depth FROM events HAVING count(*) > 0
       UNION ALL
       SELECT 'event_totals_file', CAST(2 AS BIGINT) FROM events HAVING count(*) > 0""",
)
def q_lineage_downstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything downstream of the event files, by a recursive query over the edges."""
    from quayside.operators.lineage import traverse

    lineage = _lineage_runs(Ctx(spark, sf_dir))
    return traverse(spark, lineage, "events_file", "downstream")


@register(
    "lineage_upstream",
    """SELECT 'events_table' dataset, CAST(1 AS BIGINT) depth FROM events HAVING count(*) > 0
       UNION ALL
       SELECT 'events_file', CAST(2 AS BIGINT) FROM events HAVING count(*) > 0""",
)
def q_lineage_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything upstream of the distributed totals file, by a recursive query over the edges."""
    from quayside.operators.lineage import traverse

    lineage = _lineage_runs(Ctx(spark, sf_dir))
    return traverse(spark, lineage, "event_totals_file", "upstream")


# --------------------------------------------------------------------------- streaming form of K4/K10


@register("stream_landing", f"SELECT event_id, ts, user_id, event_type, value, props, {ED} effective_date FROM events")
def q_stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dated event file in the landing folder, loaded by the file-landing stream
    (``availableNow``); a second run finds no new files and loads nothing."""
    from quayside.plans.catalogue import EVENT_SPEC, _event_landing
    from quayside.streaming.landing import ingest_landing

    ctx = Ctx(spark, sf_dir)
    template = _event_landing(ctx, ctx.events())
    spec = LoadSpec(
        source=DatasetSpec("events_file", path_template=template),
        target=TableSpec(ctx.database(), "events_stream", ("effective_date",)),
        columns=EVENT_SPEC, date_from_path=True,
    )
    ingest_landing(spark, spec, ctx.path("checkpoints/events_stream"))
    return spark.table(spec.target.qualified)


# --------------------------------------------------------------------------- large load (K7 + E7)

LINEITEM_SPEC = [
    {"column_name": "l_orderkey", "data_type": "bigint"},
    {"column_name": "l_partkey", "data_type": "bigint"},
    {"column_name": "l_suppkey", "data_type": "bigint"},
    {"column_name": "l_linenumber", "data_type": "int"},
    {"column_name": "l_quantity", "data_type": "double"},
    {"column_name": "l_extendedprice", "data_type": "double"},
    {"column_name": "l_discount", "data_type": "double"},
    {"column_name": "l_tax", "data_type": "double"},
    {"column_name": "l_returnflag", "data_type": "string"},
    {"column_name": "l_linestatus", "data_type": "string"},
    {"column_name": "l_shipdate", "data_type": "timestamp_ntz"},
]


@register(
    "load_large",
    """SELECT CAST(NULL AS VARCHAR) effective_date, count(*) source_count, count(*) target_count, true is_match
       FROM lineitem""",
)
def q_load_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole line-item table as one dated ``|`` file, fully loaded into an
    unpartitioned table; the table has no date column, so it is counted whole (E7)."""
    from quayside.plans.load import load_to_table

    ctx = Ctx(spark, sf_dir)
    template = ctx.path("landing/lineitem_yyyymmdd.dat")
    write_delimited(ctx.table("lineitem"), resolve_dated_path(template, "2024-01-01"), sep="|")
    spec = LoadSpec(
        source=DatasetSpec("lineitem_file", path_template=template, delimiter="|"),
        target=TableSpec(ctx.database(), "lineitem"), columns=LINEITEM_SPEC,
        load_type="full", effective_dates=("2024-01-01",),
    )
    return load_to_table(spark, spec).report


@register("stream_landing_split", f"SELECT event_id, ts, user_id, event_type, value, props, {ED} effective_date FROM events")
def q_stream_landing_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several part files per date, ten files to a micro-batch: dates split over micro-batches."""
    from quayside.plans.catalogue import EVENT_FULL_SPEC
    from quayside.sinks.delimited import write_delimited
    from quayside.streaming.landing import ingest_landing

    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    staged = ev.withColumn("day", F.date_format(F.to_date("effective_date"), "yyyyMMdd")).drop("effective_date").repartition(3, "event_id")
    root = ctx.path("landing/split")
    write_delimited(staged, root, sep=",", partition_by=["day"], rebalance=False)
    spec = LoadSpec(
        source=DatasetSpec("events_file", path_template=f"{root}/day=yyyymmdd"), target=TableSpec(ctx.database(), "events", ("effective_date",)),
        columns=EVENT_FULL_SPEC, load_type="incremental", date_from_path=True,
    )
    ingest_landing(spark, spec, ctx.path("stream_checkpoint"), max_files_per_trigger=10)
    return spark.table(spec.target.qualified)


@register(
    "anomaly_volume_history",
    f"""WITH d AS (SELECT {ED} dt, count(*) n FROM events GROUP BY 1), l AS (SELECT max(dt) dt FROM d),
             h AS (SELECT n FROM d WHERE dt NOT IN (FROM l)), m AS (SELECT median(n) med FROM h),
             a AS (SELECT median(abs(n - med)) mad FROM h, m)
        SELECT dt, n, round({MAD_SCALE} * (n - med) / nullif(mad, 0), 4) score,
               CASE WHEN mad = 0 THEN n <> med ELSE abs(round({MAD_SCALE} * (n - med) / nullif(mad, 0), 4)) > {Z_THRESHOLD} END is_anomaly
        FROM d, m, a WHERE dt IN (FROM l)""",
)
def q_anomaly_volume_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days but the last are loaded; the last day's volume is scored against them."""
    from quayside.operators.anomaly import daily_counts, volume_against_history
    from quayside.sinks.table import write_table

    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    last = ctx.event_dates(ev)[-1]
    table = f"{ctx.database()}.events"
    write_table(spark, ev.where(F.col("effective_date") < last), table, ("effective_date",), rebalance=True)
    batch = daily_counts(ev.where(F.col("effective_date") == last), "effective_date")
    return volume_against_history(batch, spark, table, "effective_date", [last])


@register(
    "recon_missing_control",
    f"""WITH d AS (SELECT {ED} effective_date, count(*) n FROM events GROUP BY 1), l AS (SELECT max(effective_date) FROM d)
        SELECT effective_date, CASE WHEN effective_date IN (FROM l) THEN 0 ELSE n END control_count, n target_count,
               effective_date NOT IN (FROM l) is_match FROM d""",
)
def q_recon_missing_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Controls for all days but the last: the last day's rows have no control."""
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    last = ctx.event_dates(ev)[-1]
    control = control_totals(ev.where(F.col("effective_date") < last), "effective_date", None)
    return reconcile_totals(control, ev, dates="all").select("effective_date", "control_count", "target_count", "is_match")


@register("recon_types", "SELECT o_orderkey, 'changed' AS status FROM orders WHERE o_orderkey % 10 = 0")
def q_recon_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a copy whose numbers have other types and whose every tenth customer differs."""
    ctx = Ctx(spark, sf_dir)
    orders = ctx.table("orders")
    other = orders.select(
        F.col("o_orderkey").cast("decimal(20,0)").alias("o_orderkey"),
        F.when(F.col("o_orderkey") % 10 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).cast("string").alias("o_custkey"),
        F.col("o_totalprice").cast("decimal(20,6)").alias("o_totalprice"), "o_orderstatus",
    )
    return reconcile_rows(other, orders, ["o_orderkey"]).withColumn("o_orderkey", F.col("o_orderkey").cast("long"))


@register(
    "workflow_failed_load",
    """SELECT 'wf_missing' workflow_id, 'pre' step, 'data quality' task, 'events_file' dataset_id, 'error' status, CAST(NULL AS BIGINT) checked_rows, CAST(NULL AS BIGINT) issue_count, CAST(NULL AS BIGINT) source_count, CAST(NULL AS BIGINT) target_count FROM events HAVING count(*) > 0
       UNION ALL SELECT 'wf_missing', 'main', 'ingestion', 'events_table', 'error', NULL, NULL, NULL, NULL FROM events HAVING count(*) > 0
       UNION ALL SELECT 'wf_missing', 'lineage', 'data lineage', 'events_table', 'error', count(DISTINCT strftime(ts, '%Y-%m-%d')), 0, NULL, NULL FROM events HAVING count(*) > 0""",
)
def q_workflow_failed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load whose files never came, for all event dates: every step leaves its row, and each
    date an edge with the status."""
    from quayside.plans.catalogue import EVENT_FULL_SPEC

    ctx = Ctx(spark, sf_dir)
    db = ctx.database()
    source = DatasetSpec("events_file", path_template=ctx.path("nowhere/events_yyyymmdd.csv"))
    load = LoadSpec(
        source=source, target=TableSpec(db, "events", ("effective_date",), "events_table"), columns=EVENT_FULL_SPEC,
        load_type="incremental", effective_dates=tuple(ctx.event_dates()), date_from_path=True,
    )
    return run_workflow(spark, Workflow("wf_missing", load=load, pre_tasks=(ManagementTask("data quality", "events_file"),), lineage_table=f"{db}.lineage"))


@register(
    "workflow_profile",
    f"""WITH d AS (SELECT {ED} dt, count(*) n FROM events GROUP BY 1)
        SELECT 'rows' item, 'all' name, count(*) n FROM events
        UNION ALL SELECT 'nulls', 'value', count(*) - count(value) FROM events
        UNION ALL SELECT 'nulls', 'props', count(*) - count(props) FROM events
        UNION ALL SELECT 'volume', dt, n FROM d
        UNION ALL SELECT 'failed', 'value_non_negative', count(*) FILTER (WHERE value < 0) FROM events""",
)
def q_workflow_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames that a workflow keeps: profile, daily volumes and failed rules of its load."""
    ctx = Ctx(spark, sf_dir)
    wf, _ = _ingest_workflow(ctx, None)
    keep: dict = {}
    run_workflow(spark, wf, keep=keep)
    quality, daily, profile = (keep[("pre", i, n)] for i, n in enumerate(("data quality", "data quality ml", "data profile")))
    out = profile.where("column_name = 'event_id'").select(F.lit("rows").alias("item"), F.lit("all").alias("name"), F.col("row_count").alias("n"))
    out = out.union(profile.where("column_name in ('value', 'props')").select(F.lit("nulls"), "column_name", "null_count"))
    out = out.union(daily.select(F.lit("volume"), "dt", "n"))
    return out.union(quality.where("rule_name = 'value_non_negative'").select(F.lit("failed"), "rule_name", "failed_rows"))
