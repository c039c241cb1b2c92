"""Query catalogue, part 3: reconciliation by hash tree and across types, stored daily state, learned
detection, quarantine, ledger appends and planned rules. Importing this module registers the queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.anomaly import MAD_SCALE, Z_THRESHOLD, volume_against_history
from quayside.operators.hashtree import reconcile_tree
from quayside.operators.isolation import IsolationForest
from quayside.operators.profile import top_values
from quayside.operators.quality import Rule
from quayside.operators.reconcile import reconcile_rows
from quayside.operators.state import daily_volumes, merged_profile, update_state
from quayside.plans.catalogue import ED, EVENT_FULL_SPEC, EVENT_ROWS, Ctx, _event_landing, register
from quayside.plans.load import load_to_table
from quayside.plans.workflow import ManagementTask, Workflow, run_workflow
from quayside.sinks.delimited import write_delimited
from quayside.sinks.ledger import read_ledger
from quayside.sinks.table import write_table
from quayside.sinks.versions import replace_version, roll_back
from quayside.sources.delimited import read_delimited
from quayside.spec import DatasetSpec, LoadSpec, TableSpec

# --------------------------------------------------------------------------- G4


@register(
    "recon_tree",
    """SELECT o_orderkey, CASE o_custkey % 50 WHEN 1 THEN 'missing' WHEN 2 THEN 'changed' END status FROM orders WHERE o_custkey % 50 IN (1, 2)
       UNION ALL
       SELECT o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders), 'extra' FROM orders WHERE o_custkey % 50 = 3""",
)
def q_recon_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a loaded copy that lacks the orders of some customers, restates those of others
    and holds some more, by a hash tree."""
    ctx = Ctx(spark, sf_dir)
    orders = ctx.table("orders")
    other = orders.where("o_custkey % 50 <> 1").withColumn("o_totalprice", F.when(F.col("o_custkey") % 50 == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    most = orders.select(F.max("o_orderkey") + 1).scalar()
    other = other.union(orders.where("o_custkey % 50 = 3").withColumn("o_orderkey", F.col("o_orderkey") + most))
    t = f"{ctx.database()}.orders"
    write_table(spark, other, t, (), "full")
    return reconcile_tree(orders, spark.table(t), ["o_orderkey"])


@register("recon_narrow_types", "SELECT o_orderkey, 'changed' AS status FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 7 = 0")
def q_recon_narrow_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target of narrower types: prices with more decimals than it holds, and customers that are
    no number, are differences, not equal values and not errors."""
    ctx = Ctx(spark, sf_dir)
    orders = ctx.table("orders")
    source = orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"), "o_orderstatus",
        F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice") + F.lit(0.0015)).otherwise(F.col("o_totalprice")).alias("o_totalprice"), "o_orderdate", "o_orderpriority",
    )
    t = f"{ctx.database()}.orders"
    write_table(spark, orders.withColumns({"o_custkey": F.col("o_custkey").cast("int"), "o_totalprice": F.col("o_totalprice").cast("decimal(12,2)")}), t, (), "full")
    return reconcile_rows(source, spark.table(t), ["o_orderkey"])


# --------------------------------------------------------------------------- K11


@register("extract_any_text", r"SELECT doc_id, chr(57344) || chr(57345) || '\b\n' || text || '\\' || chr(10) || '\r' || chr(13) || chr(57344) || '\' AS text, lang FROM documents")
def q_extract_any_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts with private-use characters, backslashes and line ends, as delimited text and back."""
    ctx = Ctx(spark, sf_dir)
    docs = ctx.table("documents").select("doc_id", F.concat(F.lit("\ue000\ue001\\b\\n"), F.col("text"), F.lit("\\\\\n\\r\r\ue000\\")).alias("text"), "lang")
    path = write_delimited(docs, ctx.path("out/texts.dat"), sep="|", escape_lines=True)
    return read_delimited(spark, path, docs.schema, sep="|", dataset_id="documents", escape_lines=True)


# --------------------------------------------------------------------------- G2, G3: stored daily state


@register(
    "anomaly_volume_state",
    f"""WITH d AS (SELECT {ED} dt, count(*) n FROM events GROUP BY 1), l AS (SELECT max(dt) dt FROM d),
             h AS (SELECT n FROM d WHERE dt NOT IN (FROM l)), m AS (SELECT median(n) med FROM h),
             a AS (SELECT median(abs(n - med)) mad FROM h, m)
        SELECT dt, n, round({MAD_SCALE} * (n - med) / nullif(mad, 0), 4) score,
               CASE WHEN mad = 0 THEN n <> med ELSE abs(round({MAD_SCALE} * (n - med) / nullif(mad, 0), 4)) > {Z_THRESHOLD} END is_anomaly
        FROM d, m, a WHERE dt IN (FROM l)""",
)
def q_anomaly_volume_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days are loaded, each load keeping the daily state; the last day's volume is scored
    against the stored days, without reading the target's partitions."""
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    dates = ctx.event_dates(ev)
    db = ctx.database()
    spec = LoadSpec(
        source=DatasetSpec("events_file", path_template=_event_landing(ctx, ev)), target=TableSpec(db, "events", ("effective_date",)),
        columns=EVENT_FULL_SPEC, date_from_path=True, state_table=f"{db}.events_state",
    )
    for some in (dates[:-1], dates[-1:]):
        load_to_table(spark, replace(spec, effective_dates=tuple(some)))
    batch = daily_volumes(spark.table(spec.state_table).where(F.col("effective_date") == dates[-1]))
    return volume_against_history(batch, spark, spec.target.qualified, "effective_date", dates[-1:], state_table=spec.state_table)


# (column, has numbers, has text) of the profiled events
_MERGED = [("event_id", True, False), ("user_id", True, False), ("event_type", False, True), ("value", True, False), ("props", False, True)]


def _merged_oracle() -> str:
    null = "CAST(NULL AS {})"
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' column_name, count(*) row_count, count(*) - count({c}) null_count, "
        + (f"CAST(min(length({c})) AS BIGINT) min_length, CAST(max(length({c})) AS BIGINT) max_length, " if text else f"{null.format('BIGINT')} min_length, {null.format('BIGINT')} max_length, ")
        + (f"CAST(min({c}) AS DOUBLE) + 0.0 min_value, CAST(max({c}) AS DOUBLE) + 0.0 max_value, round(avg(CAST({c} AS DOUBLE)), 4) mean_value, round(stddev_samp(CAST({c} AS DOUBLE)), 4) stddev_value, "
           if num else f"{null.format('DOUBLE')} min_value, {null.format('DOUBLE')} max_value, {null.format('DOUBLE')} mean_value, {null.format('DOUBLE')} stddev_value, ")
        + "true distinct_within, " + ("true median_within " if num else "CAST(NULL AS BOOLEAN) median_within ") + "FROM events"
        for c, num, text in _MERGED
    )


@register("profile_merged", _merged_oracle())
def q_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of all event days, merged from the state that two loads have left, with no row
    read. Sketched figures are compared with exact ones: distinct counts within three standard
    errors (5%), the median's rank within 2%."""
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    dates = ctx.event_dates(ev)
    db = ctx.database()
    names = [c for c, _, _ in _MERGED]
    for some in (dates[: len(dates) // 2], dates[len(dates) // 2 :]):
        write_table(spark, ev.where(F.col("effective_date").isin(some)), f"{db}.events", ["effective_date"], rebalance=True)
        update_state(spark, f"{db}.events", f"{db}.events_state", some, columns=names)
    merged = merged_profile(spark.table(f"{db}.events_state"))
    exact = ev.agg(*[F.count_distinct(c).alias(f"d_{c}") for c in names])
    medians = {c: F.col("m")[c] for c, num, _ in _MERGED if num}
    found = merged.where(F.col("quantiles").isNotNull()).agg(F.map_from_entries(F.collect_list(F.struct("column_name", F.col("quantiles")[1]))).alias("m"))
    ranks = ev.crossJoin(F.broadcast(found)).agg(  # one row on that side
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c) < m).alias(f"a_{c}") for c, m in medians.items()], *[F.count_if(F.col(c) <= m).alias(f"b_{c}") for c, m in medians.items()])
    both = exact.crossJoin(ranks)  # one row each
    distinct = F.create_map(*[x for c in names for x in (F.lit(c), F.col(f"d_{c}"))])
    half = F.col("rows") / 2
    within = F.create_map(*[x for c in medians for x in (F.lit(c), (F.col(f"a_{c}") <= half + 0.02 * F.col("rows")) & (F.col(f"b_{c}") >= half - 0.02 * F.col("rows")))])
    facts = both.select(distinct.alias("distinct"), within.alias("within"))
    out = merged.crossJoin(F.broadcast(facts))  # one row on that side
    exact_count = F.col("distinct")[F.col("column_name")]
    return out.select(
        "column_name", "row_count", "null_count", "min_length", "max_length", "min_value", "max_value", "mean_value", "stddev_value",
        (F.abs(F.col("distinct_count") - exact_count) <= F.greatest(F.lit(1.0), 0.05 * exact_count)).alias("distinct_within"),
        F.col("within")[F.col("column_name")].alias("median_within"),
    )


_LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register(
    "profile_top_all",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' column_name, CAST(v AS VARCHAR) value, n, rk FROM (SELECT {c} v, count(*) n, row_number() OVER (ORDER BY count(*) DESC, {c}) rk "
        f"FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1) WHERE rk <= 3"
        for c in _LINE_COLUMNS
    ),
)
def q_profile_top_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most frequent values of every line-item column: two scans, and one more for each
    column whose values are too even to tell."""
    return top_values(Ctx(spark, sf_dir).table("lineitem"), _LINE_COLUMNS, k=3)


# --------------------------------------------------------------------------- G2: learned detector


def planted_events(ctx: Ctx) -> DataFrame:
    """All events and, for every 200th, one more with a value far off; ``held_out`` rows take no part
    in the fit."""
    ev = ctx.table("events").select("event_id", "value", F.hour("ts").cast("double").alias("hour"), F.lit(False).alias("planted"))
    bad = ev.where("event_id % 200 = 0").select((-F.col("event_id") - 1).alias("event_id"), (F.col("value") * 40 + 5000).alias("value"), "hour", F.lit(True).alias("planted"))
    return ev.union(bad).withColumn("held_out", F.crc32(F.col("event_id").cast("string")) % 4 == 1)


@register("anomaly_learned")
def q_anomaly_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events and the planted ones, scored by an isolation forest that was grown on a sample of
    the rows that are not held out."""
    rows = planted_events(Ctx(spark, sf_dir))
    forest = IsolationForest.fit(rows.where(~F.col("held_out")), ["value", "hour"], id_columns=["event_id"])
    return forest.score(rows).select("event_id", "planted", "held_out", F.round("score", 6).alias("score"), "is_anomaly")


# --------------------------------------------------------------------------- E17, K5, G1


@register(
    "quarantine_load",
    f"""SELECT 'row' kind, event_id, {ED} effective_date, CAST(NULL AS VARCHAR) line FROM events WHERE event_id % 25 <> 0
        UNION ALL
        SELECT 'line', NULL, {ED}, 'x' || event_id || ',' || event_type || ',' || 'bad' FROM events WHERE event_id % 25 = 0
        UNION ALL
        SELECT 'report ' || CASE WHEN count(*) FILTER (WHERE event_id % 25 = 0) = 0 THEN 'ok' ELSE 'failed' END, count(*), 'all', CAST(count(*) FILTER (WHERE event_id % 25 = 0) AS VARCHAR) FROM events""",
)
def q_quarantine_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files in which every 25th line does not parse, loaded twice: the parsed rows are in the
    table and the raw lines in the quarantine table, once each; a quality task counts them."""
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    bad = F.col("event_id") % 25 == 0
    key = F.when(bad, F.concat(F.lit("x"), F.col("event_id"))).otherwise(F.col("event_id").cast("string"))
    files = ev.select(key.alias("event_id"), "event_type", F.when(bad, F.lit("bad")).otherwise(F.col("value").cast("string")).alias("value"), F.date_format(F.to_date("effective_date"), "yyyyMMdd").alias("day"))
    write_delimited(files, ctx.path("landing/lines"), sep=",", partition_by=["day"])
    db = ctx.database()
    columns = [{"column_name": n, "data_type": t} for n, t in (("event_id", "bigint"), ("event_type", "string"), ("value", "double"))]
    spec = LoadSpec(
        source=DatasetSpec("events_file", path_template=f"{ctx.path('landing/lines')}/day=yyyymmdd"), target=TableSpec(db, "events", ("effective_date",)),
        columns=columns, effective_dates=tuple(ctx.event_dates(ev)), date_from_path=True, corrupt_column="_bad_line", quarantine_table=f"{db}.events_bad",
    )
    load_to_table(spark, spec)
    keep: dict = {}
    quality = ManagementTask("data quality", spec.target.qualified, {"rules": [Rule("id", "not_null", "event_id")]})
    run_workflow(spark, Workflow("wf_quarantine", load=spec, post_tasks=(quality,)), keep=keep)
    rows = spark.table(spec.target.qualified).select(F.lit("row").alias("kind"), "event_id", "effective_date", F.lit(None).cast("string").alias("line"))
    lines = spark.table(spec.quarantine_table).select(F.lit("line"), F.lit(None).cast("long"), "effective_date", "line")
    report = keep[("post", 0, "data quality")].where("rule_name = 'lines_parse'")
    report = report.select(F.concat(F.lit("report "), F.when(F.col("passed"), "ok").otherwise("failed")), "checked_rows", F.lit("all"), F.col("failed_rows").cast("string"))
    return rows.union(lines).union(report)


@register(
    "append_ledger",
    f"""SELECT 'row' kind, event_id, ts, user_id, event_type, value, props FROM events
        UNION ALL
        SELECT 'files', count(DISTINCT {ED}), NULL, NULL, NULL, NULL, NULL FROM events""",
)
def q_append_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All event files appended to a table without keys: half of the days, then all of them, then all
    again. The ledger keeps every file's rows once."""
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    dates = ctx.event_dates(ev)
    db = ctx.database()
    spec = LoadSpec(
        source=DatasetSpec("events_file", path_template=_event_landing(ctx, ev)), target=TableSpec(db, "events"), columns=EVENT_FULL_SPEC, ledger=True,
    )
    for some in (dates[::2], dates, dates):
        load_to_table(spark, replace(spec, effective_dates=tuple(some)))
    day = F.regexp_extract("path", r"events_date=([0-9]{8})", 1)
    known = read_ledger(spark, spec.target.qualified).select(F.count_distinct(day).alias("n"))
    rows = spark.table(spec.target.qualified).select(F.lit("row").alias("kind"), *EVENT_ROWS.split(", "))
    null = F.lit(None)
    return rows.union(known.select(F.lit("files"), "n", null, null, null, null, null))


@register("stream_landing_ledger", f"SELECT {EVENT_ROWS} FROM events")
def q_stream_landing_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing stream into a table without keys, in micro-batches of ten files, run by two
    queries with checkpoints of their own: the second sees all files as new, and adds nothing."""
    from quayside.streaming.landing import ingest_landing

    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    spec = LoadSpec(
        source=DatasetSpec("events_file", path_template=_event_landing(ctx, ev)), target=TableSpec(ctx.database(), "events"), columns=EVENT_FULL_SPEC, ledger=True,
    )
    for n in (1, 2):
        ingest_landing(spark, spec, ctx.path(f"stream_checkpoint_{n}"), max_files_per_trigger=10)
    return spark.table(spec.target.qualified)


EVENT_RULES = [
    Rule("value_known", "not_null", "value"),
    Rule("value_in_range", "range", "value", min=0, max=200),
    Rule("type_allowed", "allowed", "event_type", allowed=("click", "purchase", "view")),
    Rule("props_format", "regex", "props", pattern="[13579]}$"),
    Rule("user_and_type", "unique", columns=("user_id", "event_type", "value")),
    Rule("event_id_once", "unique", "event_id"),
    Rule("user_is_customer", "foreign_key", "user_id", parent="customers", parent_columns=("c_custkey",)),
]


@register(
    "workflow_all_rules",
    """WITH n AS (SELECT count(*) n FROM events)
       SELECT rule_name, rule_type, column_name, n checked_rows, coalesce(bad, 0) failed_rows, coalesce(bad, 0) = 0 passed FROM n, (
         SELECT 'value_known' rule_name, 'not_null' rule_type, 'value' column_name, count(*) FILTER (WHERE value IS NULL) bad FROM events
         UNION ALL SELECT 'value_in_range', 'range', 'value', count(*) FILTER (WHERE value < 0 OR value > 200) FROM events
         UNION ALL SELECT 'type_allowed', 'allowed', 'event_type', count(*) FILTER (WHERE event_type NOT IN ('click', 'purchase', 'view')) FROM events
         UNION ALL SELECT 'props_format', 'regex', 'props', count(*) FILTER (WHERE NOT regexp_matches(props, '[13579]}$')) FROM events
         UNION ALL SELECT 'user_and_type', 'unique', 'user_id,event_type,value', CAST(sum(c) AS BIGINT) FROM (SELECT count(*) c FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL GROUP BY user_id, event_type, value HAVING count(*) > 1)
         UNION ALL SELECT 'event_id_once', 'unique', 'event_id', CAST(sum(c) AS BIGINT) FROM (SELECT count(*) c FROM events WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) > 1)
         UNION ALL SELECT 'user_is_customer', 'foreign_key', 'user_id', count(*) FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0))""",
)
def q_workflow_all_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of all event files whose quality task has rules of all six kinds; the report it keeps."""
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    db = ctx.database()
    customers = TableSpec(db, "customers")
    write_table(spark, ctx.table("customer").where("c_acctbal >= 0").withColumn("c_custkey", F.col("c_custkey").cast("decimal(20,0)")), customers.qualified, (), "full")
    load = LoadSpec(
        source=DatasetSpec("events_file", path_template=_event_landing(ctx, ev)), target=TableSpec(db, "events", ("effective_date",), "events_table"),
        columns=EVENT_FULL_SPEC, effective_dates=tuple(ctx.event_dates(ev)), date_from_path=True,
    )
    wf = Workflow(
        "wf_all_rules", load=load, datasets={"customers": DatasetSpec("customers", kind="table", table=customers)},
        post_tasks=(ManagementTask("data quality", "events_table", {"rules": EVENT_RULES}),),
    )
    keep: dict = {}
    run_workflow(spark, wf, keep=keep)
    return keep[("post", 0, "data quality")]


@register("anomaly_volume_rebuilt", f"SELECT {ED} dt, count(*) n FROM events GROUP BY 1")
def q_anomaly_volume_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily volumes of a table that was loaded without state, from the state made for it since."""
    from quayside.operators.state import complete_state

    ctx = Ctx(spark, sf_dir)
    db = ctx.database()
    write_table(spark, ctx.events(), f"{db}.events", ["effective_date"], rebalance=True)
    complete_state(spark, f"{db}.events", f"{db}.events_state", columns=["value"])
    return daily_volumes(spark.table(f"{db}.events_state"))


# --------------------------------------------------------------------------- K7


@register("full_versioned", "SELECT * REPLACE (o_custkey + 1 AS o_custkey) FROM orders")
def q_full_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders replaced by versions: the second is made from the first, the third (an empty file by
    mistake) is rolled back."""
    ctx = Ctx(spark, sf_dir)
    t = f"{ctx.database()}.orders_snapshot"
    replace_version(spark, ctx.table("orders"), t)
    replace_version(spark, spark.table(t).withColumn("o_custkey", F.col("o_custkey") + 1), t)
    replace_version(spark, spark.table(t).where("false"), t)
    roll_back(spark, t)
    return spark.table(t)
