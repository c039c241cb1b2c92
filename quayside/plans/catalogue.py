"""Query catalogue: one registered query per operator, each with its DuckDB oracle.

Every query reads the driver's tables (``<sf_dir>/<name>.parquet``), stages what it
needs as delimited landing files or catalog tables under a fresh folder of the shared
checkpoint directory, runs the operator on the whole tables and returns a DataFrame.
Oracles are plain SQL over the same tables (views registered by the caller).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.schema import column_spec_to_schema
from quayside.plans.load import load_to_table
from quayside.session import fresh_name, scratch_path
from quayside.sinks.delimited import write_delimited
from quayside.sinks.table import ensure_database, write_table
from quayside.sources.catalog import read_table
from quayside.sources.delimited import read_dated_files, read_delimited
from quayside.spec import DatasetSpec, LoadSpec, TableSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


# DuckDB text for the ISO effective date of an event.
ED = "strftime(ts, '%Y-%m-%d')"
# DuckDB text: the last two effective dates of the event table (the restated window of
# ``partition_overwrite``).
LAST_TWO_DATES = f"SELECT DISTINCT {ED} d FROM events ORDER BY d DESC LIMIT 2"


class Ctx:
    """Per-call context: input tables, a fresh scratch folder and fresh databases."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.root = scratch_path(spark, "query")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def database(self) -> str:
        name = fresh_name("qs")
        ensure_database(self.spark, name, f"{self.root}/warehouse")
        return name

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def events(self) -> DataFrame:
        """Events with their ISO effective date."""
        return self.table("events").withColumn("effective_date", F.date_format("ts", "yyyy-MM-dd"))

    def event_dates(self, df: DataFrame | None = None) -> list[str]:
        """The effective dates present (one row per day reaches the driver)."""
        df = df if df is not None else self.events()
        return [r[0] for r in df.select("effective_date").distinct().orderBy("effective_date").collect()]


def land_dated(ctx: Ctx, df: DataFrame, name: str, date_col: str = "effective_date", sep: str = ",") -> str:
    """Stage ``df`` as one delimited landing file (a directory of parts) per effective
    date in ONE parallel write; returns the path template with the date token."""
    tag = f"{name}_date"
    staged = df.withColumn(tag, F.date_format(F.to_date(F.col(date_col)), "yyyyMMdd")).drop(date_col)
    root = ctx.path(f"landing/{name}")
    write_delimited(staged, root, sep=sep, partition_by=[tag])
    return f"{root}/{tag}=yyyymmdd"


# Column specs of the staged files (the metadata a load declares).
CUSTOMER_SPEC = [
    {"column_name": "c_custkey", "data_type": "bigint"},
    {"column_name": "c_name", "data_type": "string"},
    {"column_name": "c_nationkey", "data_type": "int"},
    {"column_name": "c_acctbal", "data_type": "double"},
    {"column_name": "c_mktsegment", "data_type": "string"},
]
CUSTOMER_PARITY_SPEC = [
    {"column_name": "c_custkey", "data_type": "bigint"},
    {"column_name": "c_name", "data_type": "string"},
    {"column_name": "c_nationkey", "data_type": "int"},
    {"column_name": "c_acctbal", "data_type": "decimal(12,2)"},
    {"column_name": "c_mktsegment", "data_type": "string"},
]
EVENT_FULL_SPEC = [
    {"column_name": "event_id", "data_type": "bigint"},
    {"column_name": "ts", "data_type": "timestamp_ntz"},
    {"column_name": "user_id", "data_type": "bigint"},
    {"column_name": "event_type", "data_type": "string"},
    {"column_name": "value", "data_type": "double"},
    {"column_name": "props", "data_type": "string"},
]
EVENT_SPEC = EVENT_FULL_SPEC
EVENT_COLUMNS = [c["column_name"] for c in EVENT_FULL_SPEC]
# DuckDB text: all event columns and the effective date.
EVENT_ROWS = "event_id, ts, user_id, event_type, value, props"
ORDERS_SPEC = [
    {"column_name": "o_orderkey", "data_type": "bigint"},
    {"column_name": "o_custkey", "data_type": "bigint"},
    {"column_name": "o_orderstatus", "data_type": "string"},
    {"column_name": "o_totalprice", "data_type": "double"},
    {"column_name": "o_orderdate", "data_type": "timestamp_ntz"},
    {"column_name": "o_orderpriority", "data_type": "string"},
]


def _customer_file(ctx: Ctx) -> str:
    return write_delimited(ctx.table("customer"), ctx.path("landing/customer_20240101.dat"), sep="|")


def _event_landing(ctx: Ctx, df: DataFrame, name: str = "events") -> str:
    return land_dated(ctx, df.select(*EVENT_COLUMNS, "effective_date"), name)


def _event_load(ctx: Ctx, template: str, dates: list[str], db: str, table: str, load_type: str, keys=("effective_date",)):
    spec = LoadSpec(
        source=DatasetSpec(f"{table}_file", path_template=template, delimiter=","),
        target=TableSpec(db, table, tuple(keys)),
        columns=EVENT_SPEC,
        load_type=load_type,
        effective_dates=tuple(dates),
        date_from_path=True,
    )
    return load_to_table(ctx.spark, spec)


# --------------------------------------------------------------------------- S1-S5


@register("read_delimited_typed", "SELECT * FROM customer")
def q_read_delimited_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    path = _customer_file(ctx)
    return read_delimited(spark, path, column_spec_to_schema(CUSTOMER_SPEC), sep="|", dataset_id="customer")


@register(
    "schema_parity",
    """SELECT CAST(c_custkey AS VARCHAR) c_custkey, c_name, CAST(c_nationkey AS VARCHAR) c_nationkey,
              CAST(c_acctbal AS DECIMAL(12,2)) c_acctbal, c_mktsegment FROM customer""",
)
def q_schema_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    path = _customer_file(ctx)
    schema = column_spec_to_schema(CUSTOMER_PARITY_SPEC, parity=True)
    return read_delimited(spark, path, schema, sep="|", dataset_id="customer")


@register("read_dated_files", f"SELECT {EVENT_ROWS}, {ED} effective_date FROM events")
def q_read_dated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dated event file, read by template in one scan; the date comes from the path."""
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    template = _event_landing(ctx, ev)
    return read_dated_files(spark, template, ctx.event_dates(ev), column_spec_to_schema(EVENT_SPEC), date_column="effective_date")


# --------------------------------------------------------------------------- K1-K9, P1


@register("create_partitioned", f"SELECT {EVENT_ROWS}, {ED} effective_date FROM events")
def q_create_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    template = _event_landing(ctx, ev)
    db = ctx.database()
    res = _event_load(ctx, template, ctx.event_dates(ev), db, "events_daily", "incremental")
    return read_table(spark, res.table)


@register("create_unpartitioned", "SELECT * FROM orders")
def q_create_unpartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    path = write_delimited(ctx.table("orders"), ctx.path("landing/orders_20240101.csv"), sep=",")
    db = ctx.database()
    src = read_delimited(spark, path, column_spec_to_schema(ORDERS_SPEC), sep=",")
    write_table(spark, src, f"{db}.orders", (), "full")
    return spark.table(f"{db}.orders")


@register(
    "partition_overwrite",
    f"""SELECT event_id, ts, user_id, event_type,
               CASE WHEN {ED} IN ({LAST_TWO_DATES}) THEN value * 2 ELSE value END value,
               props, {ED} effective_date
        FROM events""",
)
def q_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1 loads every date but the last. Batch 2 restates the last two dates (values
    doubled; columns shuffled plus an extra one): it replaces one loaded partition, adds
    one new partition, and every other partition must stay as batch 1 wrote it."""
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    dates = ctx.event_dates(ev)
    template = _event_landing(ctx, ev)
    db = ctx.database()
    _event_load(ctx, template, dates[:-1], db, "events_daily", "incremental")
    restated_dates = dates[-2:]
    restated = ev.where(F.col("effective_date").isin(restated_dates)).select(
        F.col("effective_date"), (F.col("value") * 2).alias("value"), "event_type", "props", "event_id", "ts", "user_id",
        F.col("user_id").alias("extra_user"),
    )
    template2 = land_dated(ctx, restated, "events_restated")
    spec2 = [
        {"column_name": "value", "data_type": "double"},
        {"column_name": "event_type", "data_type": "string"},
        {"column_name": "props", "data_type": "string"},
        {"column_name": "event_id", "data_type": "bigint"},
        {"column_name": "ts", "data_type": "timestamp_ntz"},
        {"column_name": "user_id", "data_type": "bigint"},
        {"column_name": "extra_user", "data_type": "bigint"},
    ]
    load_to_table(
        spark,
        LoadSpec(
            source=DatasetSpec("events_restated", path_template=template2),
            target=TableSpec(db, "events_daily", ("effective_date",)),
            columns=spec2, load_type="incremental", effective_dates=tuple(restated_dates), date_from_path=True,
        ),
    )
    return spark.table(f"{db}.events_daily")


@register("partition_overwrite_rerun", f"SELECT {ED} effective_date, count(*) n FROM events GROUP BY 1")
def q_partition_overwrite_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dated file loaded twice: the rerun replaces the same partitions, so each date
    keeps its count once."""
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    dates = ctx.event_dates(ev)
    template = _event_landing(ctx, ev)
    db = ctx.database()
    _event_load(ctx, template, dates, db, "events_daily", "incremental")
    _event_load(ctx, template, dates, db, "events_daily", "incremental")
    return spark.table(f"{db}.events_daily").groupBy("effective_date").agg(F.count(F.lit(1)).alias("n"))


@register("append_rerun", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def q_append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    path = write_delimited(ctx.table("orders"), ctx.path("landing/orders_20240101.csv"), sep=",")
    db = ctx.database()
    schema = column_spec_to_schema(ORDERS_SPEC)
    for _ in range(2):
        write_table(spark, read_delimited(spark, path, schema), f"{db}.orders", (), "incremental")
    return spark.table(f"{db}.orders")


@register("full_overwrite", "SELECT * FROM events WHERE event_type = 'purchase'")
def q_full_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    ev = ctx.table("events")
    db = ctx.database()
    t = f"{db}.events_snapshot"
    write_table(spark, ev.withColumn("loaded", F.lit(1)), t, (), "full")
    write_table(spark, ev.where(F.col("event_type") == "purchase"), t, (), "full")
    return spark.table(t)


@register("full_repartition", f"SELECT {EVENT_ROWS}, {ED} effective_date FROM events")
def q_full_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    db = ctx.database()
    t = f"{db}.events_by"
    write_table(spark, ev, t, ("effective_date",), "full")
    write_table(spark, spark.table(t), t, ("event_type",), "full")  # reads the old table, replaces it
    return spark.table(t)


@register("align_to_table", "SELECT * FROM orders")
def q_align_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.operators.align import align_to_table
    from quayside.sources.catalog import table_columns

    ctx = Ctx(spark, sf_dir)
    orders = ctx.table("orders")
    db = ctx.database()
    t = f"{db}.orders"
    write_table(spark, orders, t, (), "full")  # the table fixes the column order
    shuffled = orders.select(
        F.col("o_orderpriority").alias("O_ORDERPRIORITY"), "o_custkey", F.lit("x").alias("extra"), "o_totalprice", "o_orderdate", "o_orderkey", "o_orderstatus"
    )
    return align_to_table(shuffled, table_columns(spark, t))


# --------------------------------------------------------------------------- A1-A3, L1, K10


@register(
    "validate_load",
    f"""SELECT {ED} effective_date, count(*) source_count, count(*) target_count, true is_match
        FROM events GROUP BY 1""",
)
def q_validate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    dates = ctx.event_dates(ev)
    template = land_dated(ctx, ev.select("event_id", "ts", "user_id", "event_type", "value", "props", "effective_date"), "events")
    db = ctx.database()
    spec = LoadSpec(
        source=DatasetSpec("events_file", path_template=template),
        target=TableSpec(db, "events", ("effective_date",)),
        columns=EVENT_FULL_SPEC, load_type="incremental", effective_dates=tuple(dates), date_from_path=True,
    )
    return load_to_table(spark, spec).report


@register(
    "sample_loaded",
    f"SELECT {EVENT_ROWS}, {ED} effective_date FROM events WHERE {ED} = '2024-01-02' ORDER BY event_id LIMIT 2",
)
def q_sample_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.operators.validate import sample_loaded

    ctx = Ctx(spark, sf_dir)
    ev = ctx.events()
    template = _event_landing(ctx, ev)
    db = ctx.database()
    res = _event_load(ctx, template, ctx.event_dates(ev), db, "events_daily", "incremental")
    return sample_loaded(spark, res.table, "2024-01-02", order_by=["event_id"], n=2)


# --------------------------------------------------------------------------- many dates, exact text


def _glob_landing(ctx: Ctx) -> str:
    """Event files below a folder whose name looks like a date, dated in the middle of a component."""
    ev = ctx.events().select(*EVENT_COLUMNS, "effective_date")
    tag = "ev date"
    staged = ev.withColumn(tag, F.concat(F.date_format(F.to_date("effective_date"), "yyyyMMdd"), F.lit("_99999999"))).drop("effective_date")
    root = ctx.path("landing/store12345678/events")
    write_delimited(staged, root, partition_by=[tag], sep=",")
    return f"{root}/ev date=yyyymmdd_*"


@register("read_dated_many", f"SELECT {EVENT_ROWS}, {ED} effective_date FROM events")
def q_read_dated_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dated event file by a glob template, the date from the whole path."""
    ctx = Ctx(spark, sf_dir)
    return read_dated_files(spark, _glob_landing(ctx), ctx.event_dates(), column_spec_to_schema(EVENT_FULL_SPEC))


# DuckDB text: the ISO day of an order, and the middle one of the days, which gets no file.
OD = "strftime(o_orderdate, '%Y-%m-%d')"


@register(
    "validate_many_dates",
    f"""WITH d AS (SELECT {OD} effective_date, count(*) n FROM orders GROUP BY 1),
             gap AS (SELECT max(effective_date) effective_date FROM d)
        SELECT effective_date, CASE WHEN effective_date IN (FROM gap) THEN 0 ELSE n END source_count,
               CASE WHEN effective_date IN (FROM gap) THEN 0 ELSE n END target_count, true is_match FROM d""",
)
def q_validate_many_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill of all order days (far more than the write observes one by one). The rows of
    the last day are missing from the source: the day is reported, with counts of 0."""
    ctx = Ctx(spark, sf_dir)
    orders = ctx.table("orders").withColumn("effective_date", F.date_format("o_orderdate", "yyyy-MM-dd"))
    dates = [r[0] for r in orders.select("effective_date").distinct().orderBy("effective_date").collect()]  # a row per day
    spec = LoadSpec(
        source=DatasetSpec("orders_file"), target=TableSpec(ctx.database(), "orders", ("effective_date",)),
        columns=ORDERS_SPEC, load_type="incremental", effective_dates=tuple(dates), rebalance=True,
    )
    return load_to_table(spark, spec, source=orders.where(F.col("effective_date") < F.lit(dates[-1]))).report


def _text_round_trip(ctx: Ctx, name: str) -> DataFrame:
    table = ctx.table(name)
    path = write_delimited(table, ctx.path(f"out/{name}.dat"), sep="|", escape_lines=True)
    return read_delimited(ctx.spark, path, table.schema, sep="|", dataset_id=name, escape_lines=True)


@register("extract_documents", "SELECT * FROM documents")
def q_extract_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as delimited text and back: line ends, quotes and blanks kept."""
    return _text_round_trip(Ctx(spark, sf_dir), "documents")


@register("extract_pages", "SELECT * FROM pages")
def q_extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_round_trip(Ctx(spark, sf_dir), "pages")


@register("extract_conversations", "SELECT * FROM conversations")
def q_extract_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_round_trip(Ctx(spark, sf_dir), "conversations")
